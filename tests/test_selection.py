"""Quantiles by narrowing histograms against numpy: long tails, ties, hot groups, nothing at all."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from ledgerloom.functions import selection

AT = (0.0, 0.05, 0.25, 0.5, 0.95, 1.0)


def table(n=4000):
    rng = np.random.default_rng(5)
    return pd.DataFrame({
        "g": np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 60, n)),
        "tail": np.exp(rng.normal(0, 12, n)) * rng.choice([-1, 1], n),
        "ties": np.where(rng.random(n) < 0.6, 3, rng.integers(0, 9, n)).astype(float),
        "small": 1e-9 * rng.random(n) + 5,
    })


def want(values, at=AT):
    return np.quantile(values[~np.isnan(values)], at)


def test_all_measures_at_once(spark):
    pdf = table()
    pdf.loc[pdf.index % 11 == 0, "ties"] = np.nan
    out = selection.quantiles(spark.createDataFrame(pdf), ["tail", "ties", "small"], AT, few=10).toPandas().set_index("measure")
    for m in ("tail", "ties", "small"):
        np.testing.assert_allclose(out.loc[m].to_numpy(float), want(pdf[m].to_numpy()), rtol=1e-12)


@pytest.mark.parametrize("few,most", [(50, 1000), (10_000, 1000), (50, 0)])
def test_groups_small_hot_and_too_many(spark, few, most):
    pdf = table(3000)
    out = selection.quantiles(spark.createDataFrame(pdf), ["tail", "ties"], (0.5, 0.95), ["g"], few, most).toPandas()
    assert len(out) == 2 * pdf["g"].nunique()
    for _, r in out.iterrows():
        np.testing.assert_allclose([r["q0"], r["q1"]], want(pdf.loc[pdf["g"] == r["g"], r["measure"]].to_numpy(), (0.5, 0.95)), rtol=1e-12)


def test_null_group_infinite_values_and_both_zeros(spark):
    rows = [(None, float(v)) for v in (*range(30), np.inf, -np.inf, np.nan)] + [("a", -0.0), ("a", 0.0), ("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = {r["g"]: r["q0"] for r in selection.quantiles(df, ["v"], (0.5,), ["g"], few=4).collect()}
    assert out == {None: 14.5, "a": 0.0}


def test_one_row_for_no_values(spark):
    none = spark.createDataFrame([], "v double, w double")
    got = selection.side_by_side(selection.quantiles(none, ["v", "w"], (0.25,)), ["v", "w"]).collect()
    assert [tuple(r) for r in got] == [(None, None)]


def test_no_sort_by_ranges(spark):
    df = spark.createDataFrame(table(500)).select("tail")
    plan = selection.quantiles(df, ["tail"], AT, few=10)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
