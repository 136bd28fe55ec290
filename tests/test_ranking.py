"""Ranks, tiles and quantiles against brute force, hot groups included."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions.ranking import quantiles, rank_bin, running, tile_of


@pytest.fixture(autouse=True)
def several_ranges(spark):
    """Keep small ranges apart, so that totals really cross range borders."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rows_do_span_ranges(spark):
    ranged = spark.createDataFrame(skewed()).repartitionByRange("g", "v", "id").withColumn("p", F.spark_partition_id())
    assert ranged.where("g = 7").select("p").distinct().count() > 1


def skewed(n=3000):
    rng = np.random.default_rng(3)
    group = np.where(rng.random(n) < 0.4, 7, rng.integers(0, 40, n))
    value = np.where(rng.random(n) < 0.35, 0, rng.integers(0, 50, n))
    return pd.DataFrame({"g": group, "v": value, "id": np.arange(n)})


def test_running_matches_pandas_globally_and_per_group(spark):
    pdf = skewed()
    df = spark.createDataFrame(pdf)
    whole = running(df, [("v", True), ("id", False)], sums=["v"]).toPandas().sort_values("row_no")
    want = pdf.sort_values(["v", "id"], ascending=[False, True])
    assert whole["id"].tolist() == want["id"].tolist()
    assert whole["run_v"].tolist() == want["v"].cumsum().tolist()
    assert whole["row_no"].tolist() == list(range(1, len(pdf) + 1))
    per = running(df, [("v", False), ("id", False)], ["g"], ["v"]).toPandas().sort_values(["g", "row_no"])
    want = pdf.sort_values(["g", "v", "id"])
    assert per["id"].tolist() == want["id"].tolist()
    assert per["run_v"].tolist() == want.groupby("g")["v"].cumsum().tolist()
    assert per["group_n"].tolist() == want.groupby("g")["id"].transform("count").tolist()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 10, 11, 101])
def test_tiles_equal_ntile(spark, n):
    df = spark.range(1, n + 1).withColumn("n", F.lit(n))
    got = [r[0] for r in df.orderBy("id").select(tile_of(F.col("id"), F.col("n"), 4)).collect()]
    want = [r[0] for r in df.selectExpr("ntile(4) over (order by id)").collect()]
    assert got == want


@pytest.mark.parametrize("n", [2, 3, 5, 7, 8, 13, 100])
def test_rank_bins_equal_qcut_of_ranks(spark, n):
    got = [r[0] for r in spark.range(1, n + 1).orderBy("id").select(rank_bin(F.col("id"), F.lit(n), 5)).collect()]
    want = pd.qcut(pd.Series(range(1, n + 1), dtype=float), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    assert got == want


def test_seven_frequency_ranks_are_not_ntile(spark):
    got = [r[0] for r in spark.range(1, 8).orderBy("id").select(rank_bin(F.col("id"), F.lit(7), 5)).collect()]
    assert [got.count(b) for b in range(1, 6)] == [2, 1, 1, 1, 2]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=60))
def test_quantiles_interpolate_like_numpy(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id long, v long")
    got = quantiles(df, "v", "id", (0.25, 0.5, 0.95)).first()
    assert np.allclose(list(got), np.quantile(values, [0.25, 0.5, 0.95]))


def test_grouped_quantiles_with_a_hot_group(spark):
    pdf = skewed()
    got = quantiles(spark.createDataFrame(pdf), "v", "id", (0.95,), group=["g"]).toPandas().set_index("g")["q0"]
    want = pdf.groupby("g")["v"].quantile(0.95)
    assert np.allclose(got.sort_index(), want.sort_index())


def test_no_rank_runs_in_one_task(spark):
    """The only single-partition exchange is over one row per range."""
    df = spark.createDataFrame(skewed())
    plan = running(df, [("v", True), ("id", False)])._jdf.queryExecution().executedPlan().toString()
    for line in plan.split("\n"):
        assert not ("Window" in line and "id#" in line and "_range" not in line), line
