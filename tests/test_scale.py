"""Hot keys are split at run time, and nothing is left out in silence."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.operators import dashboards, finance, measures, reports, segments, shop

# Small thresholds stand in for large data; no broadcast hides the join.
SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def split(spark):
    old = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture(scope="module")
def hot(house):
    """A third of all lines belong to one completed order."""
    order = house["fact_orders"].where("order_status <> 'CANCELLED'").agg(F.min("order_id")).first()[0]
    lines = house["fact_order_items"].withColumn("order_id", F.when(F.col("order_item_id") % 3 == 0, F.lit(order)).otherwise(F.col("order_id")))
    return {n: house[n] for n in house} | {"fact_order_items": lines.repartition(12).cache()}


def has_split(df) -> bool:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("build", [finance.item_pnl, shop.order_detail, lambda t: shop.order_history(t, 10**6)], ids=["item_pnl", "order_detail", "order_history"])
def test_an_order_with_a_third_of_the_lines_is_split(split, hot, build):
    assert has_split(build(hot))


def test_detail_and_history_keep_orders_without_lines(house):
    few = {n: house[n] for n in house} | {"fact_order_items": house["fact_order_items"].where("order_id % 2 = 0")}
    orders = house["fact_orders"].count()
    assert shop.order_detail(few).select("order_id").distinct().count() == orders
    bare = shop.order_detail(few).where("order_item_id is null")
    assert bare.count() == orders - few["fact_order_items"].join(house["fact_orders"], "order_id", "left_semi").select("order_id").distinct().count()


def test_wide_forms_refuse_values_outside_their_columns(house, spark):
    marts = {"mart_product_performance": spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0)], "category_l1 string, category_l2 string, revenue_ex_tax double")}
    assert dashboards.heatmap(marts, ["x", "y", "z"]).collect()[0].asDict() == {"category_l1": "a", "x": 1.0, "y": 2.0, "z": 0.0}
    with pytest.raises(PySparkException, match="outside the given list: y"):
        dashboards.heatmap(marts, ["x"]).collect()
    with pytest.raises(PySparkException, match="outside the given list"):
        segments.cohort_matrix(house, [0]).collect()


def test_limits_can_be_lifted(house):
    assert finance.loss_orders(house, None).count() == finance.order_pnl(house).where("loss_order_flag").count()
    whole = reports.mart_export(house, "mart_exec_daily_kpis")
    assert reports.mart_export(house, "mart_exec_daily_kpis", 3).collect() == whole.orderBy(*whole.columns).limit(3).collect()
    reviews = shop.reviews_latest(house, None)
    assert reviews.count() == house["product_reviews"].count()
    assert shop.reviews_latest(house, 1, offset=1).count() == reviews.where("position = 2").count()


def test_a_null_slice_is_one_row(spark, monkeypatch):
    monkeypatch.setattr(measures, "BASE", {"a": {"x": "sum(v)"}, "b": {"y": "sum(v)"}})
    monkeypatch.setattr(measures, "_BASE_NAMES", {"x", "y"})
    monkeypatch.setattr(measures, "DERIVED", {})
    rows = spark.createDataFrame([(None, 1.0), ("w", 2.0), (None, 3.0)], "channel string, v double")
    got = {r.channel: (r.x, r.y) for r in measures.measure({"a": rows, "b": rows}, ["x", "y"], ["channel"]).collect()}
    assert got == {None: (4.0, 4.0), "w": (2.0, 2.0)}
