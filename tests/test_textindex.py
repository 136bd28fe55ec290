"""Search by letter groups: equal to a match of every product, short and odd searches, upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import shop
from ledgerloom.plans import buckets, textindex

SEARCHES = ["GE", "a", " steel ", "st_el", "%", "", "  ", "q%z", "no such text", "brand#1", "SKU-000001", "o%o", "#", None]


def found(spark, root, searches):
    asked = spark.createDataFrame([(i, q) for i, q in enumerate(searches)], "query_id int, q string")
    out = {i: set() for i in range(len(searches))}
    for r in textindex.search(spark, root, asked).collect():
        assert r["product_id"] not in out[r["query_id"]]
        out[r["query_id"]].add(r["product_id"])
    return out


def test_equal_to_a_match_of_every_product_and_kept_up(spark, house, tmp_path):
    root, path = str(tmp_path), f"{tmp_path}/{textindex.TABLE}"
    s = buckets.create(house["dim_product"], path, textindex.KEY, 4)
    assert textindex.update(spark, root) == 1 and textindex.update(spark, root) == 1
    got = found(spark, root, SEARCHES)
    for i, q in enumerate(SEARCHES):
        want = set() if q is None else {r[0] for r in shop.product_search(house, q, limit=None).select("product_id").collect()}
        assert got[i] == want, q
    # A product loses its texts, another is new with none.
    one = house["dim_product"].orderBy("product_id").limit(1)
    changed = one.withColumn("product_name", F.lit("Zebra")).unionByName(
        one.select(F.lit(10**9).alias("product_id"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in one.schema.fields if f.name != "product_id"]))
    name, key = one.first()["product_name"], one.first()["product_id"]
    buckets.append(changed, s)
    assert key in found(spark, root, [name])[0]  # as the index's version has it
    textindex.update(spark, root)
    after = found(spark, root, [name, "zEBr", ""])
    assert key not in after[0] and after[1] == {key}
    assert 10**9 in after[2] and len(after[2]) == house["dim_product"].count() + 1
