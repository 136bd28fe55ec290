"""Text search of products by an inverted index of letter groups: many searches in one job.

Every product is posted under the groups of one, two and three neighbouring letters of
its lower-cased texts, and under the empty group. A search names the groups of its own
text (of the longest kind that fits; pieces between wildcards each on their own), the
rarest of them are intersected (none that is far more common than the rarest), and what is left is compared with the pattern itself on
the product as it is now. So postings of texts that a product no longer has do no harm,
and upkeep only adds: the index follows the merge-on-read table of products through its
log, one folder of postings for each time it was brought up to date, named after the
version it has reached.

A search without a text finds every product, as ``shop.product_search`` does; one for a
null finds none. Postings are range-partitioned by group and product, so a group that all
products have is spread over many files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.plans import buckets
from ledgerloom.plans.publish import newest, publish, versions
from ledgerloom.session import configure, cut

TABLE, INDEX, KEY = "dim_product", "_letter_groups", "product_id"
# The columns that a search looks at.
COLUMNS = ("product_name", "brand", "sku", "category_l1", "category_l2")
#: Groups of a search that are intersected before products are compared.
RAREST = 3
#: ... as long as they have at most so many times the postings of the rarest.
COMMONER = 4


def _groups(text: Column, n: int) -> Column:
    """All groups of n neighbouring letters; none for a shorter text."""
    size = F.length(text)
    return F.when(size >= n, F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def postings(products: DataFrame) -> DataFrame:
    """gram and product_id, each pair once."""
    each = [_groups(F.lower(F.coalesce(F.col(c), F.lit(""))), n) for c in COLUMNS for n in (1, 2, 3)]
    grams = F.array_distinct(F.concat(F.array(F.lit("")), *each))
    return products.select(F.explode(grams).alias("gram"), KEY)


def update(spark: SparkSession, root: str) -> int:
    """Bring the index up to the newest version of the products; that version. A repeated run writes the same folder again."""
    configure(spark)
    path, done = f"{root}/{TABLE}", newest(spark, root, INDEX)
    s, since = buckets.snapshot(spark, path), int(done or 0)
    if since < s.version:
        changed = buckets._live(spark, s, s.entries) if not since else buckets.lookup(s, cut(buckets.changed_keys(spark, path, since, s.version)))
        rows = postings(changed).repartitionByRange("gram", KEY).sortWithinPartitions("gram", KEY)
        publish(rows, root, INDEX, f"{s.version:012d}")
    return s.version


def wanted(queries: DataFrame) -> DataFrame:
    """query_id, pattern and grams of each search with a text (query_id, q)."""
    text = F.regexp_replace("q", r"^\s+|\s+$", "")
    # Letters beside a wildcard or an escape are looked for on their own.
    pieces = F.filter(F.split(F.lower(text), r"[%_\\]+"), lambda p: F.length(p) > 0)
    of = F.flatten(F.transform(pieces, lambda p: F.when(F.length(p) >= 3, _groups(p, 3)).when(F.length(p) == 2, _groups(p, 2)).otherwise(_groups(p, 1))))
    grams = F.when(F.size(of) > 0, F.array_distinct(of)).otherwise(F.array(F.lit("")))
    return queries.where(F.col("q").isNotNull()).select("query_id", F.concat(F.lit("%"), text, F.lit("%")).alias("pattern"), grams.alias("grams"))


def search(spark: SparkSession, root: str, queries: DataFrame, rarest: int = RAREST) -> DataFrame:
    """query_id (unique) and the products that each search (query_id, q) finds, as the index's version of the table has them."""
    done = versions(spark, root, INDEX)
    if not done:
        raise FileNotFoundError(f"no search index under {root}")
    posted = spark.read.parquet(*[f"{root}/{INDEX}/{v}" for v in done])
    asked = cut(wanted(queries))
    each = asked.select("query_id", F.explode("grams").alias("gram"))
    # Rows, not products: a product that was posted again counts twice, which only ranks its groups.
    common = posted.join(each.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    order = Window.partitionBy("query_id").orderBy("n", "gram")
    counted = each.join(common, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ranked = counted.select("*", F.row_number().over(order).alias("_k"), F.min("n").over(Window.partitionBy("query_id")).alias("_least"))
    # A group that is much more common than the rarest one costs more rows than it spares.
    chosen = ranked.where((F.col("_k") <= rarest) & (F.col("n") <= COMMONER * F.col("_least"))).select("query_id", "gram")
    chosen = cut(chosen.join(chosen.groupBy("query_id").agg(F.count("*").alias("_of")), "query_id"))
    pairs = posted.join(chosen, "gram").groupBy("query_id", KEY, "_of").agg(F.countDistinct("gram").alias("_has")).where(F.col("_has") == F.col("_of"))
    s = buckets.snapshot(spark, f"{root}/{TABLE}", int(done[-1]))
    found = buckets._live(spark, s, s.entries).join(pairs.select("query_id", KEY), KEY).join(asked.select("query_id", "pattern"), "query_id")
    fits = reduce(Column.__or__, [F.expr(f"coalesce({c} ilike pattern, false)") for c in COLUMNS], F.col("pattern") == "%%")
    return found.where(fits).select("query_id", *s.schema.names)
