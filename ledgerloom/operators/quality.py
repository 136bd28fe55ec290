"""Table quality: keys, references, value rules, and merging duplicate products."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.expr import rows, total
from ledgerloom.operators.views import Tables
from ledgerloom.sources import schemas


def duplicate_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    return df.groupBy(*key).agg(rows().alias("copies")).where("copies > 1")


def pk_violations(t: Tables, tables: tuple[str, ...]) -> DataFrame:
    """Repeated primary keys, as (table, key, copies)."""
    parts = []
    for name in tables:
        key = schemas.PRIMARY_KEY[name]
        dup = duplicate_keys(t[name], key)
        parts.append(dup.select(F.lit(name).alias("table_name"), F.concat_ws("|", *[F.col(k).cast("string") for k in key]).alias("key_value"), "copies"))
    return reduce(DataFrame.unionByName, parts)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-NULL reference has no parent. Distinct values are checked, not rows."""
    values = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_ref")).agg(rows().alias("child_rows"))
    return values.join(parent.select(F.col(parent_key).alias("_ref")), "_ref", "left_anti")


def fk_violations(t: Tables, tables: tuple[str, ...]) -> DataFrame:
    parts = []
    for name in tables:
        for column, parent, key in schemas.REFERENCES[name]:
            bad = orphans(t[name], column, t[parent], key)
            parts.append(bad.select(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), F.col("_ref").alias("key_value"), "child_rows"))
    return reduce(DataFrame.unionByName, parts)


def rule_violations(df: DataFrame, table: str) -> DataFrame:
    """Rows per broken rule: NOT NULL, length, and value rules, in one pass over the table."""
    checks = []
    if table in schemas.COLUMNS:
        checks += [(f"{c} is null", F.col(c).isNull()) for c in schemas.required(table) if c in df.columns]
        checks += [(f"{c} longer than {n}", F.length(c) > n) for c, n in schemas.max_lengths(table).items() if c in df.columns]
    if table in schemas.VALUE_RULES:
        rule = schemas.VALUE_RULES[table]
        checks.append((f"not ({rule})", ~F.expr(rule)))
    counts = df.agg(*[F.count_if(cond).alias(f"r{i}") for i, (_, cond) in enumerate(checks)])
    labels = F.array(*[F.struct(F.lit(label).alias("rule"), F.col(f"r{i}").alias("broken")) for i, (label, _) in enumerate(checks)])
    return counts.select(F.lit(table).alias("table_name"), F.inline(labels))


def rules_report(t: Tables, tables: tuple[str, ...]) -> DataFrame:
    return reduce(DataFrame.unionByName, [rule_violations(t[name], name) for name in tables])


def extra_defaults(addresses: DataFrame) -> DataFrame:
    """Customers with more than one default address."""
    return addresses.where("is_default").groupBy("customer_id").agg(rows().alias("defaults")).where("defaults > 1")


def name_duplicate_stats(products: DataFrame) -> DataFrame:
    """Total products, names used more than once, and surplus rows."""
    per_name = products.groupBy("product_name").agg(rows().alias("n"))
    many = F.col("n") > 1
    return per_name.agg(
        total("n").alias("total_rows"), F.count_if(many).alias("duplicate_groups"), total(F.when(many, F.col("n") - 1)).alias("extra_rows")
    )


def merge_map(products: DataFrame) -> DataFrame:
    """old_id -> canonical_id for products that share a name (NULL names count as equal)."""
    best = products.groupBy(F.col("product_name").alias("_name")).agg(F.min("product_id").alias("canonical_id"))
    joined = products.select(F.col("product_id").alias("old_id"), "product_name").join(best, F.col("product_name").eqNullSafe(F.col("_name")))
    return joined.where("old_id <> canonical_id").select("old_id", "canonical_id")


def remap(df: DataFrame, mapping: DataFrame, column: str = "product_id") -> DataFrame:
    """Replace merged ids. The map is joined on distinct ids by the optimizer's choice of strategy."""
    m = mapping.select(F.col("old_id").alias(column), "canonical_id")
    return df.join(m, column, "left").select(
        *[F.coalesce("canonical_id", F.col(column)).alias(column) if c == column else F.col(c) for c in df.columns]
    )


def align_returns(returns: DataFrame, items: DataFrame) -> DataFrame:
    """Give each return the product of the line it returns."""
    line = items.select("order_item_id", F.col("product_id").alias("_line_product"))
    return returns.join(line, "order_item_id", "left").select(
        *[F.coalesce("_line_product", F.col(c)).alias(c) if c == "product_id" else F.col(c) for c in returns.columns]
    )


def drop_merged(products: DataFrame, mapping: DataFrame) -> DataFrame:
    return products.join(mapping.select(F.col("old_id").alias("product_id")), "product_id", "left_anti").select(*products.columns)


def _newest(df: DataFrame, key: list[str], version: str) -> DataFrame:
    """One row per key, the newest; a partial aggregate, so many copies of a key shrink before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    newest = F.max(F.struct(version, *[c for c in rest if c != version]))
    return df.groupBy(*key).agg(newest.alias("_r")).select(*[F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in df.columns])


# Tables that point at products, with the key to keep unique afterwards.
REMAPPED = {
    "fact_order_items": None, "fact_returns": None, "fact_funnel_events": None,
    "customer_wishlist": (["customer_id", "product_id"], "created_at"), "product_reviews": (["customer_id", "product_id"], "updated_at"),
}


def dedupe_products(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All tables after merging same-named products; absent optional tables are skipped."""
    mapping = merge_map(t["dim_product"])
    out = {"dim_product": drop_merged(t["dim_product"], mapping)}
    for name, unique in REMAPPED.items():
        if name not in t:
            continue
        out[name] = remap(t[name], mapping)
        if unique:
            out[name] = _newest(out[name], *unique)
    out["fact_returns"] = align_returns(out["fact_returns"], out["fact_order_items"])
    return out


def max_ids(t: Tables) -> DataFrame:
    """Highest id per fact, 0 for an empty one."""
    facts = ("fact_orders", "fact_order_items", "fact_payments", "fact_funnel_events", "fact_shipments", "fact_returns")
    parts = [
        t[f].agg(F.coalesce(F.max(schemas.PRIMARY_KEY[f][0]), F.lit(0)).alias("max_id")).select(F.lit(f).alias("table_name"), "max_id") for f in facts
    ]
    return reduce(DataFrame.unionByName, parts)
