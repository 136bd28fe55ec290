"""Sources, sinks, quality, incremental refresh, snapshots and operations queries."""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import describe_days, spine
from ledgerloom.functions.expr import rows, side_by_side
from ledgerloom.operators import admin, incremental, marts, quality, reports, snapshots, views
from ledgerloom.plans import batch, buckets, maintained
from ledgerloom.session import checkpoint_root
from ledgerloom.sources import files, schemas
from parity.cases_core import BAD_PAY, COHORT_MONTHS, exact
from parity.registry import CASES, EVENT_DAY, FRAGMENTS, ORDER_DAY, case


def _session(w):
    return w["fact_orders"].sparkSession


def _scratch(w) -> str:
    return f"{checkpoint_root(_session(w))}/{uuid.uuid4().hex}"


def _counts(named: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.agg(rows().alias("n")).select(F.lit(k).alias("name"), "n") for k, df in named.items()])


def _count_sql(tables: dict[str, str]) -> str:
    return " union all ".join(f"select '{k}' as name, (select count(*) from {t}) as n" for k, t in tables.items())


# ---------------------------------------------------------------- sources and sinks
def _csv_roundtrip(w) -> DataFrame:
    """Write orders as CSV with the columns reversed, then load them by header name."""
    path = _scratch(w)
    df = w["fact_orders"]
    files.write_csv(df.select(*reversed(df.columns)), path)
    return files.load_csv(_session(w), path, schemas.schema("fact_orders"))


_ORDERS = ("order_id:i customer_id:i geo_id:i order_ts:t order_status:s channel:s currency:s gross_amount:m discount_amount:m tax_amount:m "
           "net_amount:m created_at:t updated_at:t")
case("src_csv_load", _csv_roundtrip, _ORDERS, "from fact_orders")


def _damaged(w) -> tuple[DataFrame, DataFrame]:
    """Orders as CSV with missing keys, amounts that are none, long names and repeated rows, and what the checked load makes of them."""
    path, df, order = _scratch(w), w["fact_orders"], F.col("order_id")
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns], order.alias("_id"))
    text = text.unionByName(text.where("_id % 19 = 0"))
    text = text.withColumn("order_id", F.when(F.col("_id") % 11 != 0, F.col("order_id"))).withColumn("net_amount", F.when(F.col("_id") % 13 == 0, "none").otherwise(F.col("net_amount")))
    files.write_csv(text.withColumn("channel", F.when(F.col("_id") % 17 == 0, F.repeat("channel", F.lit(40))).otherwise(F.col("channel"))).drop("_id"), path)
    return files.load_checked(_session(w), path, "fact_orders")


case("src_csv_checked", lambda w: _damaged(w)[0], _ORDERS, "from fact_orders where order_id % 11 <> 0 and order_id % 13 <> 0 and order_id % 17 <> 0 and order_id % 19 <> 0")
case("src_csv_rejects", lambda w: _damaged(w)[1].select(F.explode("reasons").alias("reason")).groupBy("reason").agg(rows().alias("n")), "reason:s n:i",
     """with damaged as (select order_id from fact_orders union all select order_id from fact_orders where order_id % 19 = 0)
        select 'NULL order_id' as reason, count(*) as n from damaged where order_id % 11 = 0 having count(*) > 0 union all select 'TYPE net_amount', count(*) from damaged where order_id % 13 = 0 having count(*) > 0
        union all select 'LENGTH channel', count(*) from damaged where order_id % 17 = 0 having count(*) > 0
        union all select 'REPEATED order_id', count(*) from damaged where order_id % 19 = 0 and order_id % 11 <> 0 having count(*) > 0""")


def _load_all(w) -> DataFrame:
    raw, house = _scratch(w), _scratch(w)
    for name in schemas.LOAD_ORDER:
        files.write_csv(w[name], f"{raw}/{name}.csv", compression="gzip")
    spark = _session(w)
    files.load_all(spark, raw, house, consume=True)
    return _counts({n: spark.read.parquet(f"{house}/{n}") for n in schemas.LOAD_ORDER})


case("src_load_all", _load_all, "name:s n:i", _count_sql({n: n for n in schemas.LOAD_ORDER}))
case("src_dim_date", lambda w: describe_days(spine(marts.activity_bounds(w), "first_dt", "last_dt")),
     "date_id:i date_value:d year:i quarter:i month:i month_name:s week_of_year:i day_of_month:i day_of_week:i day_name:s is_weekend:b",
     """from dim_date where date_value between (select min(cast(order_ts as date)) from fact_orders) and (select max(cast(event_ts as date)) from fact_funnel_events)""")

_EXPORTS = {"monthly_revenue": "kpi_01_monthly_revenue", "category_profit": "kpi_06_category_margin", "payment_failures": "kpi_17_payment_failure"}
for _name, _src in _EXPORTS.items():
    case(f"src_kpi_exports_{_name}", lambda w, n=_name: reports.kpi_exports(w)[n], CASES[_src].columns, CASES[_src].sql)
case("src_kpi_exports_carrier_sla", lambda w: reports.kpi_exports(w)["carrier_sla"], "carrier:s shipments:i sla_breach_pct:m shipping_cost:m",
     f"""select carrier, count(*) as shipments, {exact('count(*) filter (sla_breached_flag)', 'count(*)', 2)} as sla_breach_pct, sum(shipping_cost) as shipping_cost
         from fact_shipments join dim_fc using (fc_id) group by carrier""")
case("src_kpi_exports_returns_by_reason", lambda w: reports.kpi_exports(w)["returns_by_reason"], "category_l1:s return_reason:s return_lines:i refund_amount:m",
     "select category_l1, return_reason, count(*) as return_lines, sum(refund_amount) as refund_amount from fact_returns join dim_product using (product_id) group by all")


def _kpi_csv(w) -> DataFrame:
    out, spark = _scratch(w), _session(w)
    names = files.write_named(reports.kpi_exports(w), out)
    return _counts({n: spark.read.csv(f"{out}/{n}", header=True) for n in names})


for _name, _src in {"Monthly_Trend": "src_kpi_exports_monthly_revenue", "Category_Profit": "src_kpi_exports_category_profit",
                    "Returns": "src_kpi_exports_returns_by_reason", "SLA": "src_kpi_exports_carrier_sla"}.items():
    case(f"src_report_tables_{_name.lower()}", lambda w, n=_name: reports.report_tables(w)[n], CASES[_src].columns, CASES[_src].sql)
FRAGMENTS["export_sizes"] = """select 'monthly_revenue' as name, count(distinct date_trunc('month', order_ts)) as n from done_orders
  union all select 'category_profit', count(distinct category_l1) from lines_x union all select 'carrier_sla', count(distinct carrier) from fact_shipments
  union all select 'returns_by_reason', count(distinct (category_l1, return_reason)) from fact_returns join dim_product using (product_id)
  union all select 'payment_failures', count(distinct payment_method) from fact_payments"""
case("src_kpi_exports", _kpi_csv, "name:s n:i", "from export_sizes")
case("src_report_tables", lambda w: reports.report_tables(w)["KPI_Summary"], "orders:i net_revenue:m aov:m",
     f"select count(distinct order_id) as orders, sum(net_amount) as net_revenue, {exact('sum(net_amount)', 'count(distinct order_id)', 2, '1.0')} as aov from done_orders")


def _processed(w) -> DataFrame:
    out, spark = _scratch(w), _session(w)
    names = files.write_named(batch.analytics_outputs(w, ORDER_DAY, COHORT_MONTHS), out)
    return _counts({n: spark.read.csv(f"{out}/{n}", header=True) for n in names})


case("src_processed_csv", _processed, "name:s n:i",
     f"""select 'rfm_segments' as name, (select count(*) from rfm_rows) as n
         union all select 'churned_customers_90d', (select count(*) from last_seen where last_order_ts < date '{ORDER_DAY}' - interval 90 day)
         union all select 'cohort_retention_long', (select count(*) from cohorts) union all select 'cohort_retention_matrix', (select count(distinct cohort_month) from cohorts)
         union all select 'outlier_customers', (select count(*) from cust_disc) union all select 'revenue_forecast', 30""")
case("src_mart_export_all", lambda w: reports.mart_export(w, "mart_exec_daily_kpis"), CASES["mart_exec_daily"].columns, "from exec_rows")
case("src_mart_export", lambda w: reports.mart_export(w, " MART_EXEC_DAILY_KPIS ", 200000), CASES["mart_exec_daily"].columns, "from exec_rows limit 200000")


def _refresh(w) -> DataFrame:
    return _counts(batch.refresh_marts(w, _scratch(w), "0001"))


case("src_mart_refresh", _refresh, "name:s n:i",
     _count_sql({"mart_exec_daily_kpis": "exec_rows", "mart_finance_profitability": "finance_rows", "mart_funnel_conversion": "slice_funnel",
                 "mart_product_performance": "product_rows", "mart_customer_segments": "segment_rows"}))
for _n, _m in (("mart_exec_daily_kpis", "mart_exec_daily"), ("mart_finance_profitability", "mart_finance"), ("mart_funnel_conversion", "mart_funnel"),
               ("mart_product_performance", "mart_product"), ("mart_customer_segments", "mart_customer")):
    case(f"src_mart_refresh_{_m[5:]}", lambda w, n=_n: batch.refresh_marts(w, _scratch(w), "0001", [n])[n], CASES[_m].columns, CASES[_m].sql)
case("src_sql_read",
     lambda w: files.read_sql(_session(w), "select channel, count(*) as orders, sum(net_amount) as net from fact_orders where order_status = :s group by channel",
                              w, ["fact_orders"], {"s": "DELIVERED"}),
     "channel:s orders:i net:m", "select channel, count(*) as orders, sum(net_amount) as net from fact_orders where order_status = 'DELIVERED' group by all")
case("src_scalar", lambda w: _session(w).createDataFrame([(files.scalar(w["fact_orders"].agg(F.max("order_ts"))),)], "newest timestamp"), "newest:t", "select max(order_ts) as newest from fact_orders")
case("src_max_ids", quality.max_ids, "table_name:s max_id:i",
     " union all ".join(f"select '{t}' as table_name, (select max({k}) from {t}) as max_id" for t, k in
                        (("fact_orders", "order_id"), ("fact_order_items", "order_item_id"), ("fact_payments", "payment_id"),
                         ("fact_funnel_events", "event_id"), ("fact_shipments", "shipment_id"), ("fact_returns", "return_id"))))
case("src_assign_ids", lambda w: incremental.assign_ids(w["dim_customer"].select("customer_id"), "customer_id", w["fact_orders"].agg(F.max("order_id").alias("max_id"))),
     "customer_id:i new_id:i", "select customer_id, (select max(order_id) from fact_orders) + row_number() over (order by customer_id) as new_id from dim_customer")


class _Without(dict):
    """Some tables of a warehouse, with one missing."""

    def __init__(self, w, names):
        super().__init__({n: w[n] for n in names})


FRAGMENTS["ship_last"] = "select order_id, max(shipped_ts) as s, max(delivered_dt) as d from fact_shipments group by order_id"
FRAGMENTS["status_log"] = """select order_ts as event_ts, order_id, 'STATUS_CHANGED' as action, 'NEW→PLACED' as reason, 'customer' as actor_type from fact_orders
  union all select s, order_id, 'STATUS_CHANGED', 'PLACED→SHIPPED', 'system' from ship_last where s is not null
  union all select cast(d as timestamp), order_id, 'STATUS_CHANGED', 'SHIPPED→DELIVERED', 'system' from ship_last where d is not null"""
_LOG = "event_ts:t order_id:i action:s reason:s actor_type:s"
case("src_table_exists", lambda w: admin.audit_log(_Without(w, ["fact_orders", "fact_shipments"]), None), _LOG, "from status_log")

# ---------------------------------------------------------------- quality
_FACTS = tuple(schemas.LOAD_ORDER)
case("dq_pk_unique", lambda w: quality.pk_violations({**{n: w[n] for n in _FACTS}, "fact_orders": w["fact_orders"].unionByName(
    w["fact_orders"].where("order_status = 'CREATED'"))}, _FACTS), "table_name:s key_value:s copies:i",
    "select 'fact_orders' as table_name, cast(order_id as varchar) as key_value, 2 as copies from fact_orders where order_status = 'CREATED'")
_REF_TABLES = tuple(schemas.REFERENCES)
FRAGMENTS["kept_products"] = "select * from dim_product where product_id not in (select old_id from same_name)"


def _half_merged(w) -> dict[str, DataFrame]:
    """The warehouse after duplicate products were dropped but before their references were rewritten."""
    return {n: w[n] for n in _FACTS} | {"dim_product": quality.drop_merged(w["dim_product"], quality.merge_map(w["dim_product"]))}


case("dq_fk", lambda w: quality.fk_violations(_half_merged(w), _REF_TABLES), "table_name:s column_name:s key_value:i child_rows:i",
     " union all ".join(
         f"""select '{t}' as table_name, '{c}' as column_name, {c} as key_value, count(*) as child_rows from {t} where {c} is not null
             and {c} not in (select {k} from {'kept_products' if p == 'dim_product' else p}) group by 3"""
         for t, refs in schemas.REFERENCES.items() for c, p, k in refs))
_RULED = tuple(schemas.VALUE_RULES) + ("dim_product", "fact_orders")


def _rule_sql(table: str) -> str:
    checks = []
    if table in schemas.COLUMNS:
        checks += [(f"{c} is null", f"{c} is null") for c in schemas.required(table)]
        checks += [(f"{c} longer than {n}", f"length({c}) > {n}") for c, n in schemas.max_lengths(table).items()]
    if table in schemas.VALUE_RULES:
        checks.append((f"not ({schemas.VALUE_RULES[table]})",) * 2)
    quoted = [(label.replace("'", "''"), cond) for label, cond in checks]
    return " union all ".join(f"select '{table}' as table_name, '{label}' as rule, count(*) filter ({cond}) as broken from {table}" for label, cond in quoted)


case("dq_not_null_check", lambda w: quality.rules_report(w, _RULED), "table_name:s rule:s broken:i", " union all ".join(_rule_sql(t) for t in _RULED))
case("dq_one_default", lambda w: quality.extra_defaults(w["customer_addresses"]), "customer_id:i defaults:i",
     "select customer_id, count(*) as defaults from customer_addresses where is_default group by 1 having count(*) > 1")
case("dq_dup_stats", lambda w: quality.name_duplicate_stats(w["dim_product"]), "total_rows:i duplicate_groups:i extra_rows:i",
     """select sum(n) as total_rows, count(*) filter (n > 1) as duplicate_groups, coalesce(sum(n - 1) filter (n > 1), 0) as extra_rows
        from (select count(*) as n from dim_product group by product_name)""")
FRAGMENTS["same_name"] = """select * from (select product_id as old_id, min(product_id) over (partition by product_name) as canonical_id from dim_product) where old_id <> canonical_id"""
case("dq_merge_map", lambda w: quality.merge_map(w["dim_product"]), "old_id:i canonical_id:i", "from same_name")
for _t, _cols in (("fact_order_items", "order_item_id:i order_id:i product_id:i qty:i line_net_revenue:m"), ("fact_funnel_events", "event_id:i session_id:s product_id:i stage:s")):
    case(f"dq_remap_{_t}", lambda w, t=_t: quality.remap(w[t], quality.merge_map(w["dim_product"])), _cols,
         f"select f.* replace (coalesce(canonical_id, product_id) as product_id) from {_t} f left join same_name on old_id = product_id")
case("dq_remap_fks", lambda w: quality.dedupe_products(w)["customer_wishlist"], "customer_id:i product_id:i created_at:t",
     """select customer_id, coalesce(canonical_id, product_id) as product_id, max(created_at) as created_at
        from customer_wishlist left join same_name on old_id = product_id group by 1, 2""")
case("dq_align_returns", lambda w: quality.align_returns(w["fact_returns"], quality.remap(w["fact_order_items"], quality.merge_map(w["dim_product"]))),
     "return_id:i order_item_id:i product_id:i refund_amount:m",
     "select r.* replace (coalesce(canonical_id, r.product_id) as product_id) from fact_returns r left join same_name on old_id = r.product_id")
case("dq_delete_dups", lambda w: quality.drop_merged(w["dim_product"], quality.merge_map(w["dim_product"])), "product_id:i sku:s product_name:s list_price:m",
     "from dim_product where product_id not in (select old_id from same_name)")

# ---------------------------------------------------------------- incremental
RUN_TS = "2001-07-01 00:00:00"
_CONTROL = """select 'orders' as source_name, min(order_ts) as last_processed_ts from fact_orders union all select 'events', min(event_ts) from fact_funnel_events"""


def _control(w) -> DataFrame:
    a = w["fact_orders"].agg(F.min("order_ts").alias("last_processed_ts")).select(F.lit("orders").alias("source_name"), "last_processed_ts")
    return a.unionByName(w["fact_funnel_events"].agg(F.min("event_ts").alias("last_processed_ts")).select(F.lit("events").alias("source_name"), "last_processed_ts"))


case("inc_watermark_get", lambda w: incremental.watermark_get(_control(w), "events"), "last_processed_ts:t", "select min(event_ts) as last_processed_ts from fact_funnel_events")
case("inc_watermark_set", lambda w: incremental.watermark_set(_control(w), "orders", F.lit(RUN_TS)), "source_name:s last_processed_ts:t",
     f"select 'orders' as source_name, timestamp '{RUN_TS}' as last_processed_ts union all select 'events', min(event_ts) from fact_funnel_events")
case("inc_watermark_init", lambda w: incremental.watermark_or_default(_control(w), "orders", F.lit(RUN_TS)).unionByName(
    incremental.watermark_or_default(_control(w), "new_source", F.lit(RUN_TS))), "last_processed_ts:t",
    f"select min(order_ts) as last_processed_ts from fact_orders union all select timestamp '{RUN_TS}' - interval 30 minute")
case("inc_extract", lambda w: incremental.extract(w["stg_fact_orders"], "2000-01-01 00:00:00", RUN_TS), _ORDERS,
     f"from stg_fact_orders where updated_at > timestamp '2000-01-01' and updated_at <= timestamp '{RUN_TS}'")


def _two_versions(w) -> DataFrame:
    """Every order twice with equal versions: as it is, then as RETURNED (the later part wins)."""
    again = w["fact_orders"].withColumn("order_status", F.lit("RETURNED"))
    return incremental.concat_delta(w["fact_orders"], again, w["stg_fact_orders"])


case("inc_concat_delta", lambda w: _two_versions(w).drop("_seq"), _ORDERS,
     "from fact_orders union all from (select * replace ('RETURNED' as order_status) from fact_orders) union all from stg_fact_orders")
case("inc_dedupe_latest", lambda w: incremental.dedupe_latest(_two_versions(w), ["order_id"]), _ORDERS,
     """select * exclude (part) from (select *, 0 as part from fact_orders union all select * replace ('RETURNED' as order_status), 1 from fact_orders union all select *, 2 from stg_fact_orders)
        qualify row_number() over (partition by order_id order by updated_at desc, part desc) = 1""")

_MERGE_SHOW = {
    "dim_customer": "customer_id:i customer_created_ts:t geo_id:i acquisition_channel:s updated_at:t",
    "dim_product": "product_id:i sku:s product_name:s brand:s unit_cost:m list_price:m updated_at:t",
    "fact_orders": _ORDERS,
    "fact_order_items": "order_item_id:i order_id:i product_id:i qty:i unit_sell_price:m line_net_revenue:m updated_at:t",
    "fact_payments": "payment_id:i order_id:i payment_status:s amount:m captured_ts:t refund_amount:m chargeback_flag:b updated_at:t",
    "fact_shipments": "shipment_id:i order_id:i carrier:s delivered_dt:d shipping_cost:m sla_breached_flag:b updated_at:t",
    "fact_returns": "return_id:i order_id:i return_reason:s refund_amount:m return_status:s updated_at:t",
}
_SHORT = {"dim_customer": "customer", "dim_product": "product", "fact_orders": "orders", "fact_order_items": "items", "fact_payments": "payments",
          "fact_shipments": "shipments", "fact_returns": "returns"}
for _t, _rule in incremental.RULES.items():
    _set = ", ".join(f"case when s.{_rule.version} > f.{_rule.version} then s.{c} else f.{c} end as {c}" for c in (*_rule.updates, _rule.version))
    case(f"inc_merge_{_SHORT[_t]}", lambda w, t=_t: incremental.merge_table(w, t).merged, _MERGE_SHOW[_t],
         f"""select f.* replace ({_set}) from {_t} f left join stg_{_t} s using ({_rule.key})
             union all by name select * from stg_{_t} where {_rule.key} not in (select {_rule.key} from {_t})""")
    if _rule.audit:
        case(f"inc_audit_{_SHORT[_t]}", lambda w, t=_t: incremental.merge_table(w, t, RUN_TS).audit, "audit_ts:t audit_action:s " + _MERGE_SHOW[_t],
             f"""select timestamp '{RUN_TS}' as audit_ts, 'UPDATE' as audit_action, f.* from {_t} f, stg_{_t} s
                 where f.{_rule.key} = s.{_rule.key} and f.{_rule.version} < s.{_rule.version}""")
case("inc_append_events", lambda w: incremental.append_new(w["fact_funnel_events"], w["stg_funnel_events"], "event_id")[0],
     "event_id:i session_id:s stage:s channel:s device:s", "from fact_funnel_events union all from stg_funnel_events where event_id not in (select event_id from fact_funnel_events)")
case("inc_audit_preimage", lambda w: incremental.merge_table(w, "fact_orders").audit, "audit_ts:t audit_action:s " + _ORDERS,
     "select s.updated_at as audit_ts, 'UPDATE' as audit_action, f.* from fact_orders f join stg_fact_orders s on s.order_id = f.order_id and s.updated_at > f.updated_at")




case("inc_merge_counts", lambda w: incremental.merge_counts(w), "table_name:s inserted_count:i updated_count:i",
     " union all ".join(f"""select '{t}' as table_name, count(*) filter (f.{r.key} is null) as inserted_count, count(*) filter (s.updated_at > f.updated_at) as updated_count
         from stg_{t} s left join {t} f using ({r.key})""" for t, r in incremental.RULES.items()) +
     " union all select 'fact_funnel_events', count(*) filter (event_id not in (select event_id from fact_funnel_events)), 0 from stg_funnel_events")


def _moved(table: str, column: str) -> str:
    rule = incremental.RULES[table]
    return f"""select f.{rule.key}, f.{column} as old_value, s.{column} as new_value, s.{rule.version} as changed_at from {table} f join stg_{table} s using ({rule.key})
               where s.{rule.version} > f.{rule.version} and s.{column} is distinct from f.{column}"""


case("inc_status_transition", lambda w: incremental.value_changes(w, "fact_orders", "order_status"), "order_id:i old_value:s new_value:s changed_at:t", _moved("fact_orders", "order_status"))
case("inc_sla_recompute", lambda w: incremental.recompute_sla(incremental.merge_table(w, "fact_shipments").merged), "shipment_id:i order_id:i promised_delivery_dt:d delivered_dt:d sla_breached_flag:b updated_at:t",
     f"select * replace (coalesce(delivered_dt > promised_delivery_dt, false) as sla_breached_flag) from ({CASES['inc_merge_shipments'].sql})")
case("inc_sla_rule", lambda w: incremental.recompute_sla(w["stg_fact_shipments"]), "shipment_id:i delivered_dt:d promised_delivery_dt:d sla_breached_flag:b",
     "select * replace (coalesce(delivered_dt > promised_delivery_dt, false) as sla_breached_flag) from stg_fact_shipments")
# The damaged goods come back late: the table has the other returns only, the delta has all of them.
FRAGMENTS["new_returns"] = "select * from fact_returns where return_reason = 'DAMAGED'"


def _arrived(w) -> dict[str, DataFrame]:
    names = ("fact_orders", "fact_payments")
    return incremental.arrived_returns({**{n: w[n] for n in names}, "fact_returns": w["fact_returns"].where("return_reason <> 'DAMAGED'"), "stg_fact_returns": w["fact_returns"]})


FRAGMENTS["late_back"] = f"""select order_item_id, order_id, product_id, (select max(return_id) from fact_returns) + row_number() over (order by order_item_id) as return_id,
    case when order_id in (select order_id from fact_shipments where sla_breached_flag) then 'LATE_DELIVERY'
      else ['DAMAGED', 'NOT_AS_DESCRIBED', 'SIZE_ISSUE', 'LATE_DELIVERY', 'QUALITY_ISSUE', 'CHANGED_MIND'][cast(order_item_id % 6 + 1 as int)] end as return_reason,
    timestamp '{RUN_TS}' - to_days(cast(order_item_id % 6 as int)) as return_ts, order_item_id % 20 < 13 as restocked_flag,
    greatest(0, round(line_net_revenue * cast(85 + order_item_id % 16 as decimal(3,0)) * cast(0.01 as decimal(3,2)), 2)) as refund_amount
  from fact_order_items where order_id in (select order_id from fact_orders where order_status in ('DELIVERED', 'COMPLETED'))
    and order_item_id not in (select order_item_id from fact_returns)"""


def _staged_late(w) -> DataFrame:
    """A delta of returns: all that the table knows, and one for each line of a delivered order that has none there."""
    item, order, now = F.col("order_item_id"), w["fact_orders"], F.to_timestamp(F.lit(RUN_TS))
    late = w["fact_shipments"].where("sla_breached_flag").select("order_id", F.lit(True).alias("_late")).distinct()
    lines = w["fact_order_items"].select("order_item_id", "order_id", "product_id", "line_net_revenue")
    lines = lines.join(order.where(F.col("order_status").isin("DELIVERED", "COMPLETED")).select("order_id"), "order_id", "left_semi")
    lines = lines.join(w["fact_returns"].select("order_item_id"), "order_item_id", "left_anti").join(late, "order_id", "left")
    known = w["fact_returns"].agg(F.coalesce(F.max("return_id"), F.lit(0)).alias("max_id"))
    share = (85 + F.pmod(item, F.lit(16))).cast("decimal(3,0)") * F.lit("0.01").cast("decimal(3,2)")
    other = F.element_at(F.array(*[F.lit(r) for r in ("DAMAGED", "NOT_AS_DESCRIBED", "SIZE_ISSUE", "LATE_DELIVERY", "QUALITY_ISSUE", "CHANGED_MIND")]), (F.pmod(item, F.lit(6)) + 1).cast("int"))
    fresh = incremental.assign_ids(lines, "order_item_id", known, "return_id").select(
        "return_id", "order_id", "order_item_id", "product_id", (now - F.make_dt_interval(F.pmod(item, F.lit(6)).cast("int"))).alias("return_ts"),
        F.when(F.col("_late"), "LATE_DELIVERY").otherwise(other).alias("return_reason"),
        F.greatest(F.lit(0), F.round(F.col("line_net_revenue") * share, 2)).cast("decimal(14,2)").alias("refund_amount"), F.lit("REFUNDED").alias("return_status"),
        (F.pmod(item, F.lit(20)) < 13).alias("restocked_flag"), now.alias("created_at"), now.alias("updated_at"),
    )
    return w["fact_returns"].unionByName(fresh)


def _late_arrived(w) -> DataFrame:
    names = ("fact_orders", "fact_payments", "fact_returns")
    return incremental.arrived_returns({**{n: w[n] for n in names}, "stg_fact_returns": _staged_late(w)})["fact_returns"]


case("inc_late_returns", _late_arrived, "return_id:i order_id:i order_item_id:i product_id:i return_ts:t return_reason:s refund_amount:m restocked_flag:b", "from late_back")
case("inc_late_returns_payments", lambda w: _arrived(w)["fact_payments"], "payment_id:i order_id:i payment_status:s refund_amount:m updated_at:t",
     """select payment_id, order_id, if(payment_status = 'CAPTURED', 'REFUNDED', payment_status) as payment_status, if(payment_status = 'CAPTURED', total, refund_amount) as refund_amount, updated_at
        from fact_payments join (select order_id, sum(refund_amount) as total from fact_returns group by 1) using (order_id) where order_id in (select order_id from new_returns)""")
case("inc_late_returns_orders", lambda w: _arrived(w)["fact_orders"], _ORDERS,
     "select * replace ('RETURNED' as order_status) from fact_orders where order_id in (select order_id from new_returns)")
case("inc_refund_propagation", lambda w: incremental.propagate_refunds(w["fact_payments"], w["fact_returns"]), "payment_id:i order_id:i payment_status:s refund_amount:m",
     """select p.* replace (case when hit then 'REFUNDED' else payment_status end as payment_status, case when hit then total else refund_amount end as refund_amount)
        from (select *, payment_status = 'CAPTURED' and total is not null as hit from fact_payments left join (select order_id, sum(refund_amount) as total from fact_returns group by 1) using (order_id)) p""")
case("inc_price_change", lambda w: incremental.value_changes(w, "dim_product", "list_price"), "product_id:i old_value:m new_value:m changed_at:t", _moved("dim_product", "list_price"))
FRAGMENTS["all_time"] = """select count(*) filter (viewed) as v, count(*) filter (added) as a, count(*) filter (checkout) as c, count(*) filter (pay_attempt) as p,
  count(*) filter (pay_failed) as f, count(*) filter (ordered) as o from session_sum"""
FRAGMENTS["snap_wide"] = f"""select *, r - cg as gp, r - cg - sh - fe - rf as np from (select (select sum(net_amount - tax_amount) from done_orders) as r, (select count(*) from done_orders) as n,
  (select sum(refund_amount) from fact_returns) as rf, (select sum(shipping_cost) from fact_shipments) as sh,
  (select sum(qty * unit_cost) from fact_order_items where order_id in (select order_id from done_orders)) as cg,
  (select sum(gateway_fee_amount) from fact_payments where order_id in (select order_id from done_orders) and payment_status not in {BAD_PAY}) as fe,
  (select count(*) from pnl where net_profit_ex_tax < 0) as lo, (select revenue_lost_payment_failures from leak_all) as lf, (select revenue_lost_cart_abandonment from leak_all) as la)"""
FRAGMENTS["leak_all"] = CASES["fn_revenue_leakage"].sql
FRAGMENTS["snap"] = f"""select metric_name, cast(metric_value as decimal(20,4)) as metric_value from snap_wide, all_time, lateral (values ('net_revenue_total', cast(r as double)), ('orders_total', n), ('refund_amount_total', rf),
  ('shipping_cost_total', sh), ('cogs_total', cg), ('gateway_fee_total', fe), ('gross_profit_total', gp), ('net_profit_total', np), ('gross_margin_pct', {exact('gp', 'r', 4)}),
  ('net_margin_pct', {exact('np', 'r', 4)}), ('loss_orders_total', lo), ('conversion_rate', {exact('o', 'v', 4, '1.0')}), ('cart_abandonment_rate', {exact('(a - c)', 'a', 4, '1.0')}),
  ('payment_failure_rate', {exact('f', 'p', 4, '1.0')}), ('revenue_lost_due_to_failures', lf), ('revenue_lost_due_to_abandonment', la)) x(metric_name, metric_value)"""
_SNAP = "snapshot_ts:t label:s metric_name:s metric_value:m"
case("inc_snapshot_kpis", lambda w: snapshots.snapshot(w, "before", RUN_TS), _SNAP, f"select timestamp '{RUN_TS}' as snapshot_ts, 'before' as label, * from snap")


def _snap_table(w) -> DataFrame:
    """Snapshots before and after the order and shipment merges, plus an older one."""
    merged = dict(_TablesOf(w))
    merged["fact_orders"] = incremental.merge_table(w, "fact_orders").merged
    merged["fact_shipments"] = incremental.merge_table(w, "fact_shipments").merged
    first = snapshots.snapshot(w, "before", RUN_TS)
    older = first.withColumn("snapshot_ts", F.to_timestamp(F.lit("2001-06-01 00:00:00"))).withColumn("metric_value", F.lit(0).cast("decimal(20,4)"))
    return first.unionByName(older).unionByName(snapshots.snapshot(merged, "after", "2001-07-02 00:00:00"))


def _TablesOf(w):
    names = ("fact_orders", "fact_order_items", "fact_payments", "fact_shipments", "fact_returns", "fact_funnel_events", "dim_product")
    return {n: w[n] for n in names}


case("inc_snapshot_latest", lambda w: snapshots.latest(_snap_table(w), "before"), _SNAP, f"select timestamp '{RUN_TS}' as snapshot_ts, 'before' as label, * from snap")
case("vw_admin_kpis", lambda w: views.projection({"kpi_snapshots": snapshots.snapshot(w, "before", RUN_TS)}, "vw_admin_kpis"), _SNAP,
     f"select timestamp '{RUN_TS}' as snapshot_ts, 'before' as label, * from snap")
FRAGMENTS["orders_after"] = f"({CASES['inc_merge_orders'].sql})"
FRAGMENTS["ships_after"] = f"({CASES['inc_merge_shipments'].sql})"
_DONE4 = "('PLACED', 'DELIVERED', 'COMPLETED', 'RETURNED')"
case("inc_before_after", lambda w: snapshots.before_after(_snap_table(w)),
     "before_snapshot_ts:t after_snapshot_ts:t before_net_revenue_total:m after_net_revenue_total:m delta_net_revenue:m before_orders_total:m after_orders_total:m delta_orders:m "
     "before_refunds_total:m after_refunds_total:m delta_refunds:m before_shipping_cost_total:m after_shipping_cost_total:m delta_shipping_cost:m",
     f"""select *, after_net_revenue_total - before_net_revenue_total as delta_net_revenue, after_orders_total - before_orders_total as delta_orders,
           after_refunds_total - before_refunds_total as delta_refunds, after_shipping_cost_total - before_shipping_cost_total as delta_shipping_cost
         from (select timestamp '{RUN_TS}' as before_snapshot_ts, timestamp '2001-07-02' as after_snapshot_ts, r as before_net_revenue_total, n as before_orders_total,
           rf as before_refunds_total, rf as after_refunds_total, sh as before_shipping_cost_total, (select sum(shipping_cost) from ships_after) as after_shipping_cost_total,
           (select sum(net_amount - tax_amount) from orders_after where order_status in {_DONE4}) as after_net_revenue_total,
           (select count(*) from orders_after where order_status in {_DONE4}) as after_orders_total from snap_wide)""")


_MERGED = (*incremental.RULES, "fact_funnel_events")
_CLEARED = {"dim_customer": "acquisition_channel", "fact_order_items": "unit_sell_price"} | {t: incremental.RULES[t].updates[0] for t in _MERGED if t not in ("dim_customer", "fact_order_items", "fact_funnel_events")}


def _deltas(w, name: str) -> list[DataFrame]:
    """What is staged; then every fifth row newer and with one column emptied, every seventh older and the same; then all of it again."""
    first = w["stg_funnel_events" if name == "fact_funnel_events" else f"stg_{name}"]
    if name == "fact_funnel_events":
        return [first, w[name], first]
    rule = incremental.RULES[name]
    later = w[name].withColumn(_CLEARED[name], F.lit(None).cast(w[name].schema[_CLEARED[name]].dataType))
    moved = [later.where(F.col(rule.key) % n == 0).withColumn(rule.version, F.col(rule.version) + F.make_dt_interval(F.lit(days))) for n, days in ((5, 9000), (7, -9000))]
    second = moved[0].unionByName(moved[1])
    return [first, second, first.unionByName(second)]


def _refreshed(w, names=_MERGED, runs: int = 3) -> tuple[list[dict], dict]:
    """Load the merge-maintained tables and refresh them, folding deltas after the first run: counts of each run, and the tables at the end."""
    root, spark = _scratch(w), _session(w)
    batch.init_tables(w, root, names, buckets=4)
    deltas, counts = {n: _deltas(w, n) for n in names}, []
    for k in range(runs):
        counts.append(batch.incremental_refresh(spark, root, {n: deltas[n][k] for n in names}, "demo_source", RUN_TS, f"{k + 1:04d}"))
        if k == 0:
            for n in names:
                buckets.compact(spark, f"{root}/{n}", deltas=1)
                buckets.vacuum(spark, f"{root}/{n}")
    return counts, {n: buckets.read(spark, f"{root}/{n}") for n in names}


def _refresh_job(w) -> DataFrame:
    counts, after = _refreshed(w, runs=2)
    shown = lambda k, n: counts[k][n].select(F.lit(n).alias("table_name"), F.lit(k + 1).alias("run"), "inserted_count", "updated_count")
    runs = reduce(DataFrame.unionByName, [shown(k, n) for k in range(2) for n in _MERGED])
    sizes = reduce(DataFrame.unionByName, [after[n].agg(rows().alias("rows_after")).select(F.lit(n).alias("table_name"), "*") for n in _MERGED])
    return runs.join(sizes, "table_name")


case("inc_refresh_job", _refresh_job, "table_name:s run:i inserted_count:i updated_count:i rows_after:i",
     f"""with first_run as ({CASES['inc_merge_counts'].sql}),
     runs as (select table_name, 1 as run, inserted_count, updated_count from first_run union all """ +
     " union all ".join(f"select '{t}', 2, 0, count(*) from {t} where {r.key} % 5 = 0" for t, r in incremental.RULES.items()) +
     " union all select 'fact_funnel_events', 2, 0, 0) "
     "select runs.*, f.inserted_count + case table_name " + " ".join(f"when '{t}' then (select count(*) from {t})" for t in _MERGED) +
     " end as rows_after from runs join first_run f using (table_name)")

for _t, _rule in incremental.RULES.items():
    _moved = f"m.{_rule.key} % 5 = 0 and f.{_rule.key} is not null"
    _now_is = {c: f"f.{c}" for c in _rule.updates} | {_CLEARED[_t]: "null", _rule.version: f"f.{_rule.version} + interval 9000 day"}
    case(f"inc_refresh_job_{_t}", lambda w, t=_t: _refreshed(w, [t])[1][t], _MERGE_SHOW[_t],
         f"""select m.* replace ({", ".join(f"if({_moved}, {v}, m.{c}) as {c}" for c, v in _now_is.items())})
             from ({CASES[f"inc_merge_{_SHORT[_t]}"].sql}) m left join {_t} f on m.{_rule.key} = f.{_rule.key}""")
case("inc_refresh_job_fact_funnel_events", lambda w: _refreshed(w, ["fact_funnel_events"])[1]["fact_funnel_events"], CASES["inc_append_events"].columns, CASES["inc_append_events"].sql)

def _after(sql: str) -> str:
    """The statement over the tables as a refresh with what is staged leaves them."""
    known = {**{t: f"after_{t}" for t in _MERGED}, **{n: f"{n}_after" for n in FRAGMENTS if not n.startswith("after_") and not n.endswith("_after")}}
    words = set(re.findall(r"\w+", sql))
    for name in [n for n in FRAGMENTS if n in words and n in known and known[n] not in FRAGMENTS]:
        FRAGMENTS[known[name]] = _after(FRAGMENTS[name])
    return re.sub(r"\w+", lambda m: known.get(m[0], m[0]), sql)


for _t in _MERGED:
    FRAGMENTS[f"after_{_t}"] = CASES["inc_append_events" if _t == "fact_funnel_events" else f"inc_merge_{_SHORT[_t]}"].sql


def _followed(w) -> tuple[DataFrame, str]:
    """Marts made once, then two refreshes with the marts following each, and a fold between."""
    root, spark = _scratch(w), _session(w)
    names = ("fact_orders", "fact_order_items", "fact_payments", "fact_shipments", "fact_returns", "fact_funnel_events")
    batch.init_tables(w, root, names, buckets=4)
    maintained.follow(spark, root, width=2)
    halves = {n: w["stg_funnel_events" if n == "fact_funnel_events" else f"stg_{n}"] for n in names}
    for k in range(2):
        some = {n: df.where(F.pmod(F.xxhash64(buckets.snapshot(spark, f"{root}/{n}").key), F.lit(2)) == k) for n, df in halves.items()}
        batch.incremental_refresh(spark, root, some, "demo_source", RUN_TS, f"{k + 1:04d}")
        maintained.follow(spark, root)
        maintained.compact(spark, root, deltas=2)
    return spark, root


case("src_mart_follow_exec_daily", lambda w: maintained.exec_daily(*_followed(w), w), CASES["mart_exec_daily"].columns, _after(CASES["mart_exec_daily"].sql))
case("src_mart_follow_finance", lambda w: maintained.finance_profitability(*_followed(w), w), CASES["mart_finance"].columns, _after(CASES["mart_finance"].sql))

# ---------------------------------------------------------------- operations queries
case("adm_audit_log", lambda w: admin.audit_log(w, 500, 20), _LOG,
     """from (from status_log union all select created_at, order_id, 'CANCELLED', reason, 'customer' from order_cancellations)
        order by event_ts desc, order_id, reason limit 500 offset 20""")
case("adm_orders_monitor", lambda w: admin.orders_monitor(w, 200), "order_id:i customer_id:i customer_name:s customer_email:s order_ts:t order_status:s net_amount:m channel:s",
     """select order_id, customer_id, nullif(display_name, '') as customer_name, email as customer_email, order_ts, order_status, net_amount, channel
        from fact_orders left join app_users using (customer_id) order by order_ts desc, order_id limit 200""")
case("adm_journey_sessions", lambda w: admin.journey_sessions(w, EVENT_DAY, 240, limit=200), "session_id:s customer_id:i first_event_ts:t last_event_ts:t event_count:i channel:s device:s",
     f"""select session_id, max(customer_id) as customer_id, min(event_ts) as first_event_ts, max(event_ts) as last_event_ts, count(*) as event_count, max(channel) as channel, max(device) as device
         from fact_funnel_events where event_ts >= timestamp '{EVENT_DAY}' - interval 240 hour group by 1 order by last_event_ts desc, session_id limit 200""")
case("adm_journey_events", admin.journey_events, "event_id:i event_ts:t session_id:s customer_id:i stage:s channel:s device:s product_id:i order_id:i failure_reason:s", "from fact_funnel_events")
case("adm_sales_trend", lambda w: admin.sales_trend(marts.exec_daily(w), ORDER_DAY), "dt:d orders:i revenue_ex_tax:m net_profit_ex_tax:m refund_amount_return_dt:m",
     f"select kpi_dt as dt, orders, revenue_ex_tax, net_profit_ex_tax, refund_amount_return_dt from exec_rows where kpi_dt >= date '{ORDER_DAY}' - 90")
case("adm_orders_vs_revenue", lambda w: admin.orders_vs_revenue(marts.exec_daily(w), ORDER_DAY, 3650), "dt:d orders:i revenue_ex_tax:m",
     f"select kpi_dt as dt, orders, revenue_ex_tax from exec_rows where kpi_dt >= date '{ORDER_DAY}' - 3650")
case("adm_top_products", lambda w: admin.top_products(marts.product_performance(w), w["dim_product"], ORDER_DAY, 365), "product_id:i product_name:s revenue_ex_tax:m",
     f"""select product_id, any_value(product_name) as product_name, sum(p.revenue_ex_tax) as revenue_ex_tax from product_rows p join dim_product using (product_id)
         where dt >= date '{ORDER_DAY}' - 365 group by 1 order by 3 desc, 1 limit 10""")
for _lvl in ("category_l1", "category_l2"):
    case("adm_category_share" + ("" if _lvl == "category_l1" else "_l2"), lambda w, lv=_lvl: admin.category_share(marts.product_performance(w), ORDER_DAY, 365, lv, 4),
         "category:s revenue_ex_tax:m share_pct:m",
         f"""select category, revenue_ex_tax, round(cast(cast(revenue_ex_tax as double) / cast(sum(revenue_ex_tax) over () as double) * 100.0 as decimal(38,10)), 4) as share_pct from (
             select {_lvl} as category, sum(revenue_ex_tax) as revenue_ex_tax from product_rows where dt >= date '{ORDER_DAY}' - 365 group by 1 order by 2 desc, 1 limit 4)""")
case("adm_refund_leakage", lambda w: admin.refund_leakage(marts.finance_profitability(w), ORDER_DAY, 365), "dt:d revenue_ex_tax:m refund_amount:m net_profit_ex_tax:m",
     f"""select order_dt as dt, sum(revenue_ex_tax) as revenue_ex_tax, sum(refund_amount) as refund_amount, sum(net_profit_ex_tax) as net_profit_ex_tax
         from finance_rows where order_dt >= date '{ORDER_DAY}' - 365 group by 1""")
