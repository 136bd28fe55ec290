"""Registered cases against DuckDB on the smallest tables.

A cross-section runs by default; PARITY_ALL=1 runs every case.
"""

from __future__ import annotations

import os

import duckdb
import pytest

from parity import CASES
from parity.registry import RAW
from tests.conftest import SF

CROSS_SECTION = (
    "vw_item_profitability", "kpi_02_mom_growth", "kpi_03_rolling_7d", "kpi_11_cohort_retention", "kpi_13_shipping_pct", "kpi_14_return_rate",
    "kpi_19_top3_per_category", "kpi_20_leakage_breakdown", "fn_daily_metrics", "fn_product_leakage", "fn_payment_failures", "fn_summary_window",
    "fin_order_pnl", "fin_item_pnl", "fin_summary", "mart_product", "mart_customer", "an_rfm_segment", "an_customer_discount", "dq_merge_map", "dq_remap_fks",
    "inc_dedupe_latest", "inc_merge_orders", "inc_audit_preimage", "inc_late_returns", "adm_audit_log", "adm_category_share", "shop_promo_apply",
    "shop_order_pricing", "shop_customer_bucket", "shop_webhook_apply", "bi_pareto", "dash_growth_drivers", "dash_alerts",
)
CHOSEN = list(CASES) if os.environ.get("PARITY_ALL") else CROSS_SECTION


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in RAW:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def cells(pdf):
    names = sorted(pdf.columns)
    shown = pdf[names].astype(object).where(pdf[names].notna(), None)
    rows = [tuple("" if v is None else repr(float(v)) if isinstance(v, float) else str(v) for v in r) for r in shown.itertuples(index=False)]
    return names, sorted(rows)


@pytest.mark.parametrize("name", CHOSEN)
def test_case(name, spark, duck):
    case = CASES[name]
    got = case.spark(spark, SF).toPandas()
    if case.sql is None:
        assert len(got)
        return
    want = duck.execute(case.duckdb()).df()
    assert cells(got) == cells(want)


def test_contract_lists_the_same_names():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(CASES) <= set(contract.queries())
    assert {name for name, c in CASES.items() if c.sql is None} == {"an_forecast_arima", "st_inventory"}
