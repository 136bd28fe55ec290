"""Cases: a library call, the columns it promises, and the checking SQL.

A column list such as ``"month:d orders:i net_revenue:m"`` fixes names, order
and how both engines present a value: i bigint, m money or ratio at 4 places
(m2, m6 ... for others), s text, b boolean, d date text, t timestamp text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import configure
from parity.warehouse import RAW, TABLES, Warehouse, duckdb_ctes

# The explicit clocks for the order years and for the event month.
ORDER_DAY, EVENT_DAY = "2001-09-01", "2024-01-31"


@dataclass(frozen=True)
class Case:
    name: str
    run: Callable[[Warehouse], DataFrame]
    columns: str
    sql: str | None = None

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        df = self.run(warehouse(spark, sf_dir))
        return df.select(*[_spark_value(c, k).alias(c) for c, k in parse(self.columns)])

    def duckdb(self) -> str | None:
        if self.sql is None:
            return None
        shown = ", ".join(f"{_duck_value(c, k)} as {c}" for c, k in parse(self.columns))
        ctes = with_clause(self.sql)
        return f"{ctes}select {shown} from ({self.sql.strip()}) shown"


def parse(columns: str) -> list[tuple[str, str]]:
    return [tuple(c.split(":")) for c in columns.split()]


def _spark_value(c: str, kind: str):
    col = F.col(c)
    if kind[0] == "m":
        return col.cast(f"decimal(38,{kind[1:] or 4})").cast("double")
    if kind == "d":
        return F.date_format(col, "yyyy-MM-dd")
    if kind == "t":
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    return col.cast({"i": "bigint", "s": "string", "b": "boolean"}[kind])


def _duck_value(c: str, kind: str) -> str:
    if kind[0] == "m":
        return f"cast(cast({c} as decimal(38,{kind[1:] or 4})) as double)"
    if kind == "d":
        return f"strftime(cast({c} as date), '%Y-%m-%d')"
    if kind == "t":
        return f"strftime(cast({c} as timestamp), '%Y-%m-%d %H:%M:%S')"
    return f"cast({c} as {dict(i='bigint', s='varchar', b='boolean')[kind]})"


# Checking SQL shared by several cases, as named sub-queries.
FRAGMENTS: dict[str, str] = {}

CASES: dict[str, Case] = {}


def case(name: str, run, columns: str, sql: str | None = None) -> None:
    if name in CASES:
        raise ValueError(f"duplicate case {name}")
    CASES[name] = Case(name, run, columns, sql)


def _mentioned(sql: str) -> list[str]:
    known = [*TABLES, "dim_date", *FRAGMENTS]
    words = set(re.findall(r"\w+", sql))
    return [k for k in known if k in words]


def with_clause(sql: str) -> str:
    fragments: dict[str, str] = {}
    tables: list[str] = []

    def visit(text: str) -> None:
        for name in _mentioned(text):
            if name in FRAGMENTS:
                if name not in fragments:
                    visit(FRAGMENTS[name])
                    fragments[name] = FRAGMENTS[name]
            elif name not in tables:
                tables.append(name)

    visit(sql)
    parts = [p for p in (duckdb_ctes(tables), ",\n".join(f"{n} as ({q.strip()})" for n, q in fragments.items())) if p]
    return f"with {', '.join(parts)} " if parts else ""


_WAREHOUSES: dict[tuple[int, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Table plans are lazy and reusable, so one mapping serves every query on a folder."""
    key = (id(spark), sf_dir)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse(spark, sf_dir)
    return _WAREHOUSES[key]


__all__ = ["CASES", "EVENT_DAY", "FRAGMENTS", "ORDER_DAY", "RAW", "Case", "case", "warehouse"]
