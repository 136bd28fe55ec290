"""Daily revenue series and their forecasts, for one series or many at once."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import spine
from ledgerloom.functions.expr import attach, zero
from ledgerloom.operators.views import Tables, orders_completed


def daily_series(t: Tables, by: list[str] | None = None) -> DataFrame:
    """Revenue per day (and per series), with 0 on days without sales and a day index from 0."""
    by = by or []
    return filled_days(orders_completed(t).groupBy(*by, F.col("order_dt").alias("dt")).agg(F.sum("net_amount").alias("net_revenue")), by)


def line_series(t: Tables) -> DataFrame:
    """Line revenue per day of every product category in every region, with 0 on days without sales."""
    done = orders_completed(t).select("order_id", "geo_id", F.col("order_dt").alias("dt")).join(t["dim_geo"].select("geo_id", "region"), "geo_id")
    # Lines shrink to one row an order and product before they meet anything.
    lines = t["fact_order_items"].groupBy("order_id", "product_id").agg(F.sum("line_net_revenue").alias("net_revenue"))
    joined = lines.join(done, "order_id").join(t["dim_product"].select("product_id", "category_l1"), "product_id")
    return filled_days(joined.groupBy("category_l1", "region", "dt").agg(F.sum("net_revenue").alias("net_revenue")), ["category_l1", "region"])


def filled_days(daily: DataFrame, by: list[str]) -> DataFrame:
    """``daily`` (``by``, dt, net_revenue) with every day between a series' first and last, and a day index from 0."""
    spans = daily.groupBy(*by).agg(F.min("dt").alias("first_dt"), F.max("dt").alias("last_dt"))
    days = spine(spans, "first_dt", "last_dt", by).withColumnRenamed("date_value", "dt")
    starts = spans.select(*by, F.col("first_dt"))
    filled = days.join(daily, [*by, "dt"], "left")
    filled = filled.join(starts, by) if by else attach(filled, starts)
    return filled.select(*by, "dt", F.date_diff("dt", "first_dt").alias("day_no"), zero("net_revenue").alias("net_revenue"))


def linear(t: Tables, by: list[str] | None = None, horizon_days: int = 30) -> DataFrame:
    """Least-squares line over the day index, extended past the last day.

    The sums behind the line are plain aggregates, so series of any number
    and length are fitted in one pass.
    """
    by = by or []
    series = daily_series(t, by)
    y = F.col("net_revenue").cast("decimal(24,2)")
    sums = series.groupBy(*by).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.max("dt").alias("last_dt"), F.max("day_no").alias("last_no"),
        F.sum(F.col("day_no").cast("long")).cast("double").alias("sx"), F.sum(y).cast("double").alias("sy"),
        F.sum(F.col("day_no").cast("long") * F.col("day_no")).cast("double").alias("sxx"),
        F.sum((F.col("day_no") * F.col("net_revenue")).cast("decimal(30,2)")).cast("double").alias("sxy"),
    )
    n, sx, sy, sxx, sxy = (F.col(c) for c in ("n", "sx", "sy", "sxx", "sxy"))
    slope = F.coalesce((n * sxy - sx * sy) / F.nullif(n * sxx - sx * sx, F.lit(0.0)), F.lit(0.0))
    fit = sums.select(*by, "last_dt", "last_no", "n", "sx", "sy", slope.alias("slope"))
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon_days)))
    ahead = fit.select("*", ((sy - F.col("slope") * sx) / n).alias("intercept"), step.alias("step"))
    value = F.col("intercept") + F.col("slope") * (F.col("last_no") + F.col("step"))
    return ahead.select(*by, F.date_add("last_dt", F.col("step")).alias("dt"), value.alias("forecast_lr"))


def _fit_arima(y: np.ndarray, steps: int) -> np.ndarray:
    """ARIMA(1,1,1) by conditional sum of squares over a shrinking grid of (phi, theta)."""
    d = np.diff(y)
    if len(d) < 3 or not np.any(d):
        return np.repeat(y[-1], steps)

    def errors(phi: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        e = np.zeros_like(phi)
        sse = np.zeros_like(phi)
        for prev, cur in zip(d[:-1], d[1:]):
            e = cur - phi * prev - theta * e
            sse += e * e
        return sse, e

    centre, width = np.zeros(2), 0.98
    last = 0.0
    for _ in range(6):
        axis = np.linspace(-width, width, 15)
        phi, theta = (g.ravel() for g in np.meshgrid(centre[0] + axis, centre[1] + axis))
        phi, theta = np.clip(phi, -0.99, 0.99), np.clip(theta, -0.99, 0.99)
        sse, e = errors(phi, theta)
        best = int(np.argmin(sse))
        centre, last, width = np.array([phi[best], theta[best]]), float(e[best]), width / 5
    out, level, move = [], float(y[-1]), float(d[-1])
    for i in range(steps):
        move = centre[0] * move + (centre[1] * last if i == 0 else 0.0)
        level += move
        out.append(level)
    return np.array(out)


def arima(t: Tables, by: list[str], horizon_days: int = 30) -> DataFrame:
    """ARIMA(1,1,1) per series. A series is one number per calendar day, so a group stays small."""
    series = daily_series(t, by).select(*by, "dt", F.col("net_revenue").cast("double").alias("y"))

    def per_series(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("dt")
        fc = _fit_arima(pdf["y"].to_numpy(), horizon_days)
        start = pd.Timestamp(pdf["dt"].iloc[-1]) + pd.Timedelta(days=1)
        out = {c: [k] * horizon_days for c, k in zip(by, key)}
        out["dt"] = pd.date_range(start, periods=horizon_days).date
        out["forecast_arima"] = fc
        return pd.DataFrame(out)

    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in series.select(*by).schema)
    return series.groupBy(*by).applyInPandas(per_series, f"{keys}, dt date, forecast_arima double")


#: Differences that a series needs before it is fitted.
LEAST_STEPS = 12


def _solve(rows: list[list[Column]], right: list[Column]) -> list[Column]:
    """Cramer's rule for two or three unknowns; NULL where there is no single solution."""

    def det(m: list[list[Column]]) -> Column:
        if len(m) == 2:
            return m[0][0] * m[1][1] - m[0][1] * m[1][0]
        (a, b, c), (d, e, f), (g, h, i) = m
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    whole = F.nullif(det(rows), F.lit(0.0))
    swapped = lambda k: [[right[i] if j == k else x for j, x in enumerate(row)] for i, row in enumerate(rows)]
    return [det(swapped(k)) / whole for k in range(len(rows))]


def arima_regression(series: DataFrame, by: list[str], horizon_days: int = 30) -> DataFrame:
    """ARIMA(1,1,1) of any number of series in one plan, by two regressions (Hannan and Rissanen).

    ``series``: ``by``, dt and net_revenue, a row a day. The daily changes are regressed
    on the three before them; what that leaves stands for the shocks, and the changes
    are regressed on the change and the shock before. Both regressions are sums of
    products, which tasks add up before they meet; only the lags need a series in
    order, and a series has a row a day at most. ``status`` tells a fitted series from
    a ``short`` one (under LEAST_STEPS changes) and a ``flat`` one (no single solution);
    those are carried forward at their last value.
    """
    order = Window.partitionBy(*by).orderBy("dt")
    money = F.col("net_revenue").cast("decimal(18,2)")
    steps = series.select(*by, "dt", money.alias("y"), (money - F.lag(money).over(order)).cast("decimal(18,2)").alias("d0"))
    steps = steps.select("*", *[F.lag("d0", k).over(order).alias(f"d{k}") for k in (1, 2, 3)])
    dot = lambda a, b: F.sum(F.col(a) * F.col(b)).cast("double").alias(f"{a}_{b}")
    full = F.col("d3").isNotNull()
    first = steps.where(full).groupBy(*by).agg(*[dot(f"d{i}", f"d{j}") for i in range(4) for j in range(max(i, 1), 4)])
    s = lambda i, j: F.col(f"d{min(i, j)}_d{max(i, j)}")
    a = _solve([[s(i, j) for j in (1, 2, 3)] for i in (1, 2, 3)], [s(0, i) for i in (1, 2, 3)])
    long = first.select(*by, *[x.alias(f"a{i + 1}") for i, x in enumerate(a)])
    guess = sum((F.col(f"a{k}") * F.col(f"d{k}").cast("double") for k in (2, 3)), F.col("a1") * F.col("d1").cast("double"))
    # Shocks are rounded, so that their sums do not depend on the order of addition.
    shocks = steps.join(long, by, "left").select(*by, "dt", "y", "d0", "d1", F.round(F.col("d0").cast("double") - guess, 4).cast("decimal(18,4)").alias("e0"))
    shocks = shocks.withColumn("e1", F.lag("e0").over(order))
    both = F.col("e1").isNotNull()
    pair = lambda a, b: F.sum(F.when(both, F.col(a) * F.col(b))).cast("double").alias(f"{a}_{b}")
    second = shocks.groupBy(*by).agg(
        F.count("d0").alias("changes"), F.max("dt").alias("last_dt"), F.max_by(F.struct("y", "d0", "e0"), "dt").alias("last"),
        pair("d1", "d1"), pair("d1", "e1"), pair("e1", "e1"), pair("d0", "d1"), pair("d0", "e1"),
    )
    c = F.col
    phi, theta = _solve([[c("d1_d1"), c("d1_e1")], [c("d1_e1"), c("e1_e1")]], [c("d0_d1"), c("d0_e1")])
    bound = lambda x: F.greatest(F.lit(-0.99), F.least(F.lit(0.99), x))
    fit = second.select(*by, "changes", "last_dt", "last", F.when(phi.isNotNull(), bound(phi)).alias("phi"), F.when(theta.isNotNull(), bound(theta)).alias("theta"))
    status = F.when(F.col("changes") < LEAST_STEPS, "short").when(F.col("phi").isNull() | F.col("theta").isNull() | F.col("last.e0").isNull(), "flat").otherwise("fitted")
    move = F.col("phi") * F.col("last.d0").cast("double") + F.col("theta") * F.col("last.e0").cast("double")
    ahead = fit.select(*by, "last_dt", F.col("last.y").cast("double").alias("level"), "phi", move.alias("move"), status.alias("status"), F.explode(F.sequence(F.lit(1), F.lit(horizon_days))).alias("step"))
    # The moves shrink by phi each day: their sum is a geometric one.
    value = F.when(F.col("status") == "fitted", F.col("level") + F.col("move") * (1 - F.pow("phi", F.col("step"))) / (1 - F.col("phi"))).otherwise(F.col("level"))
    return ahead.select(*by, F.date_add("last_dt", F.col("step")).alias("dt"), "status", value.alias("forecast_arima"))
