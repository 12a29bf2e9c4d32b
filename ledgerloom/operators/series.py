"""Operators over an *aggregated* time series (one row per period).

Every function here receives a frame that is already reduced to one row
per period (years, quarters or months: bounded by the calendar, not by the
data volume), so an un-partitioned window over it is a few hundred rows in
one task.  The heavy lifting -- the aggregation from order lines -- is done
upstream by a two-phase ``groupBy``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def period_change(df: DataFrame, value: str, order: str, name: str = "growth",
                  scale: float = 1.0) -> DataFrame:
    """Previous-row relative change ``(x / lag(x) - 1) * scale`` (F1).

    Positional like a pandas ``pct_change``: the previous *present*
    period, first row null; a zero previous value gives null, not inf.
    """
    prev = F.lag(value).over(Window.orderBy(order))
    return df.withColumn(name, (F.try_divide(F.col(value), F.when(prev != 0, prev)) - 1) * scale)


def cagr(df: DataFrame, value: str, order: str, by: list[str] | None = None) -> DataFrame:
    """Compound annual growth ``(last/first)^(1/(n-1)) - 1`` per group."""
    by = by or []
    agg = df.groupBy(*by).agg(
        F.min_by(value, order).alias("_first"),
        F.max_by(value, order).alias("_last"),
        F.count("*").alias("_n"),
    )
    growth = F.when(
        (F.col("_n") > 1) & (F.col("_first") != 0),
        F.pow(F.try_divide(F.col("_last"), F.col("_first")), 1.0 / (F.col("_n") - 1)) - 1,
    )
    return agg.select(*by, growth.alias("cagr"))


def polyfit2(df: DataFrame, x: str, y: str, name: str = "trend") -> DataFrame:
    """Least-squares degree-2 polynomial fit; adds the fitted value.

    Solved in closed form on ``u = x - mean(x)`` (well conditioned) from
    power sums of one aggregate row, joined back to the series.
    """
    m = df.agg(F.avg(F.col(x).cast("double")).alias("_mx"))
    d = df.crossJoin(F.broadcast(m)).withColumn("_u", F.col(x) - F.col("_mx"))
    s = d.agg(
        F.count("*").cast("double").alias("s0"),
        F.sum("_u").alias("s1"),
        F.sum(F.col("_u") * F.col("_u")).alias("s2"),
        F.sum(F.col("_u") * F.col("_u") * F.col("_u")).alias("s3"),
        F.sum(F.col("_u") * F.col("_u") * F.col("_u") * F.col("_u")).alias("s4"),
        F.sum(F.col(y)).alias("t0"),
        F.sum(F.col("_u") * F.col(y)).alias("t1"),
        F.sum(F.col("_u") * F.col("_u") * F.col(y)).alias("t2"),
    )

    def det3(a, b, c, d_, e, f, g, h, i) -> Column:
        return a * (e * i - f * h) - b * (d_ * i - f * g) + c * (d_ * h - e * g)

    s0, s1, s2, s3, s4, t0, t1, t2 = (F.col(c) for c in ["s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2"])
    # normal equations  [s4 s3 s2; s3 s2 s1; s2 s1 s0] [A B C]' = [t2 t1 t0]'
    det = det3(s4, s3, s2, s3, s2, s1, s2, s1, s0)
    a = F.try_divide(det3(t2, s3, s2, t1, s2, s1, t0, s1, s0), det)
    b = F.try_divide(det3(s4, t2, s2, s3, t1, s1, s2, t0, s0), det)
    c = F.try_divide(det3(s4, s3, t2, s3, s2, t1, s2, s1, t0), det)
    coef = s.select(a.alias("_A"), b.alias("_B"), c.alias("_C"))
    out = d.crossJoin(F.broadcast(coef)).withColumn(
        name, F.col("_A") * F.col("_u") * F.col("_u") + F.col("_B") * F.col("_u") + F.col("_C")
    )
    return out.drop("_mx", "_u", "_A", "_B", "_C")


def linear_forecast(monthly: DataFrame, month: str, value: str, horizon: int) -> DataFrame:
    """Linear fit on the index of the months present, extended ``horizon`` months.

    Output: ``month_start, idx, actual, forecast``; future rows carry a
    null ``actual``.  The spine continues month by month from the first
    month (H8), as the reference's ``date_range(min, periods=n+h)``.
    """
    idx = monthly.withColumn("idx", F.row_number().over(Window.orderBy(month)) - 1)
    fit = idx.agg(
        F.regr_slope(F.col(value), F.col("idx").cast("double")).alias("_slope"),
        F.regr_intercept(F.col(value), F.col("idx").cast("double")).alias("_icpt"),
        F.count("*").alias("_n"),
        F.min(month).alias("_m0"),
    )
    spine = fit.select(
        "_slope", "_icpt", "_m0",
        F.explode(F.sequence(F.lit(0), (F.col("_n") + horizon - 1).cast("int"))).alias("idx"),
    ).withColumn("month_start", F.add_months(F.col("_m0"), F.col("idx")))
    actual = idx.select(F.col(month).alias("month_start"), F.col(value).alias("actual"))
    return (
        spine.join(actual, "month_start", "left")
        .select(
            "month_start",
            "idx",
            "actual",
            (F.col("_icpt") + F.col("_slope") * F.col("idx")).alias("forecast"),
        )
    )
