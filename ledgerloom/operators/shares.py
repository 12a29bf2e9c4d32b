"""Shares of a total (F4), row-normalised cross-tabs (H4) and pivots (H3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import stored


def share_of(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "share",
             scale: float = 1.0, money: bool = False) -> DataFrame:
    """``value / sum(value)`` within ``by`` groups (global when ``by`` is empty).

    Grouped shares use a window partitioned by the group keys (already a
    reduced frame).  A global share joins one aggregate row instead of an
    un-partitioned window, so no single task ever sees the whole frame; the
    frame is stored first, so what it was reduced from is read once.
    """
    part = F.round(F.col(value) * 100).cast("long") if money else F.col(value)
    if by:
        total = F.sum(part).over(Window.partitionBy(*by))
        total = total / 100.0 if money else total
        return df.withColumn(name, F.try_divide(F.col(value), total) * scale)
    df = stored(df, "shares")
    tot = df.agg((F.sum(part) / 100.0 if money else F.sum(part)).alias("_total"))
    return (
        df.crossJoin(F.broadcast(tot))
        .withColumn(name, F.try_divide(F.col(value), F.col("_total")) * scale)
        .drop("_total")
    )


def crosstab_pct(df: DataFrame, row: str, column: str, name: str = "pct") -> DataFrame:
    """Long-form ``crosstab(row, column, normalize='index') * 100`` (H4).

    Null keys are dropped, as a pandas crosstab does.
    """
    counts = (
        df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
        .groupBy(row, column)
        .agg(F.count("*").alias("n"))
    )
    return share_of(counts, "n", [row], name=name, scale=100.0)


def pivot_sum(df: DataFrame, row: str, column: str, value: str, values: Sequence | None = None,
              fill: float | None = None) -> DataFrame:
    """Wide pivot of a sum (H3); pass ``values`` to skip the distinct pass."""
    out = df.groupBy(row).pivot(column, list(values) if values is not None else None).agg(F.sum(value))
    return out.na.fill(fill) if fill is not None else out
