"""Equal-width histograms (I8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts of ``bins`` equal-width bins between the column's minimum and
    maximum: (by..., bin from 0, low, high, rows), empty bins left out.

    The maximum falls into the last bin; nulls are ignored; a constant column
    has one bin.  The range is one row, broadcast; counts combine map-side."""
    v = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    span = v.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    spot = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(0)
    return (v.crossJoin(F.broadcast(span)).groupBy(*by, spot.cast("int").alias("bin"), "_lo", "_hi").agg(F.count("*").alias("rows"))
            .select(*by, "bin", (F.col("_lo") + F.col("bin") * width).alias("low"), (F.col("_lo") + (F.col("bin") + 1) * width).alias("high"), "rows"))
