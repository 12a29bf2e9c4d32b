"""Distributed global ranks, prefix sums and exact quantiles.

A global rank or quantile over all rows must not go through an
un-partitioned window (one task) or a driver collect.  The building block
is ``prefix_sum``: range-partition by a *unique* ordering key, take a
running sum inside each partition (Arrow batches, in order), then add the
totals of all earlier partitions (one row per partition -- bounded by the
partition count, not the data).

``exact_quantiles`` first collapses equal values with a map-side-combined
``groupBy(value).count()`` -- a value that holds a third of all rows
becomes one row per map task -- so the range partitioning that follows
works on unique keys and stays balanced however skewed the data is.  Only
the ranges that hold a wanted position are then looked at; ``rank_cuts``
finds the bounds of rank quantiles in the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import stored


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def prefix_sum(df: DataFrame, order_cols: Sequence[str], weight: str, name: str = "before",
               num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = sum of ``weight`` over all rows strictly before each row
    in the global order of ``order_cols`` (which must be unique per row).

    Range bounds are sampled, so two evaluations of a range exchange may cut
    differently.  The tagged frame (partition id, running sum inside it) is
    therefore stored once, and both the offsets and the result read those
    files: ranks don't depend on Spark reusing an exchange.
    """
    nparts = _num_partitions(df, num_partitions)
    ranged = df.repartitionByRange(nparts, *order_cols).sortWithinPartitions(*order_cols)
    wtype = ranged.schema[weight].dataType
    fractional = isinstance(wtype, (T.DoubleType, T.FloatType, T.DecimalType))
    out_type = T.DoubleType() if fractional else T.LongType()
    schema = T.StructType(
        list(ranged.schema.fields)
        + [T.StructField("_pid", T.IntegerType(), False), T.StructField("_local", out_type, False)]
    )

    def tag(batches):
        pid = TaskContext.get().partitionId()
        running = 0
        for batch in batches:
            w = batch.column(weight).to_numpy(zero_copy_only=False).astype(np.float64 if fractional else np.int64)
            before = running + np.cumsum(w) - w
            if len(w):
                running = before[-1] + w[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(w), pid, np.int32)), pa.array(before)], schema.names)

    tagged = stored(ranged.mapInArrow(tag, schema), "prefix")
    totals = tagged.groupBy("_pid").agg(F.sum(weight).alias("_ptotal"))
    offsets = totals.select(
        "_pid",
        F.coalesce(
            F.sum("_ptotal").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_offset"),
    )
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_offset") + F.col("_local")).cast(out_type))
        .drop("_pid", "_local", "_offset")
    )


def global_row_number(df: DataFrame, order_cols: Sequence[str], name: str = "rank",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based ``row_number()`` over the unique global order ``order_cols``."""
    w = df.withColumn("_one", F.lit(1).cast("long"))
    out = prefix_sum(w, order_cols, "_one", "_before", num_partitions)
    return out.withColumn(name, F.col("_before") + 1).drop("_one", "_before")


def _ranges(df: DataFrame, order_cols: Sequence[str], name: str, num_partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned by ``order_cols`` and stored once with the
    number of its range, ``_pid``: the ranges are in order, and every reader
    sees the same ones."""
    ranged = df.repartitionByRange(_num_partitions(df, num_partitions), *order_cols)
    return stored(ranged.withColumn("_pid", F.spark_partition_id()), name)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    name: str = "q", num_partitions: int | None = None, weight: str | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per ``by`` group.

    Same definition as ``quantile_cont`` / pandas ``quantile``: position
    ``p * (n - 1)``, value ``lo + (hi - lo) * frac``.  Null values are ignored;
    a null in ``by`` is a group like others.  A row counts ``weight`` times
    (once by default).  Output: ``by...`` plus ``q0..q{k-1}`` (one column per prob).

    Equal values collapse map-side; the distinct ones are range-partitioned
    by (group, value), so a group that holds all rows is spread over all
    ranges.  Each range's weight in a group tells which range holds a
    position (at most ranges x groups rows); running sums are then taken
    inside those ranges alone.  No window spans a group.
    """
    by = list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(
        (F.count("*") if weight is None else F.sum(weight)).alias("_w"))
    tagged = _ranges(counts, [*by, value], "quantiles", num_partitions)
    parts = tagged.groupBy(*by, "_pid").agg(F.sum("_w").alias("_pw"))
    # one row a range (and group): the earlier ranges of the group, and all of them
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"_start": F.coalesce(F.sum("_pw").over(before), F.lit(0)),
                               "_n": F.sum("_pw").over(Window.partitionBy(*by))})

    def targets(i: int) -> tuple[Column, Column, Column]:
        pos = (F.col("_n") - 1).cast("double") * float(probs[i])
        return pos, F.floor(pos), F.ceil(pos)

    held = F.lit(False)
    for i in range(len(probs)):
        for at in targets(i)[1:]:
            held = held | ((F.col("_start") <= at) & (at < F.col("_start") + F.col("_pw")))
    hits = parts.where(held).select(*[F.col(c).alias(f"_h_{c}") for c in by], F.col("_pid").alias("_h_pid"), "_start", "_n")
    on = F.col("_pid") == F.col("_h_pid")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_h_{c}"))
    inside = Window.partitionBy(*by, "_pid").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = tagged.join(hits, on).withColumn("_before", F.col("_start") + F.coalesce(F.sum("_w").over(inside), F.lit(0)))
    picks = []
    for i in range(len(probs)):
        pos, lo, hi = targets(i)
        for part, at in (("lo", lo), ("hi", hi)):
            hit = (F.col("_before") <= at) & (at < F.col("_before") + F.col("_w"))
            picks.append(F.max(F.when(hit, F.col(value).cast("double"))).alias(f"_{part}{i}"))
        picks.append(F.max(pos - lo).alias(f"_f{i}"))
    picked = ranked.groupBy(*by).agg(*picks)
    out = picked.select(*by, *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(f"{name}{i}")
        for i in range(len(probs))])
    return out if by else out.where(F.col(f"{name}0").isNotNull())


def rank_cuts(df: DataFrame, measures: Sequence[str], tie: str, k: int) -> DataFrame:
    """One row: for each measure ``m``, ``_cut_m`` holds the (value, tie)
    pairs at which the rank's quantile bin (of ``k``) goes up, and ``_n`` the
    number of rows.

    Ranks run over the unique order (measure, ``tie``).  Bin ``s + 1`` begins
    at rank ``floor(s (n - 1) / k) + 2``.  All measures go through one range
    partitioning; the rows' counts by range place the cuts, and only the
    ranges that hold one are numbered.  No row is joined back: a row's bin
    follows from comparing its own pair with the cuts."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("m"), F.col(m).cast("double").alias("v")) for i, m in enumerate(measures)])).alias("x"), F.col(tie).alias("t"))
    tagged = _ranges(long.select("x.m", "x.v", "t"), ["m", "v", "t"], "ranks")
    parts = tagged.groupBy("m", "_pid").agg(F.count("*").alias("_pw"))
    before = Window.partitionBy("m").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"_start": F.coalesce(F.sum("_pw").over(before), F.lit(0)), "_n": F.sum("_pw").over(Window.partitionBy("m"))})
    ranks = F.transform(F.sequence(F.lit(1), F.lit(k - 1)), lambda s: F.struct(
        s.alias("s"), F.least(F.floor(s * (F.col("_n") - 1) / k) + 2, F.col("_n")).alias("rank")))
    cuts = parts.select("m", "_pid", "_start", "_pw", "_n", F.inline(ranks)).where(
        (F.col("rank") > F.col("_start")) & (F.col("rank") <= F.col("_start") + F.col("_pw")))
    cuts = cuts.select(F.col("m").alias("_c_m"), F.col("_pid").alias("_c_pid"), (F.col("rank") - F.col("_start")).alias("_at"), "s", "_n")
    # the cuts are k - 1 rows a measure: their ranges are filtered before rows are numbered
    ranges = F.broadcast(cuts.select(F.col("_c_m").alias("_r_m"), F.col("_c_pid").alias("_r_pid")).distinct())
    numbered = tagged.join(ranges, (F.col("m") == F.col("_r_m")) & (F.col("_pid") == F.col("_r_pid")), "left_semi").withColumn(
        "_no", F.row_number().over(Window.partitionBy("m", "_pid").orderBy("v", "t")))
    found = numbered.join(F.broadcast(cuts), (F.col("m") == F.col("_c_m")) & (F.col("_pid") == F.col("_c_pid")) & (F.col("_no") == F.col("_at")))
    return found.agg(F.max("_n").alias("_n"), *[
        F.array_sort(F.collect_list(F.when(F.col("m") == i, F.struct("v", "t")))).alias(f"_cut_{m}") for i, m in enumerate(measures)])


def rank_bin(measure: str, tie: str) -> Column:
    """The bin, from 1, of a row that has met the row of ``rank_cuts``; 3 if it is the only row."""
    own = F.struct(F.col(measure).cast("double").alias("v"), F.col(tie).alias("t"))
    return F.when(F.col("_n") > 1, 1 + F.size(F.filter(f"_cut_{measure}", lambda x: own >= x))).otherwise(3).cast("int")


def quantile_band(df: DataFrame, value: str, k: int, labels: Sequence[str] | None = None,
                  name: str = "band", ord_name: str | None = None) -> DataFrame:
    """``qcut``: k equal-count bins on exact value quantiles.

    Bins are right-closed with the lowest edge included; rows outside the
    edges (only nulls) get null.  Edges come from one aggregate row that is
    broadcast (size fixed by ``k``).  Two equal edges would leave a bin empty:
    that is an error, as it is for the original's quantile bins.
    """
    probs = [i / k for i in range(k + 1)]
    edges = exact_quantiles(df, value, probs, name="_e")
    x = F.col(value)
    idx = F.lit(1)
    for i in range(1, k):
        idx = idx + F.when(x > F.col(f"_e{i}"), 1).otherwise(0)
    repeated = F.lit(False)
    for i in range(k):
        repeated = repeated | (F.col(f"_e{i}") == F.col(f"_e{i + 1}"))
    inside = (x >= F.col("_e0")) & (x <= F.col(f"_e{k}"))
    ordinal = F.when(repeated, F.raise_error(F.lit(f"quantile bins of {value}: two edges are equal")).cast("int")).when(inside, idx)
    out = df.crossJoin(F.broadcast(edges)).withColumn(ord_name or f"{name}_ord", ordinal)
    if labels is not None:
        arr = F.array(*[F.lit(s) for s in labels])
        out = out.withColumn(name, F.when(ordinal.isNotNull(), F.element_at(arr, ordinal)))
    return out.drop(*[f"_e{i}" for i in range(k + 1)])


def five_number(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Box-plot numbers per group: min, q1, median, q3, max."""
    q = exact_quantiles(df, value, [0.0, 0.25, 0.5, 0.75, 1.0], by=by, name="_f")
    return q.select(
        *by,
        F.col("_f0").alias("min"), F.col("_f1").alias("q1"), F.col("_f2").alias("median"),
        F.col("_f3").alias("q3"), F.col("_f4").alias("max"),
    )
