"""Mixing sources to target weights by hash-threshold histograms (operator 2).

A source's target is reached by whole passes over its documents and a part
of one more.  That part is the documents whose hash lies below a threshold.
The threshold is found without sorting: sizes are summed by source and hash
bucket, the bucket in which the running sum passes the budget is the only
one that the next level splits, and after five levels of 12 bits a bucket
is a single hash.  Histograms are at most sources x 4096 rows, thresholds
one row per source; the documents are filtered by comparing their hash.  Rows
that repeat one document share a hash; where a budget ends among them, they
are numbered, by the files they lie in, and as many as fit are taken.

Everything is DataFrame code; the order of rows and the number of
partitions change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
BITS, LEVELS = 12, 5


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(key: str, text: str) -> Column:
    """60 bits of the MD5 of a row's key and text.  Rows that agree in both
    are the same document repeated."""
    seed = F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(seed.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_size, target) of rows (source, size).

    Sources by code point, null last, weigh ``weights`` in turn and share the
    sum of all sizes; a target above ``cap`` times its source's size stops
    there and the excess goes to the others by weight.  The sources that stop
    are those of least size for their weight, so they are found by running
    sums over the sources (one row each) in that order."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*map(F.lit, weights))
    sources = sources.withColumn("weight", F.element_at(turn, (F.row_number().over(by_name) - 1) % len(weights) + 1).cast("long"))
    everything = Window.partitionBy()
    by_need = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.col("source_size") * cap
    sources = (sources
               .withColumn("left", F.sum("source_size").over(everything) - F.sum(full).over(by_need.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + full)
               .withColumn("load", F.sum("weight").over(everything) - F.sum("weight").over(by_need.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("weight"))
               .withColumn("stops", F.col("weight") * F.col("left") > full * F.col("load")))
    share = F.min(F.when(~F.col("stops"), F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source", "left", "load"))).over(everything)
    return sources.withColumn("share", share).select(
        "source", "source_size",
        F.when(F.col("stops"), full.cast("double"))
        .otherwise((F.col("weight") * F.col("share.left")).cast("double") / F.col("share.load").cast("double")).alias("target"))


def source_thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``passes`` (whole passes over the source), and what
    gets one more copy: the rows (source, size, hash) whose hash is less than
    ``below``, and ``some`` of the ``alike`` rows that have this very hash."""
    ratio = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = targets.withColumn("passes", ratio).withColumn("budget", F.col("target") - F.col("passes") * F.col("source_size"))
    bucket = plan.select("source", F.lit(0).cast("long").alias("prefix"), "budget")
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        inside = rows.alias("r").join(bucket.alias("b"), F.col("r.source").eqNullSafe(F.col("b.source")) & (F.shiftright("hash", shift + BITS) == F.col("prefix")))
        sums = (inside.groupBy("b.source", "prefix", "budget", F.shiftright("hash", shift).alias("part"))
                .agg(F.sum("size").alias("n"), F.count("*").alias("alike")))
        running = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumn("upto", F.sum("n").over(running)).where(F.col("upto") > F.col("budget"))
        bucket = sums.groupBy("source").agg(F.min(F.struct("part", "upto", "n", "alike", "budget")).alias("x")).select(
            "source", F.col("x.part").alias("prefix"), (F.col("x.budget") - (F.col("x.upto") - F.col("x.n"))).alias("budget"),
            F.col("x.n").alias("n"), F.col("x.alike").alias("alike"))
    # the last bucket is one hash, its rows are alike: as many as come nearest to the budget
    some = F.floor((2 * F.col("budget") * F.col("alike") + F.col("n")) / (2 * F.col("n"))).cast("long")
    last = bucket.select(F.col("source").alias("s"), F.col("prefix").alias("below"), "alike", some.alias("some"))
    zero = F.lit(0).cast("long")
    return plan.join(last, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "passes", F.coalesce("below", zero).alias("below"), F.coalesce("alike", zero).alias("alike"), F.coalesce("some", zero).alias("some"))


def _numbered(rows: DataFrame, source: str) -> DataFrame:
    """``rows`` with ``no``: 1, 2, ... among the rows of their ``source``.  Rows
    are numbered within the files they are written to (no task holds more than
    one), and those of earlier files are counted before."""
    held = written(rows.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "mix-alike")
    sizes = held.groupBy(F.col(source).alias("n_source"), F.col("part").alias("n_part")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("n_source").orderBy("n_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy("part", source).orderBy("at"))
    return (held.withColumn("inside", inside).join(before, F.col(source).eqNullSafe(F.col("n_source")) & (F.col("part") == F.col("n_part")))
            .withColumn("no", F.col("inside") + F.col("before")).drop("part", "at", "inside", "n_source", "n_part", "before"))


def _planned(docs: DataFrame, key: str, source: str, text: str, weights: tuple[int, ...], cap: int) -> DataFrame:
    """Columns ``c0``, ``c1``, ... of ``docs`` with size, source_size, target and copies."""
    names = docs.columns
    k, s, t = (f"c{names.index(c)}" for c in (key, source, text))
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    read = plain.withColumns({"size": word_count(t), "hash": row_hash(k, t), "s": F.col(s).cast("string")})
    rows = written(read.select(F.col("s").alias("source"), "size", "hash"), "mix")
    plan = written(source_thresholds(rows, source_targets(rows, weights, cap)), "mix-plan")
    out = read.join(plan, F.col("s").eqNullSafe(F.col("source")))
    more = F.when(F.col("hash") < F.col("below"), 1).when((F.col("hash") == F.col("below")) & (F.col("some") == F.col("alike")), 1).otherwise(0)
    columns = [*plain.columns, "size", "source_size", "target"]
    dealt = (F.col("some") > 0) & (F.col("some") < F.col("alike"))
    if plan.where(dealt).isEmpty():
        return out.select(*columns, F.least(F.col("passes") + more, F.lit(cap)).cast("int").alias("copies"))
    tied = dealt & (F.col("hash") == F.col("below"))
    numbered = _numbered(out.where(tied), "source")
    more_of_tied = F.when(F.col("no") <= F.col("some"), 1).otherwise(0)
    return (out.where(~tied).select(*columns, F.least(F.col("passes") + more, F.lit(cap)).cast("int").alias("copies"))
            .union(numbered.select(*columns, F.least(F.col("passes") + more_of_tied, F.lit(cap)).cast("int").alias("copies"))))


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
          weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``docs`` with ``__size`` (words), ``__source_size``, ``__target`` and
    ``__copies`` (how often the mix takes the row, 0 to ``cap``); columns that
    have these names are replaced.

    A null text has no words; rows without words cost nothing and follow
    their hash like others.  A null source is a source of its own, after all
    others.  Rows that agree in key and text get the same number of copies,
    but for those among which a source's budget ends: of them, as many as fit
    get one more.  An empty table gives an empty result."""
    out = _planned(docs, key, source, text, weights, cap)
    added = ("__size", "__source_size", "__target", "__copies")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in added],
                      *[F.col(c[2:]).alias(c) for c in added])


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
        weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its copies say."""
    out = _planned(docs, key, source, text, weights, cap)
    return out.withColumn("n", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
