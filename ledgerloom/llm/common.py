"""Helpers shared by the operators: written tables, Arrow batches, words, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import ensure_checkpoint_dir

#: Bytes of text that a kernel works on at a time; a longer single text is a slice of its own.
SLICE_BYTES = 1 << 20


#: What Spark hands to Python at a time, where the caller chose nothing: its own 10,000 rows or 64 MB are held by
#: the executor and by the worker at once, by each task.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def bound_batches(spark: SparkSession) -> None:
    chosen = spark.conf.getAll
    for key, value in BATCHES.items():
        if key not in chosen:
            spark.conf.set(key, value)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder of ``spark.checkpoint.dir`` and read
    back: lineage ends there, and the columns stay prunable.  Any executor can
    read the files again after another is lost."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def smallest_hashes(rows: DataFrame, hash_: str, n: int, total: int, *ties: str) -> DataFrame:
    """The ``n`` rows of smallest 64-bit hash among ``total``.  Hashes are
    spread evenly, so all but about 1.5 n rows go before any is sorted: no
    task gathers ``n`` rows from each partition."""
    share = min(1.0, (1.5 * n + 200) / max(total, 1))
    below = F.col(hash_) <= F.lit(int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1)
    return rows.where(below).orderBy(hash_, *ties).limit(n)


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows of a batch in slices of about ``SLICE_BYTES``: (row slice, the
    texts' UTF-8 bytes back to back, offsets).  A null text is an empty one."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
        to = min(to, n)
        yield slice(at, to), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def runs_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes that are ``inside``, in texts that lie back to back:
    (start, end, first run of each text and the count at the end)."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words: runs without space and U+0009 to U+000D."""
    return runs_of((data != 32) & ((data < 9) | (data > 13)), offsets)


_POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs that don't overlap, by powers of an odd number."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    at = np.arange(first[-1] + lengths[-1]) - np.repeat(first, lengths)
    values = (data[at + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)) * _POWERS[at & 4095]
    return mix(np.add.reduceat(values, first))


def column_of(batch: pa.RecordBatch, name: str, rows: slice) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name)).slice(rows.start, rows.stop - rows.start)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """From batches sorted by ``keys``: tables that never cut a run of equal
    keys, each with its rows' run numbers (0, 1, ...)."""
    def numbered(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        for k in keys:
            c = table[k].to_numpy()
            new[1:] |= c[1:] != c[:-1]
        return np.cumsum(new)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        run_of = numbered(table)
        if cut := int(np.searchsorted(run_of, run_of[-1])):
            yield run_of[:cut], table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield numbered(table), table


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of each node's component, for nodes 0 to n - 1 and links a-b."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := root[root], root):
            root = up


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): for each node that has a link, the smallest node
    reachable.  ``links`` holds pairs of longs; loops, nulls and repeats are
    allowed and add nothing.

    Alternating large and small stars: each round hooks every node to the
    smallest of its neighbourhood, so the number of rounds grows with the
    logarithm of the longest path.  Minima are combined before the shuffle,
    the joins back to the links are plain equi-joins whose hot keys AQE
    splits, and each round's links are written to the shared folder.  The
    driver sees two numbers a round, to find that nothing changed.
    """
    spark = links.sparkSession
    edges = written(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).distinct(),
        "links")
    sign = _signature(edges)
    for _ in range(max_rounds):
        if not sign[0]:
            break
        # minima are written before they meet the links, so that both sides of a
        # join come straight from a shuffle: then Spark splits a hot centre's rows
        both = edges.union(edges.select("v", "u"))
        low = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "links")
        # large star: the larger neighbours of u hang below the least of its neighbourhood
        large = written(both.join(low, "u").where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m")))
                        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        # small star: u and its smaller neighbours hang below the least of them
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "links")
        small = (large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        edges = written(small, "links")
        before, sign = sign, _signature(edges)
        if sign == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
