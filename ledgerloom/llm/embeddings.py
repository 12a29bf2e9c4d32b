"""Embedding near-duplicates by a pivot-permutation index (operator 6).

Reference points (pivots) are picked from a bounded sample, far apart from
one another.  Every vector is described by its ``NEAREST`` pivots in order
of distance.  Two near copies rank nearly the same pivots first, so vectors
are retrieved through inverted lists of *pairs* of pivots: two vectors meet
exactly if they share at least two of their nearest ones.  In a list each
meeting is verified by its cosine in double precision; one that several
lists bring counts in that of its two smallest shared pivots only.

Equal vectors are one row with a count, so copies, however many, cost
nothing.  A list of more than ``CHUNK`` vectors (a large group of near
copies) is dealt in chunks, each pair of chunks a run of its own; no list is
capped.  A run gives a row for each vector that has a link there: how many
vectors it links with, and the smallest node it reaches.  Pairs never leave
a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import connected_components, forest, smallest_hashes, whole_runs, written

#: Pivots that describe a vector; vectors that share two of them are compared.
NEAREST = 8
#: Pivots: four times the root of the number of vectors, between these bounds, picked from at most four times as many vectors.
FEWEST, MOST = 64, 2048
CHUNK = 1024


def unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x /= np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def pick_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the sample's vectors, in order, that aren't close to one
    picked before; closer ones only as far as there are too few."""
    x = unit(sample)
    picked = np.zeros(len(x), bool)
    for limit in (0.7, 0.9, 0.99):
        near = np.abs(x @ x[picked].T).max(1, initial=0) if picked.any() else np.zeros(len(x))
        for i in range(len(x)):
            if not picked[i] and near[i] < limit and picked.sum() < n:
                picked[i] = True
                near = np.maximum(near, x @ x[i])
        if picked.sum() >= min(n, FEWEST):
            break
    return x[picked]


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def nearest_pivots(vectors: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """``vectors`` (node, times, length, v) with ``near``: their nearest pivots, closest first."""
    k = min(NEAREST, len(pivots))
    schema = T.StructType([*vectors.schema.fields, T.StructField("near", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = unit(_matrix(batch.column("v"), width)) @ pivots.T
                top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                top = np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable"), 1).astype(np.int32)
                near = pa.ListArray.from_arrays(pa.array(np.arange(0, top.size + 1, k), pa.int32()), pa.array(top.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, near], schema.names)

    return vectors.mapInArrow(run, schema)


def links_of_run(node: np.ndarray, times: np.ndarray, length: np.ndarray, own: np.ndarray, x: np.ndarray, near: np.ndarray,
                 p: int, q: int, apart: bool, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, links, smallest node reached) of the vectors of a run that link
    there.  ``apart``: only with vectors of the other chunk."""
    n = len(node)
    a, b = np.nonzero(np.triu(x @ x.T >= least, 1))
    ok = length[a] == length[b]
    if apart:
        ok &= own[a] != own[b]
    a, b = a[ok], b[ok]
    once = np.empty(len(a), bool)
    ranked = np.sort(near, axis=1)
    for i in range(0, len(a), 1 << 15):
        one, two = ranked[a[i : i + (1 << 15)]], ranked[b[i : i + (1 << 15)]]
        shared = (one[:, :, None] == two[:, None, :]).any(2)
        # the run is that of the two smallest shared pivots if nothing below q is shared but p
        once[i : i + (1 << 15)] = ~(shared & (one < q) & (one != p)).any(1)
    a, b = a[once], b[once]
    links = np.bincount(a, times[b], n) + np.bincount(b, times[a], n)
    low = np.arange(n)
    order = np.argsort(node)  # smallest node, not smallest position
    rank = np.empty(n, int)
    rank[order] = low
    root = order[forest(rank[a], rank[b], n)[rank]]
    some = np.flatnonzero(links)
    return node[some], links[some].astype(np.int64), node[root[some]]


def near_copies(vectors: DataFrame, width: int, n_pivots: int, least: float = 0.95, chunk: int = CHUNK) -> DataFrame:
    """(node, links, low) rows of distinct vectors (node, times, length, v),
    ``v`` padded to ``width``: partial counts of links and nodes reached."""
    hashed = vectors.select("v", "node", F.xxhash64("v").alias("h"))
    sample = smallest_hashes(hashed, "h", 4 * n_pivots, vectors.count(), "node").select("v").toArrow().column("v")
    pivots = pick_pivots(_matrix(sample, width), n_pivots)
    near = written(nearest_pivots(vectors, pivots, width), "pivots")
    ordered = F.sort_array("near")
    if len(pivots) > 1:
        pairs = F.flatten(F.transform(ordered, lambda p, i: F.transform(F.slice(ordered, i + 2, F.lit(NEAREST)), lambda q: F.struct(p.alias("p"), q.alias("q")))))
    else:
        pairs = F.array(F.struct(F.lit(0).alias("p"), F.lit(0).alias("q")))
    keyed = near.select("*", F.explode(pairs).alias("key")).select("*", "key.p", "key.q").drop("key")
    hot = (near.select(F.explode(pairs).alias("key")).groupBy("key.p", "key.q").agg(F.count("*").alias("n")).where(F.col("n") > chunk)
           .select("p", "q", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")))
    dealt = (keyed.join(hot, ["p", "q"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
             .withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("p", "q", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "times", "length", "v", "near"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run_of, table in whole_runs(batches, ("p", "q", "i", "j")):
            x = unit(_matrix(table["v"], width))
            tops = _matrix(table["near"], min(NEAREST, len(pivots)))
            node, times, length, own, p, q, i, j = (table[c].to_numpy() for c in ("node", "times", "length", "own", "p", "q", "i", "j"))
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(run_of)) + 1, [len(run_of)]))
            found = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b - a > 1:
                    s = slice(a, b)
                    got = links_of_run(node[s], times[s], length[s], own[s], x[s], tops[s], p[a], q[a], i[a] != j[a], least)
                    if len(got[0]):
                        found.append(got)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["node", "links", "low"])

    return dealt.repartition("p", "q", "i", "j").sortWithinPartitions("p", "q", "i", "j").mapInArrow(run, "node long, links long, low long")


def embedding_groups(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.95) -> DataFrame:
    """Every row's ``key``, ``n_links`` (other rows within ``least`` cosine
    that the index finds), ``component_id`` (smallest key reachable, itself
    included) and ``kept`` (whether that is its own).

    Vectors that are null, empty, zero, or hold null or non-finite parts link
    with nothing; vectors of different lengths don't link.  Repeated rows are
    rows of their own that link.  A null key names no component: its row has
    the smallest key of its group, null and not kept if there is none."""
    rows = vectors.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    fine = (F.size("v") > 0) & F.forall("v", lambda a: a.isNotNull() & (F.abs(a) < float("inf")) & ~F.isnan(a)) & F.exists("v", lambda a: a != 0)
    rows = written(rows.withColumn("v", F.when(fine, F.col("v"))), "vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0]
    distinct = rows.where("v is not null").groupBy("v").agg(F.count("*").alias("times"), F.min("id").alias("low_id"))
    distinct = written(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct")
    n = distinct.count()
    if n:
        padded = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v")))
        part = distinct.select("node", "times", F.size("v").alias("length"), padded.alias("v"))
        found = written(near_copies(part, width, int(min(max(4 * n**0.5, FEWEST), MOST)), least), "links")
    else:
        found = rows.sparkSession.createDataFrame([], "node long, links long, low long")
    counts = found.groupBy("node").agg(F.sum("links").alias("links")).withColumnRenamed("node", "l_node")
    groups = connected_components(found, "node", "low").withColumnRenamed("node", "g_node")
    named = (distinct.join(counts, F.col("node") == F.col("l_node"), "left").join(groups, F.col("node") == F.col("g_node"), "left")
             .select("v", "low_id", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "node").alias("group")))
    smallest = named.groupBy("group").agg(F.min("low_id").alias("component_id"))
    of_vector = named.join(smallest, "group").select(F.col("v").alias("d_v"), "n_links", "component_id")
    return rows.join(of_vector, F.col("v") == F.col("d_v"), "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"))
