"""SimHash near-duplicates by pigeonhole blocks (operator 10).

Each text's fingerprint takes one bit from each position's majority over
the XXH64 of its word shingles.  A 64-bit fingerprint is cut into six
blocks; two fingerprints that differ in at most four bits agree in two
blocks or more, so each of the 15 pairs of blocks serves as a join key of
about 21 bits.  Fingerprints that share a key meet in one sorted run and
are verified by their Hamming distance.

Work is on *distinct* fingerprints, so exact copies, however many, are one
row.  A key that holds more than ``RUN`` fingerprints (a large group of
near copies) is dealt in chunks, and each pair of chunks is a run of its
own, so no run grows beyond ``2 * RUN``.  A run's verified links are
reduced to a spanning forest before they leave the task: the components
are the same, and the output stays linear in the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import column_of, connected_components, forest, text_slices, whole_runs, words_of, written

#: Fingerprints of a key that are compared in one run without being dealt in chunks.
RUN = 2048


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of all word shingles of texts back to back, and the
    first shingle of each text with the count at the end.  Words are
    lower-cased (A-Z only) and joined by one space; a text of fewer words has
    one shingle of all its words, a text without words has none."""
    starts, ends, first = words_of(data, offsets)
    low = np.where((data >= 65) & (data <= 90), data + 32, data)
    # the words, and one byte behind each that its text goes on after, as a space
    last = np.zeros(len(data) + 1, bool)
    last[offsets] = True
    behind = ends[~last[ends]]
    keep = (data != 32) & ((data < 9) | (data > 13))
    keep[behind] = True
    low[behind] = 32
    place = np.cumsum(keep) - 1
    text = low[keep].tobytes()
    n_words = np.diff(first)
    n = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    bound = np.concatenate(([0], np.cumsum(n)))
    doc = np.repeat(np.arange(len(n)), n)
    left = first[:-1][doc] + np.arange(bound[-1]) - bound[:-1][doc]
    right = np.minimum(left + width, first[1:][doc]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = [digest(text[s:e], 42) for s, e in zip(place[starts[left]].tolist(), (place[ends[right] - 1] + 1).tolist())]
    return np.array(hashes, np.uint64), bound


def majority(hashes: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """A fingerprint for each text: bit 1 where over half its hashes have it; 0 without hashes."""
    n = np.diff(bound)
    out = np.zeros(len(n), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, bound[:-1][some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * ones > n[some][:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, key: list[str], text: str = "text", width: int = 4) -> DataFrame:
    """``key`` columns and ``fp`` (long, the fingerprint's 64 bits) for each row.

    A null or empty text, or one without words, has fingerprint 0.  Repeated
    rows are kept, other columns of ``docs`` are not read."""
    frame = docs.select(*key, F.col(text).alias("__text"))
    schema = frame.drop("__text").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "__text"):
                fp = majority(*shingle_hashes(data, offsets, width)).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(column_of(batch, k, rows) for k in key), pa.array(fp)], [*key, "fp"])

    return frame.mapInArrow(run, schema)


def _blocks(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of ``distance + 2`` blocks of 64 bits."""
    n = distance + 2
    cuts = [round(i * 64 / n) for i in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def fingerprint_links(distinct: DataFrame, distance: int = 4, run: int = RUN) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``distinct.fp``
    that differ in at most ``distance`` bits; each link is such a pair or joins
    two members of one component."""
    blocks = _blocks(distance)
    bits = [F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in blocks]
    keys = [F.shiftleft(F.shiftleft(bits[i], 16).bitwiseOR(bits[j]), 6).bitwiseOR(F.lit(n))
            for n, (i, j) in enumerate(combinations(range(len(blocks)), 2))]
    keyed = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = keyed.groupBy("key").count().where(F.col("count") > run).select(
        "key", F.ceil(F.col("count") / run).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    dealt = (keyed.join(hot, "key", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
             .withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run_of, table in whole_runs(batches, ("key", "i", "j")):
            fp = table["fp"].to_numpy()
            a, b = close_pairs(run_of, fp.view(np.uint64), distance)
            if len(a):
                root = forest(a, b, len(fp))
                node = np.flatnonzero(root != np.arange(len(fp)))
                links = np.unique(np.stack([fp[node], fp[root[node]]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], ["a", "b"])

    together = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return together.mapInArrow(verify, "a long, b long")


def close_pairs(run_of: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of one run that differ in at most ``distance``
    bits.  Pairs are taken by their lag; when many have gathered they are
    thinned to a spanning forest, which keeps the components."""
    n = len(fp)
    alive, lag, found, gathered = np.arange(n - 1), 0, [], 0
    while len(alive):
        lag += 1
        alive = alive[alive + lag < n]
        alive = alive[run_of[alive] == run_of[alive + lag]]
        near = alive[np.bitwise_count(fp[alive] ^ fp[alive + lag]) <= distance]
        if len(near):
            found.append((near, near + lag))
            gathered += len(near)
            if gathered > 4 * n + 100_000:
                root = forest(*(np.concatenate(x) for x in zip(*found)), n)
                node = np.flatnonzero(root != np.arange(n))
                found, gathered = [(node, root[node])], len(node)
    if not found:
        return np.empty(0, int), np.empty(0, int)
    return tuple(np.concatenate(x) for x in zip(*found))


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4,
                   distance: int = 4) -> DataFrame:
    """Every row's ``key``, ``fp`` and ``component``: the smallest key (long)
    that links reach, the row's own included.

    Rows without words share fingerprint 0 and link like any others.  A null
    key never names a component: it gets its group's smallest key, or null if
    the whole group has none.  Repeated rows stay repeated.  An empty table
    gives an empty result."""
    prints = written(fingerprints(docs.select(F.col(key).alias("__key"), F.col(text).alias("__t")), ["__key"], "__t", width), "simhash")
    owners = prints.groupBy("fp").agg(F.min("__key").alias("low"))
    groups = connected_components(fingerprint_links(prints.select("fp").distinct(), distance), "a", "b")
    # written before they meet, so that Spark can split a group that holds a third of the fingerprints
    named = written(owners.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("group")), "simhash-named")
    smallest = written(named.groupBy("group").agg(F.min("low").alias("component")), "simhash-smallest")
    of_print = named.join(smallest, "group").select("fp", "component")
    return prints.join(of_print, "fp").select(F.col("__key").alias(key), "fp", "component")


def hex16(fp: str) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4,
                     distance: int = 4) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the
    smallest key, nulls last, then the smallest digest of its text.

    Rows that agree in key and text count as one row repeated, and the one
    with the smallest other columns stays.  All columns come back as they
    were, whatever their names."""
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(names)])
    k, t = f"__c{names.index(key)}", f"__c{names.index(text)}"
    rows = rows.withColumn("__digest", F.md5(F.coalesce(F.concat(F.lit("+"), t), F.lit("-")).cast("binary")))
    prints = written(fingerprints(rows, [k, "__digest"], t, width), "simhash")
    links = fingerprint_links(prints.select("fp").distinct(), distance)
    groups = connected_components(links, "a", "b")
    first = prints.groupBy("fp").agg(
        F.min(F.struct(F.col(k).isNull().alias("none"), F.col(k).alias("key"), F.col("__digest").alias("digest"))).alias("row"))
    chosen = (first.join(groups, F.col("fp") == F.col("node"), "left")
              .groupBy(F.coalesce("component", "fp").alias("group")).agg(F.min("row").alias("row"))
              .select(F.col("row.key").alias("w_key"), F.col("row.digest").alias("w_digest")))
    times = prints.groupBy(F.col(k).alias("n_key"), F.col("__digest").alias("n_digest")).agg(F.count("*").alias("times"))
    chosen = written(chosen.join(times, F.col("w_key").eqNullSafe(F.col("n_key")) & (F.col("w_digest") == F.col("n_digest")))
                     .select("w_key", "w_digest", "times"), "simhash-kept")
    on = (F.col("__digest") == F.col("w_digest")) & F.col(k).eqNullSafe(F.col("w_key"))
    cols = [c for c in rows.columns if c != "__digest"]
    single = rows.join(chosen.where("times = 1"), on, "left_semi").select(*cols)
    # rows repeated as a whole: only these are gathered by their key and digest
    rest = [c for c in cols if c not in (k, t)]
    again = (rows.join(chosen.where("times > 1"), on, "left_semi").groupBy(k, "__digest")
             .agg(F.min(F.struct(*rest)).alias("__rest") if rest else F.lit(0).alias("__rest"), F.min(t).alias(t))
             .select(*[F.col(c) if c in (k, t) else F.col(f"__rest.{c}").alias(c) for c in cols]))
    return single.unionByName(again).select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(names)])
