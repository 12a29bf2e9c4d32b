"""Filter interaction audit by a table-driven byte transducer (operator 13).

What every order of the filters would remove, keep and lose, from one look at
each text.

*Transducer.*  A finite-state machine over UTF-8 bytes: a byte's class and
the state before it pick a cell of ``EMITS``, which says whether a code point,
a word, a capital or a symbol begins there, or a word has ended.  The state
after a byte depends on its class alone (a continuation byte lies inside a
word), so a whole slice of texts goes through the table at once.

*Verified hash table.*  The spans of the words go into an open-addressing
table of their text: a span that meets one of equal hash and length in its
slot is compared with it byte by byte, and moves on if they differ.  Spans
that found a free slot are the text's distinct words, without any doubt
about collisions.

*Audit.*  A document is then a handful of numbers.  The one filter that looks
across documents (an equal text under a smaller key) is a combinable minimum
by the text's 128-bit digest and an equi-join on (digest, key), so a group of
copies spreads by its keys.  Documents are counted by part, failed filters
and labels, at most ``parts x 2^filters x 4`` rows; all orders are worked out
on these counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SLICE_BYTES, column_of, run_hashes, text_slices, written

SYMBOLS = "#$%&*|"
#: Byte classes and the states that they lead to; emitted are (bits) a code
#: point, the first byte of a word, the byte after a word, a capital, a symbol.
GAP, LETTER, CAPITAL, SYMBOL, CONTINUATION = range(5)
CODE_POINT, BEGINS, ENDED, IS_CAPITAL, IS_SYMBOL = 1, 2, 4, 8, 16


def byte_classes(symbols: str = SYMBOLS) -> np.ndarray:
    """The class of each byte; symbols are ASCII."""
    out = np.full(256, LETTER, np.uint8)
    out[0x80:0xC0] = CONTINUATION
    out[[0x20, *range(0x09, 0x0E)]] = GAP
    out[0x41:0x5B] = CAPITAL
    out[[ord(c) for c in symbols]] = SYMBOL
    return out


def _emits() -> np.ndarray:
    """What each (class before, class) cell emits; before a text stands a gap."""
    table = np.zeros((5, 5), np.uint8)
    for before in range(5):
        for now in range(5):
            out = 0 if now == CONTINUATION else CODE_POINT
            if before == GAP and now != GAP:
                out |= BEGINS
            if before != GAP and now == GAP:
                out |= ENDED
            table[before, now] = out | {CAPITAL: IS_CAPITAL, SYMBOL: IS_SYMBOL}.get(now, 0)
    return table.ravel()


EMITS = _emits()


def transduce(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts back to back: (starts, ends) of their words, and a row (code
    points, capitals, symbols) for each text.  The machine runs over
    ``SLICE_BYTES`` at a time and carries its state on."""
    n, counts = len(data), np.zeros((len(offsets) - 1, 3), np.int64)
    starts, ends, state = [], [], GAP
    for at in range(0, n, SLICE_BYTES):
        now = classes[data[at : at + SLICE_BYTES]]
        before = np.empty_like(now)
        before[0], before[1:], state = state, now[:-1], now[-1]
        edge = np.unique(offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, at + len(now))]) - at
        cut = edge[before[edge] != GAP] + at  # a text's last word ends where the next text begins
        before[edge] = GAP
        out = EMITS[before * 5 + now]
        starts.append(np.flatnonzero(out & BEGINS) + at)
        ends.append(np.sort(np.concatenate((np.flatnonzero(out & ENDED) + at, cut))))
        for i, bit in enumerate((CODE_POINT, IS_CAPITAL, IS_SYMBOL)):
            upto = np.searchsorted(np.flatnonzero(out & bit) + at, offsets)
            counts[:, i] += np.diff(upto)
    if n and state != GAP:
        ends.append(np.array([n]))
    empty = [np.empty(0, np.int64)]
    return np.concatenate(starts or empty), np.concatenate(ends or empty), counts


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the bytes from ``a`` and from ``b`` agree over ``length``, pair by pair."""
    out = np.empty(len(a), bool)
    upto = np.cumsum(length)
    at = 0
    while at < len(a):  # as many pairs at a time as hold a slice's bytes
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SLICE_BYTES, side="right")))
        n = length[at:to]
        first = np.cumsum(n) - n
        inside = np.arange(int(n.sum())) - np.repeat(first, n)
        same = data[np.repeat(a[at:to], n) + inside] == data[np.repeat(b[at:to], n) + inside]
        out[at:to] = np.logical_and.reduceat(same, first)
        at = to
    return out


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, hashes: np.ndarray | None = None) -> np.ndarray:
    """The spans that their owner holds first in the table: one for each
    distinct (owner, bytes).  ``hashes`` stand in for those of the bytes."""
    n = len(starts)
    if not n:
        return np.empty(0, np.int64)
    if hashes is None:
        edges = [0, *(np.flatnonzero(np.diff(starts // SLICE_BYTES)) + 1).tolist(), n]
        hashes = np.concatenate([run_hashes(data, starts[a:b], ends[a:b]) for a, b in zip(edges, edges[1:])])
    hashes = hashes ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    length = ends - starts
    size = 1 << (2 * n - 1).bit_length()
    slot = (hashes >> np.uint64(7)).astype(np.int64) & (size - 1)
    table, live, kept = np.full(size, -1, np.int64), np.arange(n), []
    while len(live):
        here = slot[live]
        free = table[here] < 0
        table[here[free]] = live[free]
        holder = table[here]
        mine = holder == live
        kept.append(live[mine])
        like = np.flatnonzero(~mine & (hashes[holder] == hashes[live]) & (owner[holder] == owner[live]) & (length[holder] == length[live]))
        done = mine
        if len(like):
            done[like] = _equal(data, starts[live[like]], starts[holder[like]], length[live[like]])
        live = live[~done]
        slot[live] = (slot[live] + 1) & (size - 1)
    return np.concatenate(kept)


_MEASURES = (("n_words", "long"), ("n_distinct", "long"), ("n_chars", "long"), ("n_capitals", "long"), ("n_symbols", "long"), ("d1", "long"), ("d2", "long"))


def measured(docs: DataFrame, keep: list[str], text: str, symbols: str = SYMBOLS) -> DataFrame:
    """The columns ``keep`` of every row with ``n_words``, ``n_distinct`` (words,
    case-sensitive), ``n_chars`` (code points), ``n_capitals``, ``n_symbols`` and
    the halves ``d1``, ``d2`` of the text's digest.  A null text is an empty one."""
    rows = docs.select(*keep, F.col(text).alias("__text"))
    schema = rows.drop("__text").schema
    for name, kind in _MEASURES:
        schema = schema.add(name, kind)
    classes = byte_classes(symbols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, "__text"):
                starts, ends, counts = transduce(data, offsets, classes)
                texts = len(offsets) - 1
                owner = np.searchsorted(offsets, starts, side="right") - 1
                words = np.bincount(owner, minlength=texts)
                distinct = np.bincount(owner[distinct_spans(data, starts, ends, owner)], minlength=texts)
                raw = data.tobytes()
                digest = np.frombuffer(b"".join([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]), ">i8")
                digest = digest.reshape(-1, 2).astype(np.int64)
                columns = (words, distinct, counts[:, 0], counts[:, 1], counts[:, 2], digest[:, 0].copy(), digest[:, 1].copy())
                yield pa.RecordBatch.from_arrays([*(column_of(batch, k, part) for k in keep), *map(pa.array, columns)], schema.names)

    return rows.mapInArrow(run, schema)


def default_filters() -> dict[str, Column]:
    """Failure conditions by letter over the measures and ``copy`` (an equal text has a smaller key)."""
    return {"A": F.col("n_words") < 200, "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"),
            "C": 100 * F.col("n_capitals") > 3 * F.col("n_chars"), "D": F.col("n_symbols") > 0, "E": F.col("copy")}


def failures(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang",
             filters: dict[str, Column] | None = None, symbols: str = SYMBOLS) -> DataFrame:
    """(id, part, mask, good, toxic) of every row of ``docs``: bit i of
    ``mask`` is set if the i-th filter fails, ``good`` and ``toxic`` if a label
    of its key says so (``quality`` = 1, ``toxic`` = 1).

    A null text is an empty one, a null part an empty string.  A null key is
    larger than none: it fails no copy filter and has no labels.  Rows that
    repeat key and text aren't copies of each other.  Repeated labels of a key
    count if one of them does."""
    filters = filters or default_filters()
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), F.col(f"`{text}`").alias("t"))
    rows = written(measured(rows, ["id", "part"], "t", symbols), "measures")
    least = written(rows.groupBy("d1", "d2").agg(F.min("id").alias("low")).select(F.col("d1").alias("l1"), F.col("d2").alias("l2"), "low"), "least")
    said = written(labels.groupBy(F.col(f"`{key}`").alias("l_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")), "labels")
    joined = rows.join(least, (F.col("d1") == F.col("l1")) & (F.col("d2") == F.col("l2")) & (F.col("id") == F.col("low")), "left")
    joined = joined.withColumn("copy", F.col("id").isNotNull() & F.col("low").isNull()).join(said, F.col("id") == F.col("l_id"), "left")
    mask = F.lit(0)
    for i, fails in enumerate(filters.values()):
        mask = mask + F.when(fails, 1 << i).otherwise(0)
    return joined.select("id", "part", mask.cast("int").alias("mask"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def orders(letters: str) -> Column:
    """An array of (filter_order, step, before, own): each step of each order,
    with the bits of the filters before it and its own."""
    steps = []
    for order in permutations(range(len(letters))):
        name = "".join(letters[i] for i in order)
        steps += [f"{name}:{s + 1}:{sum(1 << i for i in order[:s])}:{1 << i}" for s, i in enumerate(order)]
    each = F.transform(F.split(F.lit(",".join(steps)), ","), lambda x: F.split(x, ":"))
    return F.transform(each, lambda x: F.struct(x[0].alias("filter_order"), *[x[i].cast("int").alias(n) for i, n in ((1, "step"), (2, "before"), (3, "own"))]))


def audit(failed: DataFrame, letters: str) -> DataFrame:
    """One row for each part, order and step: ``kept``, ``removed``,
    ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost`` and
    ``shapley``, from the rows of ``failures``.  An empty table has no parts."""
    counted = written(failed.groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n")), "counts")
    rows = counted.withColumn("x", F.explode(orders(letters))).select("part", "mask", "good", "toxic", "n", "x.*")
    fails, before = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    removed = fails & ~before

    def total(condition: Column, n: Column | str = "n") -> Column:
        return F.sum(F.when(condition, F.col(n) if isinstance(n, str) else n).otherwise(0)).cast("long")

    # of a document's failing filters each comes first in an equal share of the orders
    share = F.col("n") * (F.lit(factorial(len(letters))) / F.greatest(F.bit_count("mask"), F.lit(1))).cast("long")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~before).alias("kept"), total(removed).alias("removed"), total(fails & before).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"), total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"), total(fails, share).alias("shapley"))
