"""Substring dedup by content-defined chunking (operator 7).

A gear hash rolls over each text's bytes; a chunk ends where five of its
bits are zero (bits that only the last 16 bytes reach), after ``SHORTEST``
bytes at least and ``LONGEST`` at most.  An insertion moves the ends near it
alone, so a passage that two documents share has the same chunks in both
but for its rim.  Text that repeats with a period may hold no such place
(a row or word written over and over); there chunks of ``LEAST_WORDS`` words
or more end at the word of least hash of a period, whatever stands before.
Chunks are deduplicated by a 128-bit digest: one that two
or more documents hold is repeated, and the smallest document is its owner.

Runs of neighbouring repeated chunks with ``LEAST_WORDS`` words or more are
the repeated passages; shorter ones (a common line, a licence's name) are
left alone.  Counts of a digest are combined before the shuffle and the
chunks meet them in an equi-join that AQE splits, so a passage that stands
in a third of all documents isn't gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import column_of, mix, text_slices, words_of

SHORTEST, LONGEST = 16, 512  # the shortest chunk holds the sixteen bytes that an end depends on
#: Words of a run of repeated chunks, at least: above the common lines of up to 16 words, and what is left of a passage of
#: 51 words without its rim in 98 of 100 cases (longer ones: more).
LEAST_WORDS = 18
_MASK = np.uint32(0b11111 << 11)
_GEAR = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """At each byte the rolling hash sum(gear[b] << age), modulo 2^32.  The
    bits of the mask lie below the sixteenth, so sixteen bytes settle them."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        older = np.concatenate((np.zeros(step, np.uint32), h[:-step])) if len(h) > step else np.zeros(len(h), np.uint32)
        h = h + (older << np.uint32(step))
    return h


def period_ends(h: np.ndarray, ends: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Of the words that ``begin`` between two ends, the numbers of those whose sixteen bytes
    before stood before two other words, at equal distances, and whose hash
    ``h`` is the least of a period.  All of that lies in the repeated text."""
    value = h[begin - 1].astype(np.int64)
    gap = np.searchsorted(ends, begin)
    order = np.argsort((gap << 32) | value, kind="stable")
    same = (gap[order][2:] == gap[order][:-2]) & (value[order][2:] == value[order][:-2])
    now, before, first = order[2:][same], order[1:-1][same], order[:-2][same]
    period = begin[now] - begin[before]
    even = (period == begin[before] - begin[first]) & (period <= LONGEST)
    now, before = now[even], before[even]
    if not len(now):
        return np.empty(0, np.int64)
    least = np.minimum.reduceat(np.append(value, 0), np.column_stack((before + 1, now + 1)).ravel())[::2]
    return np.sort(now[value[now] == least])


def cut(data: np.ndarray, offsets: np.ndarray, begin: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, end) of the chunks of texts back to back; an end doesn't split a character.

    A chunk that reaches ``LONGEST`` ends before the word of least hash in it,
    the last of several, or at ``LONGEST`` if no word begins in it.  Words
    ``begin`` where ``words_of`` says."""
    h = gear(data)
    ends = np.flatnonzero(h & _MASK == 0) + 1
    begin = words_of(data, offsets)[0] if begin is None else begin
    begin = begin[begin - offsets[np.searchsorted(offsets, begin, side="right") - 1] >= SHORTEST]
    periods = period_ends(h, ends, begin)
    word_at = {}  # the numbers of the words at ends that the hash didn't set
    if len(periods):
        word_at = dict(zip(begin[periods].tolist(), periods.tolist()))
        hashed, ends = ends, np.union1d(ends, begin[periods])
        for end in np.intersect1d(hashed, begin[periods]).tolist():
            del word_at[end]
    inside = (data & 0xC0) == 0x80
    texts, cuts = [], []
    at = np.searchsorted(ends, offsets)
    for n, (start, stop, a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), at[:-1].tolist(), at[1:].tolist())):
        last, mine, word = start, [], None
        for end in [*ends[a:b].tolist(), stop]:
            if end in word_at and word is not None and word_at[end] - word < LEAST_WORDS:
                continue
            while end - last > LONGEST:
                least, most = np.searchsorted(begin, (last + SHORTEST, last + LONGEST + 1))
                word = int(most - 1 - np.argmin(h[begin[least:most][::-1] - 1])) if most > least else None
                last = last + LONGEST if word is None else int(begin[word])
                while last < stop and inside[last]:
                    last += 1
                mine.append(last)
            if end - last >= SHORTEST or end == stop:
                while end < stop and inside[end]:
                    end += 1
                if end > last:
                    mine.append(end)
                    last, word = end, word_at.get(end)
        cuts += mine
        texts += [n] * len(mine)
    return np.array(texts, np.int64), np.array(cuts, np.int64)


def chunks(rows: DataFrame, key: list[str], text: str) -> DataFrame:
    """``key`` columns with (start, size, words, hi, lo) of every chunk: bytes
    of the text's UTF-8 form, words that begin in it, and the digest's halves."""
    frame = rows.select(*key, F.col(text).alias("__text"))
    schema = frame.drop("__text").schema
    for name, kind in (("start", "integer"), ("size", "integer"), ("words", "integer"), ("hi", "long"), ("lo", "long")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows_, data, offsets in text_slices(batch, "__text"):
                begin = words_of(data, offsets)[0]
                owner, end = cut(data, offsets, begin)
                if not len(owner):
                    continue
                start = np.concatenate(([0], end[:-1]))
                fresh = np.concatenate(([True], owner[1:] != owner[:-1]))
                start[fresh] = offsets[owner[fresh]]
                raw, digest = data.tobytes(), xxhash.xxh3_128_digest
                sums = np.frombuffer(b"".join([digest(raw[a:b]) for a, b in zip(start.tolist(), end.tolist())]), ">i8").reshape(-1, 2).astype(np.int64)
                words = np.searchsorted(begin, end) - np.searchsorted(begin, start)
                columns = [(start - offsets[owner]).astype(np.int32), (end - start).astype(np.int32), words.astype(np.int32), sums[:, 0].copy(), sums[:, 1].copy()]
                yield pa.RecordBatch.from_arrays([*(column_of(batch, k, rows_).take(pa.array(owner)) for k in key), *map(pa.array, columns)], schema.names)

    return frame.mapInArrow(run, schema)


def _name(key: str, text: str) -> Column:
    return F.xxhash64(F.col(f"`{key}`").cast("string"), F.coalesce(F.col(f"`{text}`"), F.lit("")))


def _repeated_chunks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, doc, start, end, words, first_id, own, run, part) of the chunks that
    two or more documents hold: ``run`` numbers a document's runs of
    neighbours, ``part`` those within which ``own`` stays the same as well."""
    rows = docs.select(F.col(f"`{key}`").alias("id"), _name(key, text).alias("doc"), F.col(f"`{text}`").alias("t"))
    all_chunks = chunks(rows, ["id", "doc"], "t")
    repeated = (all_chunks.groupBy("hi", "lo")
                .agg(F.min("doc").alias("one"), F.max("doc").alias("other"),
                     F.min(F.struct(F.col("id").isNull().alias("none"), "id", "doc")).alias("first"))
                .where("one != other").select(F.col("hi").alias("r_hi"), F.col("lo").alias("r_lo"), F.col("first.id").alias("first_id"), F.col("first.doc").alias("first_doc")))
    found = all_chunks.join(repeated, (F.col("hi") == F.col("r_hi")) & (F.col("lo") == F.col("r_lo")))
    found = found.select("id", "doc", "start", (F.col("start") + F.col("size")).alias("end"), "words", "first_id", (F.col("doc") == F.col("first_doc")).alias("own")).distinct()
    order = Window.partitionBy("doc").orderBy("start")
    new = F.col("start") != F.coalesce(F.lag("end").over(order), F.lit(-1))
    turn = new | (F.col("own") != F.lag("own").over(order))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (found.withColumns({"new": new.cast("int"), "turn": turn.cast("int")})
            .withColumns({"run": F.sum("new").over(upto), "part": F.sum("turn").over(upto)}).drop("new", "turn"))


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(key, doc, start, end, words, first_keys, owned) of the repeated
    passages: byte spans, the keys that own their chunks (sorted, nulls
    left out) and whether this document owns them all.

    ``doc`` names a document by its key and text: rows that agree in both are
    one document repeated, not a passage repeated across documents.  A null
    key is a key; null and empty texts have no chunks.  An empty table gives
    an empty result."""
    return (_repeated_chunks(docs, key, text).groupBy("doc", "run")
            .agg(F.first("id").alias("id"), F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"),
                 F.array_sort(F.collect_set("first_id")).alias("first_keys"), F.min("own").alias("owned"))
            .where(F.col("words") >= least_words).select(F.col("id").alias(key), "doc", "start", "end", "words", "first_keys", "owned"))


def repeated_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """One row for each document that holds a repeated passage: the key,
    ``n_passages``, ``repeated_words``, ``first_<key>s`` (where the passages'
    chunks stand first) and ``spans`` (start:end in bytes, comma-joined)."""
    runs = repeated_runs(docs, key, text, least_words)
    spans = F.array_sort(F.collect_list(F.struct("start", "end")))
    return runs.groupBy("doc").agg(
        F.first(key).alias(key), F.count("*").alias("n_passages"), F.sum("words").alias("repeated_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("first_keys")))).alias(f"first_{key}s"),
        F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans")).drop("doc")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with each repeated passage cut from the texts of all documents
    but its owner.  Other columns, and null texts, come back as they were.

    Where a run joins chunks that the document owns to chunks that an earlier
    one owns, each side is a passage of its own: what a document owns is never
    cut from it, so every text is left in one document at least."""
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    k, t = f"c{names.index(key)}", f"c{names.index(text)}"
    parts = (_repeated_chunks(rows, k, t).where("not own").groupBy("doc", "part")
             .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words")).where(F.col("words") >= least_words))
    gone = (parts.groupBy(F.col("doc").alias("g_doc"))
            .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("gone")))
    joined = rows.withColumn("g_name", _name(k, t)).join(gone, F.col("g_name") == F.col("g_doc"), "left").drop("g_name", "g_doc")
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, texts = schema.names.index(t), []
            for value, spans in zip(batch.column(t).to_pylist(), batch.column("gone").to_pylist()):
                if spans:
                    raw, left, last = value.encode(), [], 0
                    for s in spans:
                        left.append(raw[last : s["start"]])
                        last = s["end"]
                    value = b"".join([*left, raw[last:]]).decode()
                texts.append(value)
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.select(*schema.names, "gone").mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
