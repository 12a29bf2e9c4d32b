"""Toxicity by FTRL-proximal logistic regression (operator 4).

A text's features are hashed word unigrams, bigrams and skip-grams (one or
two words between), each counted once a text.  FTRL-proximal gives each
coordinate its own learning rate and drives most weights to exactly zero
(L1), so the model is a few thousand (key, weight) pairs that travel with
the job.  It is fitted in one task, on a bounded sample of labelled rows;
every whole text is scored where it lies, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import column_of, mix, run_hashes, runs_of, smallest_hashes, text_slices, written

#: Distinct labelled rows that a model is fitted on, at most (those of smallest hash).
MAX_ROWS = 12_000
#: Texts of the sample that a feature must occur in.
LEAST_TEXTS = 4
_SALTS = [np.uint64(x) for x in (1, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of texts back to back.  Words are runs of letters
    (ASCII, or any byte of a longer character), lower-cased as far as Latin-1."""
    upper = (data >= 65) & (data <= 90)
    latin = np.zeros(len(data), bool)
    if len(data) > 1:
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    low = data + (upper | latin).astype(np.uint8) * np.uint8(32)
    starts, ends, first = runs_of((data >= 128) | upper | ((data >= 97) & (data <= 122)), offsets)
    words = run_hashes(low, starts, ends)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    texts, features = [text], [mix(words * _SALTS[0])]
    for gap in (1, 2, 3):
        if len(words) > gap:
            same = np.flatnonzero(text[gap:] == text[:-gap])
            texts.append(text[same])
            features.append(mix(words[same] * _SALTS[gap] + words[same + gap]))
    return np.concatenate(texts), np.concatenate(features)


@dataclass
class Ftrl:
    """FTRL-proximal for binary features (McMahan et al. 2013)."""

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.1
    epochs: int = 4

    def fit(self, rows: list[np.ndarray], labels: np.ndarray, n: int) -> tuple[np.ndarray, float]:
        """rows: each text's coordinates (below ``n``); weights and the bias."""
        z, sq = np.zeros(n + 1), np.zeros(n + 1)  # the last is the bias, without L1
        l1 = np.full(n + 1, self.l1)
        l1[n] = 0
        rows = [np.append(r, np.int32(n)) for r in rows]
        for _ in range(self.epochs):
            for r, y in zip(rows, labels):
                w, root = self._weights(z[r], sq[r], l1[r])
                g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y
                new = sq[r] + g * g
                z[r] += g - (np.sqrt(new) - root) / self.alpha * w
                sq[r] = new
        w, _ = self._weights(z, sq, l1)
        return w[:n], float(w[n])

    def _weights(self, z: np.ndarray, sq: np.ndarray, l1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        root = np.sqrt(sq)
        return np.where(np.abs(z) <= l1, 0, (np.sign(z) * l1 - z) / ((self.beta + root) / self.alpha + self.l2)), root


@dataclass
class Model:
    """Feature keys (sorted), their weights and the bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.keys & np.uint64((1 << 20) - 1)] = True

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        text, feature = ngrams(data, offsets)
        some = np.flatnonzero(self.maybe[feature & np.uint64((1 << 20) - 1)])
        text, feature = text[some], feature[some]
        at = np.searchsorted(self.keys, feature)
        hit = at < len(self.keys)
        hit[hit] = self.keys[at[hit]] == feature[hit]
        once = np.unique(text[hit] * np.int64(len(self.keys) + 1) + at[hit]) if hit.any() else np.empty(0, np.int64)
        total = np.bincount(once // (len(self.keys) + 1), self.weights[once % (len(self.keys) + 1)], minlength=len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(self.bias + total[: len(offsets) - 1], -30, 30)))


def fit_texts(batches: list[pa.RecordBatch], text: str, labels: np.ndarray, ftrl: Ftrl) -> Model:
    """In one process: features in enough texts become coordinates, then FTRL."""
    def each() -> Iterator[tuple[int, np.ndarray]]:
        n = 0
        for batch in batches:
            for rows, data, offsets in text_slices(batch, text):
                owner, feature = ngrams(data, offsets)
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(rows.stop - rows.start + 1))
                feature = feature[order]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    yield n + i, np.unique(feature[a:b])
                n += rows.stop - rows.start

    seen = np.zeros(1 << 24, np.uint8)
    for _, f in each():
        slot = np.unique(f >> np.uint64(40))
        seen[slot] += seen[slot] < 255
    kept = [f[seen[f >> np.uint64(40)] >= LEAST_TEXTS] for _, f in each()]
    del seen
    # one array text after text, the parts of which go as it is made
    ends = np.cumsum([0, *map(len, kept)])
    flat = np.empty(ends[-1], np.uint64)
    for i in range(len(kept)):
        flat[ends[i] : ends[i + 1]] = kept[i]
        kept[i] = None
    order = np.sort(flat)
    first = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1]))[: len(order)])
    keys = order[first[np.diff(np.append(first, len(order))) >= LEAST_TEXTS]]
    del order, first
    rows = []
    for lo, hi in zip(ends, ends[1:]):
        f = flat[lo:hi]
        at = np.searchsorted(keys, f)
        ok = at < len(keys)
        ok[ok] = keys[at[ok]] == f[ok]
        rows.append(at[ok].astype(np.int32))
    del flat
    weights, bias = ftrl.fit(rows, labels, len(keys))
    use = weights != 0
    return Model(keys[use], weights[use], bias)


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text",
                    max_rows: int = MAX_ROWS) -> DataFrame:
    """At most ``max_rows`` distinct rows of key, label and text (``__text``,
    ``__label``): those of smallest hash of key and text, among the rows of the
    ``max_rows`` labelled keys of smallest hash.  Rows without key, label or
    text fall away.  Repeats are combined before they are shuffled, a hash in
    place of each text, and the texts of the rows that remain are read again;
    keys and rows are few by their bound, so they are broadcast."""
    some = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
            .select(F.col(key).alias("__key"), F.col(label).cast("double").alias("__label"), F.xxhash64(key).alias("__h")).distinct())
    some = smallest_hashes(some, "__h", max_rows, some.count(), "__key", "__label")
    texts = docs.select(F.col(key).alias("__doc"), F.col(text).alias("__text")).where(F.col(text).isNotNull())
    name = F.xxhash64(F.col("__doc"), F.col("__text"))
    rows = written(texts.join(F.broadcast(some), F.col("__doc") == F.col("__key"))
                   .select("__h", "__key", "__label", name.alias("__r")).distinct(), "sample")
    few = smallest_hashes(rows, "__r", max_rows, rows.count(), "__key", "__label")
    return (texts.join(F.broadcast(few), (F.col("__doc") == F.col("__key")) & (name == F.col("__r")))
            .select("__h", "__key", "__text", "__label").distinct())


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
        max_rows: int = MAX_ROWS, ftrl: Ftrl | None = None) -> Model:
    """The model of ``labels.<label>`` (0 or 1) on a sample of at most
    ``max_rows`` labelled rows, fitted in one task in an order that does not
    depend on the partitions.  Without any label every score is one half."""
    ftrl = ftrl or Ftrl()
    sample = sample_labelled(docs, labels, label, key, text, max_rows).repartition(1).sortWithinPartitions("__h", "__key", "__label", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        y = np.concatenate([b.column(b.schema.get_field_index("__label")).to_numpy() for b in held]) if held else np.empty(0)
        m = fit_texts(held, "__text", y, ftrl) if len(y) else Model(np.empty(0, np.uint64), np.empty(0), 0.0)
        # the bias has the key null
        yield pa.RecordBatch.from_arrays([pa.array([*m.keys.view(np.int64).tolist(), None], pa.int64()), pa.array([*m.weights, m.bias], pa.float64())], ["key", "weight"])

    weights = sample.select("__text", "__label").mapInArrow(run, "key long, weight double").toArrow()
    key_, weight = weights.column("key").to_pylist(), weights.column("weight").to_pylist()
    bias = sum(w for k, w in zip(key_, weight) if k is None)
    pairs = sorted((k % (1 << 64), w) for k, w in zip(key_, weight) if k is not None)
    return Model(np.array([k for k, _ in pairs], np.uint64), np.array([w for _, w in pairs]), float(bias))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all of them by default) and ``out``:
    the probability (0 to 1) of label 1.

    A null or empty text has no features and gets the bias alone.  Repeated
    rows stay; a column that is named ``out`` is replaced."""
    names = [c for c in (docs.columns if keep is None else keep) if c != out]
    frame = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(f"`{text}`").alias("t"))
    schema = frame.drop("t").schema.add("p", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "t"):
                p = pa.array(model.scores(data, offsets), pa.float64())
                yield pa.RecordBatch.from_arrays([*(column_of(batch, n, rows) for n in schema.names[:-1]), p], schema.names)

    return frame.mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.col("p").alias(out))


def remainder(key: str, by: int) -> F.Column:
    """crc32 of the key as text, modulo ``by``; a null key has remainder 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % by, F.lit(0))
