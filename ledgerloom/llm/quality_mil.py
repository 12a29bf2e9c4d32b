"""Quality by attention-based multiple-instance learning (operator 1).

A document is a bag of passages (``WORDS`` words each).  Every passage of
every whole text is encoded from its own bytes: shares of byte classes and
of pairs of neighbouring classes, word lengths, and how far its words
repeat.  A dense layer maps the code to a hidden vector; gated attention
(tanh times sigmoid) weighs the passages; the weighted mean is scored by a
logistic unit (Ilse et al. 2018).  Only document labels are known, so the
attention learns by itself which passages tell.

The net is fitted in one task on a bounded sample of labelled rows, a few
thousand numbers travel with the job, and documents are scored where they
lie, without a shuffle.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import column_of, run_hashes, text_slices, words_of
from ledgerloom.llm.toxicity import sample_labelled

#: Words of a passage.
WORDS = 48
#: Distinct labelled rows that a net is fitted on, at most (those of smallest hash).
MAX_ROWS = 8_000
_CLASSES = 12


def _class_table() -> np.ndarray:
    """Class of each byte: other, lower, upper, digit, space, line end, stop, comma, quote or bracket, bar, mark, longer character."""
    table = np.zeros(256, np.uint8)
    table[128:] = 11
    for n, some in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r\v\f", ".:;", ",",
                              "'\"()[]{}", "|_~^\\", "!?#*$%&<>=+@/"), 1):
        table[[ord(c) for c in some]] = n
    return table


_TABLE = _class_table()
WIDTH = _CLASSES + _CLASSES * _CLASSES + 8


def encode_passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of every passage of texts back to back.  A text without
    words has one passage, of zeros and its own flag."""
    starts, ends, first = words_of(data, offsets)
    n_words = np.diff(first)
    n = np.maximum(-(-n_words // WORDS), 1)
    bound = np.concatenate(([0], np.cumsum(n)))
    text = np.repeat(np.arange(len(n)), n)
    code = np.zeros((bound[-1], WIDTH), np.float32)
    code[:, -1] = np.repeat(n_words == 0, n)
    if not len(starts):
        return text, code
    word_text = np.repeat(np.arange(len(n)), n_words)
    passage = bound[word_text] + (np.arange(len(starts)) - first[word_text]) // WORDS
    new = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
    at = passage[new]  # the passages that have words
    last = np.concatenate((new[1:], [len(starts)])) - 1
    words = (last - new + 1).astype(np.float32)
    # bytes from a passage's first word up to the next one's
    left = starts[new]
    right = np.where(np.concatenate((word_text[new[1:]] == word_text[new[:-1]], [False])), np.concatenate((left[1:], [0])), offsets[word_text[new] + 1])
    owner = np.repeat(np.arange(len(at)), right - left)
    kind = _TABLE[np.concatenate([data[a:b] for a, b in zip(left, right)])].astype(np.int64)
    size = np.maximum(right - left, 1).astype(np.float32)[:, None]
    single = np.bincount(owner * _CLASSES + kind, minlength=len(at) * _CLASSES).reshape(len(at), -1)
    inner = owner[1:] == owner[:-1]
    pairs = np.bincount(((owner[1:] * _CLASSES + kind[:-1]) * _CLASSES + kind[1:])[inner], minlength=len(at) * _CLASSES**2).reshape(len(at), -1)
    code[at, :_CLASSES] = single / size
    code[at, _CLASSES : _CLASSES + _CLASSES**2] = pairs / size
    h = run_hashes(data, starts, ends)
    lengths = (ends - starts).astype(np.float64)
    mean = np.add.reduceat(lengths, new) / words
    deviation = np.sqrt(np.maximum(np.add.reduceat(lengths**2, new) / words - mean**2, 0))
    order = np.lexsort((h, passage))
    fresh = np.concatenate(([True], (h[order][1:] != h[order][:-1]) | (passage[order][1:] != passage[order][:-1])))
    distinct = np.add.reduceat(fresh[np.argsort(order, kind="stable")].astype(np.float32), new)
    repeat = np.concatenate(([False], (h[1:] == h[:-1]) & (passage[1:] == passage[:-1]))).astype(np.float32)
    code[at, -8] = mean / 10
    code[at, -7] = deviation / 10
    code[at, -6] = distinct / words
    code[at, -5] = np.add.reduceat(repeat, new) / words
    code[at, -4] = words / WORDS
    code[at, -3] = np.minimum(mean > 20, 1)
    code[at, -2] = np.log1p(n_words[word_text[new]]) / 10
    return text, code


class Net:
    """Dense layer, gated attention, logistic unit; fitted by Adam."""

    def __init__(self, hidden: int = 24, gate: int = 12, seed: int = 7):
        rnd = np.random.default_rng(seed)
        shape = {"E": (WIDTH, hidden), "e": (hidden,), "V": (hidden, gate), "U": (hidden, gate), "w": (gate,), "c": (hidden,), "b": ()}
        self.p = {k: rnd.normal(0, 1 / np.sqrt(s[0]), s) if s and k != "e" else np.zeros(s) for k, s in shape.items()}
        self.mean, self.scale = np.zeros(WIDTH), np.ones(WIDTH)

    def dumps(self) -> bytes:
        np.savez(out := io.BytesIO(), mean=self.mean, scale=self.scale, **self.p)
        return out.getvalue()

    @classmethod
    def loads(cls, data: bytes) -> Net:
        net, got = cls(), dict(np.load(io.BytesIO(data)))
        net.mean, net.scale = got.pop("mean"), got.pop("scale")
        net.p = got
        return net

    def forward(self, code: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, dict]:
        """Scores of the bags that begin at ``first`` (rows of ``code`` in order)."""
        p = self.p
        x = np.clip((code - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ p["E"] + p["e"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-np.clip(h @ p["U"], -30, 30)))
        bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(code))))
        raw = (t * s) @ p["w"]
        grown = np.exp(raw - np.maximum.reduceat(raw, first)[bag])
        a = grown / np.add.reduceat(grown, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))
        return y, {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "bag": bag}

    def gradient(self, code: np.ndarray, first: np.ndarray, labels: np.ndarray) -> dict:
        """Of the mean cross-entropy, by back-propagation."""
        p, (y, m) = self.p, self.forward(code, first)
        dy = (y - labels) / len(first)
        dz = dy[:, None] * p["c"]
        h, a, bag = m["h"], m["a"], m["bag"]
        da = (dz[bag] * h).sum(1)
        draw = a * (da - np.add.reduceat(a * da, first)[bag])
        dt, ds = draw[:, None] * p["w"] * m["s"] * (1 - m["t"] ** 2), draw[:, None] * p["w"] * m["t"] * m["s"] * (1 - m["s"])
        dh = (a[:, None] * dz[bag] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h**2)
        return {"E": m["x"].T @ dh, "e": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (m["t"] * m["s"]).T @ draw,
                "c": m["z"].T @ dy, "b": dy.sum()}

    def fit(self, code: np.ndarray, first: np.ndarray, labels: np.ndarray, epochs: int = 15, batch: int = 64, rate: float = 3e-3,
            decay: float = 1e-4, seed: int = 7) -> Net:
        self.mean, self.scale = code.mean(0), np.maximum(code.std(0), 1e-3)
        rnd, step = np.random.default_rng(seed), 0
        m1, m2 = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        ends = np.append(first[1:], len(code))
        for _ in range(epochs):
            order = rnd.permutation(len(first))
            for n in range(0, len(order), batch):
                bags = order[n : n + batch]
                rows = np.concatenate([np.arange(first[b], ends[b]) for b in bags])
                sizes = ends[bags] - first[bags]
                g = self.gradient(code[rows], np.cumsum(sizes) - sizes, labels[bags])
                step += 1
                for k in self.p:
                    grad = g[k] + decay * self.p[k]
                    m1[k] = 0.9 * m1[k] + 0.1 * grad
                    m2[k] = 0.999 * m2[k] + 0.001 * grad**2
                    self.p[k] = self.p[k] - rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        text, code = encode_passages(data, offsets)
        first = np.searchsorted(text, np.arange(len(offsets) - 1))
        return self.forward(code, first)[0]


def fit_texts(batches: list[pa.RecordBatch], text: str, labels: np.ndarray) -> Net:
    texts, codes, n = [], [], 0
    for batch in batches:
        for rows, data, offsets in text_slices(batch, text):
            owner, code = encode_passages(data, offsets)
            texts.append(owner + n)
            codes.append(code)
            n += rows.stop - rows.start
    owner = np.concatenate(texts)
    return Net().fit(np.concatenate(codes), np.searchsorted(owner, np.arange(n)), labels)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text",
        max_rows: int = MAX_ROWS) -> Net:
    """The net of ``labels.<label>`` (0 or 1) on a sample of at most
    ``max_rows`` labelled rows, fitted in one task in an order that does not
    depend on the partitions.  Without any label it is the untrained net."""
    sample = sample_labelled(docs, labels, label, key, text, max_rows).repartition(1).sortWithinPartitions("__h", "__key", "__label", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        y = np.concatenate([b.column(b.schema.get_field_index("__label")).to_numpy() for b in held]) if held else np.empty(0)
        yield pa.RecordBatch.from_arrays([pa.array([(fit_texts(held, "__text", y) if len(y) else Net()).dumps()], pa.binary())], ["net"])

    fitted = sample.select("__text", "__label").mapInArrow(run, "net binary").first()  # None if Spark finds the sample empty
    return Net.loads(bytes(fitted.net)) if fitted else Net()


def score(docs: DataFrame, net: Net, key: list[str], text: str = "text") -> DataFrame:
    """``key`` columns and ``score`` (0 to 1, higher: label 1 is likelier) for
    each row; repeated rows stay, other columns are not read.  A null text is
    an empty one; a text without words is one passage with its own flag."""
    frame = docs.select(*key, F.col(text).alias("__text"))
    schema = frame.drop("__text").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "__text"):
                p = pa.array(np.round(net.scores(data, offsets).astype(np.float64), 12))  # as the batch may change the last digits
                yield pa.RecordBatch.from_arrays([*(column_of(batch, k, rows) for k in key), p], [*key, "score"])

    return frame.mapInArrow(run, schema)
