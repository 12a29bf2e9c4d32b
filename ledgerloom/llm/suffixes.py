"""Substring dedup by a logarithmic family of suffix arrays (operator 11).

Removes every byte that a string of ``least`` bytes covers which also starts
anywhere else, in the same text or another one.

*Sampled suffixes.*  A window of ``least`` bytes is represented by the suffix
that starts at its least-hashed ``k``-byte string (``k = least - w + 1``, the
first of equals): equal windows choose suffixes at the same offset, and
neighbouring windows mostly share one, so about two in ``w`` positions are
kept.  A suffix's key is its first three bytes (in byte order) and a
fingerprint of its first ``k``.

*Family of arrays.*  Each batch's suffixes become an array: one row a key, in
order, with the place it stands at and whether it stands at another one too,
stored as a table that is bucketed and sorted by the key.  The new array is
scanned against itself, and against every level in one merge join, bucket by
bucket without a shuffle: keys on both sides are the long matches.  Before a
batch comes in, levels of equal size are merged (again bucket by bucket) into
one of twice the size, so ``n`` batches leave about ``log2(n)`` levels and a
row is rewritten ``log2(n)`` times.

*Exact ends.*  Of the suffixes with matching keys, those whose windows agree
altogether are done.  For the others one text of each form is looked at
again: windows in groups of sixteen are fingerprinted, by the bytes they have
in common and by all they cover; groups that stand twice in different forms
are split into groups of four, and these into windows.  All fingerprints are
counted by map-side combinable aggregates, so a passage that stands in a
third of all texts is a count, not a group; no pairs are formed.  What
settles a match has 104 bits or more.

Texts move once, packed, to a table bucketed by their digest, and only those
stay that hold a matching key; later steps meet them there without a shuffle.
A text that several rows hold is repeated as a whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import SLICE_BYTES, column_of, mix, text_slices, written
from ledgerloom.session import ensure_checkpoint_dir

LEAST = 400
BATCHES = 4
#: Windows of a group, in the steps that find a match's exact ends.
STEPS = (16, 4, 1)
#: Units whose bytes a kernel holds as a matrix at a time.
BLOCK = 1024
_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_BYTE = [mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(m)) | np.uint64(1) for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


@dataclass(frozen=True)
class Shape:
    """Lengths that follow from the least length of a repeated string."""

    least: int

    @property
    def w(self) -> int:
        """Positions among which a window chooses: three quarters of its bytes."""
        return max(1, self.least * 3 // 4)

    @property
    def k(self) -> int:
        return self.least - self.w + 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _back(base: int) -> int:
    return pow(base, -1, 1 << 64)


def sampled(data: np.ndarray, offsets: np.ndarray, shape: Shape) -> tuple[np.ndarray, ...]:
    """Suffixes chosen in texts back to back: (text, place in its text, least
    and most distance of its windows' starts before it, key, fingerprint of
    all that the windows cover)."""
    n, least, w, k = len(data), shape.least, shape.w, shape.k
    none = (np.empty(0, np.int64),) * 6
    if n < least:
        return none
    power, back = _powers(_ODD[0], n + 1), _powers(_back(_ODD[0]), n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[0][data] * power[:-1], out=total[1:], dtype=np.uint64)
    grams = mix((total[k:] - total[:-k]) * back[: n - k + 1])
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while reach < w:
        more = min(reach, w - reach)
        low = np.minimum(low[:-more], low[more:])
        reach += more
    chosen = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)  # of the window that starts at 0, 1, ...
    start = np.arange(len(chosen))
    text = np.searchsorted(offsets, start, side="right") - 1
    inside = start + least <= offsets[text + 1]
    start, text, chosen = start[inside], text[inside], chosen[inside]
    if not len(start):
        return none
    first = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (start[1:] != start[:-1] + 1))))
    last = np.append(first[1:], len(start)) - 1
    at, text = chosen[first], text[first]
    key = np.zeros(len(at), np.uint64)
    for j in range(3):
        key = (key << np.uint64(8)) | (data[at + j].astype(np.uint64) if j < k else np.uint64(0))
    key = ((key ^ np.uint64(1 << 23)) << np.uint64(40)) | (grams[at] >> np.uint64(24))  # longs compare as the bytes do
    whole = mix((total[start[last] + least] - total[start[first]]) * back[start[first]] + (at - start[first]).astype(np.uint64) * np.uint64(_ODD[1]))
    return text, at - offsets[text], at - start[last], at - start[first], key.view(np.int64), whole.view(np.int64)


_ENTRY = "key long, form long, hi long, lo long, at long"


def entries(texts: DataFrame, shape: Shape) -> DataFrame:
    """The sampled suffixes of (hi, lo, t) rows: ``key``, ``form`` (of all that
    their windows cover) and place: the text's name (hi, lo), and ``at``, which
    packs the position with its windows' distances.  A text that comes again
    in a task is passed over there.  A text longer than a slice is worked on
    in pieces that overlap by a window: its windows are the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _ENTRY.split(", ")]
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            fresh = []
            for i, name in enumerate(zip(*(batch.column(c).to_pylist() for c in ("hi", "lo")))):
                if name not in seen:
                    seen.add(name)
                    fresh.append(i)
            batch = batch.take(pa.array(fresh, pa.int64()))
            hi, lo = (batch.column(c).to_numpy() for c in ("hi", "lo"))
            for rows, data, offsets in text_slices(batch, "t"):
                parts = [(0, data, offsets)]
                if len(offsets) == 2 and len(data) > 2 * SLICE_BYTES:
                    parts = [(s, d, np.array([0, len(d)])) for s in range(0, len(data), SLICE_BYTES)
                             for d in [data[s : s + SLICE_BYTES + shape.least - 1]]]
                for shift, d, o in parts:
                    text, at, near, far, key, form = sampled(d, o, shape)
                    if len(text):
                        where = rows.start + text
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x) for x in (key, form, hi[where], lo[where], ((at + shift) << 32) | (near << 16) | far)], names)

    return texts.select("hi", "lo", "t").mapInArrow(run, _ENTRY)


def _position(at: Column) -> tuple[Column, Column, Column]:
    """(position, near, far) of a packed place."""
    return F.shiftright(at, 32), F.shiftright(at, 16).bitwiseAND(F.lit(0xFFFF)), at.bitwiseAND(F.lit(0xFFFF))


def _covered(place: Column, least: int) -> list[Column]:
    position, near, far = _position(place)
    return [(position - far).cast("int").alias("start"), (position - near + least).cast("int").alias("end")]


def _place() -> Column:
    return F.xxhash64("hi", "lo", "at")


class Tables:
    """Bucketed and sorted tables in the shared folder, each under a name of its
    own until ``close``.  Rows come from a shuffle by the buckets' key into as
    many partitions, so a bucket is one file and the write moves nothing."""

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark, self.names = spark, []
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def store(self, rows: DataFrame, *key: str) -> DataFrame:
        name = f"suffixes_{uuid.uuid4().hex}"
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/{name}"
        rows.write.option("path", path).bucketBy(self.buckets, *key).sortBy(*key).saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def close(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = []


@dataclass
class Family:
    """Levels of suffix arrays, largest first; their sizes are powers of two in batches."""

    tables: Tables
    levels: list[tuple[int, DataFrame]] = field(default_factory=list)

    def add(self, batch: DataFrame) -> DataFrame:
        """Take a batch of entries in.  Returns the keys of its suffixes that
        stand elsewhere too, in it or in an earlier batch."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, a), (_, b) = self.levels.pop(), self.levels.pop()
            self.levels.append((2 * size, self.merged(b, a)))
        sums = batch.groupBy("key").agg(F.min(_place()).alias("one"), F.max(_place()).alias("other"))
        array = self.tables.store(sums.select("key", "one", (F.col("one") != F.col("other")).alias("twice")), "key")
        found = array.where("twice").select("key")
        for _, level in self.levels:
            found = found.union(array.select("key").join(level.select("key").hint("merge"), "key", "left_semi"))
        found = written(found, "matches")
        self.levels.append((1, array))
        return found

    def merged(self, a: DataFrame, b: DataFrame) -> DataFrame:
        """One array of two that are in order by key."""
        both = a.alias("x").join(b.alias("y").hint("merge"), F.col("x.key") == F.col("y.key"), "full_outer")
        twice = F.coalesce("x.twice", F.lit(False)) | F.coalesce("y.twice", F.lit(False)) | F.coalesce(F.col("x.one") != F.col("y.one"), F.lit(False))
        return self.tables.store(both.select(F.coalesce("x.key", "y.key").alias("key"), F.coalesce("x.one", "y.one").alias("one"), twice.alias("twice")), "key")


def _unpacked(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def _spans_of(raw: np.ndarray, at: np.ndarray, shape: Shape) -> list[tuple[np.ndarray, np.ndarray]]:
    """For the windows of suffixes at ``at``: running sums over the bytes from
    ``w - 1`` before each, under two hashes, and the factors that undo the place."""
    span = np.arange(shape.w - 1 + shape.least)
    here = raw[np.clip(at[:, None] - (shape.w - 1) + span, 0, len(raw) - 1)]
    out = []
    for odd, byte in zip(_ODD, _BYTE):
        total = np.zeros((len(at), len(span) + 1), np.uint64)
        np.cumsum(byte[here] * _powers(odd, len(span)), axis=1, out=total[:, 1:], dtype=np.uint64)
        out.append((total, _powers(_back(odd), len(span) + 1)))
    return out


_PART = "p1 long, p2 long, form long, unit long, part int, open boolean"


def part_prints(texts: DataFrame, shape: Shape, step: int, before: int) -> DataFrame:
    """Of (z, units) rows, ``units`` holding (unit, at, open, part): windows
    that start ``part * before`` to ``part * before + before - 1`` bytes before
    the suffix, in groups of ``step``.  For each group with windows of the
    unit: the 128-bit print of the bytes that the windows of a full group have
    in common, and ``form``, that of all that the unit's windows cover."""
    w, least = shape.w, shape.least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _PART.split(", ")]
        for batch in batches:
            packed = batch.column(batch.schema.get_field_index("z")).to_pylist()
            for z, units in zip(packed, batch.column(batch.schema.get_field_index("units")).to_pylist()):
                raw = np.frombuffer(_unpacked(z), np.uint8)
                for i in range(0, len(units), BLOCK):
                    some = units[i : i + BLOCK]
                    unit, place, first = (np.array([u[c] for u in some], np.int64) for c in ("unit", "at", "part"))
                    open_ = np.array([u["open"] for u in some], bool)
                    at, near, far = place >> 32, (place >> 16) & 0xFFFF, place & 0xFFFF
                    part = first[:, None] * (before // step) + np.arange(before // step)
                    row, j = np.nonzero((part * step <= far[:, None]) & (part * step + step > near[:, None]))
                    part = part[row, j]
                    sums = _spans_of(raw, at, shape)

                    def prints(which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
                        total, back = sums[which]
                        return mix((total[row, end] - total[row, start]) * back[start]).view(np.int64)

                    most, fewest = np.minimum(part * step + step - 1, far[row]), np.maximum(part * step, near[row])
                    shared = w - 1 - part * step, w - 1 - (part * step + step - 1) + least
                    form = prints(0, w - 1 - most, w - 1 - fewest + least) ^ (most * 0x10000 + fewest)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (prints(0, *shared), prints(1, *shared), form, unit[row], part.astype(np.int32), open_[row])], names)

    return texts.select("z", "units").mapInArrow(run, _PART)


def text_name(text: Column) -> tuple[Column, Column]:
    """128 bits that name a text."""
    return F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text)


def _named(docs: DataFrame, text: str, least: int) -> DataFrame:
    """(hi, lo, t) of the rows whose text has ``least`` bytes or more."""
    t = F.col(f"`{text}`")
    hi, lo = text_name(t)
    return docs.select(hi.alias("hi"), lo.alias("lo"), t.alias("t")).where(F.octet_length("t") >= least)


def _packed(rows: DataFrame) -> DataFrame:
    """(hi, lo, z) of (hi, lo, t) rows: texts compressed, as they are about to move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor().compress
        for batch in batches:
            for part, data, offsets in text_slices(batch, "t"):
                raw, at = data.tobytes(), offsets.tolist()
                z = pa.array([pack(raw[a:b]) for a, b in zip(at, at[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([column_of(batch, "hi", part), column_of(batch, "lo", part), z], ["hi", "lo", "z"])

    return rows.mapInArrow(run, "hi long, lo long, z binary")


def repeated_spans(texts: DataFrame, tables: Tables, least: int = LEAST, batches: int = BATCHES) -> tuple[DataFrame, DataFrame]:
    """Byte spans, which may overlap, of all that a repeated string of
    ``least`` bytes covers in the distinct texts of ``texts`` (hi, lo, t): rows
    (hi, lo, start, end).  Also the table (hi, lo, z, copies) of the packed
    texts that may hold some or come several times."""
    shape = Shape(least)
    family = Family(tables)
    matches = None
    for i in range(batches):
        found = family.add(entries(texts.where(F.pmod("lo", F.lit(batches)) == i), shape))
        matches = found if matches is None else matches.union(found)
    matches = written(matches.distinct(), "matches")
    likely = written(entries(texts, shape).join(matches, "key", "left_semi"), "likely")
    forms = written(likely.groupBy("key", "form").agg(
        F.min(_place()).alias("one"), F.max(_place()).alias("other"), F.first("hi").alias("hi"), F.first("lo").alias("lo"), F.first("at").alias("at"))
        .select("key", "form", "hi", "lo", "at", (F.col("one") == F.col("other")).alias("open")), "forms")
    # forms at two places: all their windows are repeated
    same = forms.where("not open").select(F.col("key").alias("s_key"), F.col("form").alias("s_form"))
    whole = likely.join(same, (F.col("key") == F.col("s_key")) & (F.col("form") == F.col("s_form")))
    # a join of its own job, so that Spark can split a form that a third of the texts hold
    spans = written(whole.select("hi", "lo", *_covered(F.col("at"), least)), "spans")
    # keys of several forms: one place of each is looked at again
    mixed = written(forms.groupBy("key").agg(F.count("*").alias("n"), F.max("open").alias("open")).where("n > 1 and open").select(F.col("key").alias("m_key")), "mixed")
    units = written(forms.join(mixed, F.col("key") == F.col("m_key")).select("hi", "lo", "at", "open").withColumn("unit", F.monotonically_increasing_id()), "units")
    # the texts that these steps need, each once
    several = texts.select("hi", "lo").groupBy("hi", "lo").agg(F.count("*").alias("copies"))
    wanted = written(several.join(likely.select("hi", "lo", F.lit(True).alias("held")).distinct(), ["hi", "lo"], "left").where("copies > 1 or held")
                     .select("hi", "lo", "copies"), "wanted")
    packed = _packed(texts).groupBy("hi", "lo").agg(F.first("z").alias("z"))
    held = tables.store(packed.join(wanted, ["hi", "lo"]), "hi", "lo")
    rows, before = units.withColumn("part", F.lit(0)), -(-shape.w // STEPS[0]) * STEPS[0]
    ends = []
    for step in STEPS:
        listed = rows.groupBy("hi", "lo").agg(F.collect_list(F.struct("unit", "at", "open", "part")).alias("units"))
        parts = written(part_prints(held.join(listed, ["hi", "lo"]), shape, step, before), "parts")
        place = F.xxhash64("unit", "part")
        prints = written(parts.groupBy("p1", "p2").agg(
            F.min(place).alias("a"), F.max(place).alias("b"), F.min("form").alias("f"), F.max("form").alias("g"), F.max("open").alias("open"))
            .where("a != b and open").select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), (F.col("f") == F.col("g")).alias("same")), "prints")
        again = parts.join(prints, (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2")))
        if step > 1:
            again = written(again.select("unit", "part", "open", "same"), "again")
        # groups of one form: all their windows are repeated
        ends.append(again.where("open and same").select("unit", (F.col("part") * step).alias("near"), (F.col("part") * step + (step - 1)).alias("far")))
        if step > 1:
            left = again.where("not same").select(F.col("unit").alias("a_unit"), "part")
            rows = written(units.join(left, F.col("unit") == F.col("a_unit")).select("hi", "lo", "at", "open", "unit", "part"), "left")
            before = step
    reach = ends[0].union(ends[1]).union(ends[2]).groupBy("unit").agg(F.min("near").alias("least"), F.max("far").alias("most")).withColumnRenamed("unit", "e_unit")
    position, near, far = _position(F.col("at"))
    ends = units.join(reach, F.col("unit") == F.col("e_unit")).select(
        "hi", "lo", (position - F.least(far, "most")).cast("int").alias("start"), (position - F.greatest(near, "least") + least).cast("int").alias("end"))
    return spans.union(ends), held


_CUT = "hi long, lo long, spans array<struct<start:int,end:int>>, kept binary"


def _cut(texts: DataFrame) -> DataFrame:
    """(hi, lo, spans, kept) of (hi, lo, z, copies, found) rows: maximal spans
    in order, and the bytes outside of them.  A text of several rows goes whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(batch.schema.get_field_index("z")).to_pylist()
            spans, kept = [], []
            for i, (copies, found) in enumerate(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("copies", "found")))):
                raw, mine, left, last = _unpacked(data[i]), [], [], 0
                if copies > 1:
                    found = [{"start": 0, "end": len(raw)}]
                for s in sorted((s["start"], s["end"]) for s in found or []):
                    if mine and s[0] <= mine[-1][1]:
                        mine[-1][1] = max(mine[-1][1], s[1])
                    else:
                        mine.append([*s])
                for a, b in mine:
                    left.append(raw[last:a])
                    last = b
                spans.append([{"start": a, "end": b} for a, b in mine])
                kept.append(b"".join([*left, raw[last:]]))
            kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("hi")), batch.column(batch.schema.get_field_index("lo")), pa.array(spans, kinds), pa.array(kept, pa.binary())],
                ["hi", "lo", "spans", "kept"])

    return texts.select("hi", "lo", "z", "copies", "found").mapInArrow(run, _CUT)


def cut_texts(docs: DataFrame, text: str = "text", least: int = LEAST, batches: int = BATCHES, tables: Tables | None = None) -> DataFrame:
    """(hi, lo, spans, kept) of the distinct texts that hold a repeated
    string: ``text_name`` of the text, its maximal repeated spans (bytes, end
    exclusive) and the bytes outside of them, which need not be valid UTF-8.

    Rows that repeat a text repeat all its strings.  Null, empty and short
    texts hold none; an empty table gives an empty result."""
    own = tables or Tables(docs.sparkSession)
    try:
        spans, texts = repeated_spans(_named(docs, text, least), own, least, batches)
        found = written(spans.groupBy("hi", "lo").agg(F.collect_list(F.struct("start", "end")).alias("found")), "found")
        return written(_cut(texts.join(found, ["hi", "lo"], "left").where("copies > 1 or found is not null")), "cut")
    finally:
        if tables is None:
            own.close()


def without_repeats(docs: DataFrame, text: str = "text", least: int = LEAST, batches: int = BATCHES) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (byte spans)
    and ``kept`` (binary; the bytes of its text that are left) instead of
    columns of these names.  A null text counts as an empty one.  Rows come
    back as often as they came."""
    out = ("n_bytes", "n_removed", "n_spans", "spans", "kept")
    rest = [c for c in docs.columns if c not in out]
    cut = cut_texts(docs, text, least, batches).withColumnsRenamed({"spans": "s", "kept": "k"})
    hi, lo = text_name(F.col(f"`{text}`"))
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], t.alias("t"), hi.alias("r_hi"), lo.alias("r_lo"))
    joined = rows.join(cut, (F.col("r_hi") == F.col("hi")) & (F.col("r_lo") == F.col("lo")), "left")
    n = F.octet_length("t").cast("long")
    return joined.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], n.alias("n_bytes"), F.coalesce(n - F.octet_length("k"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("s"), F.lit(0)).cast("long").alias("n_spans"), F.coalesce("s", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("k", F.col("t").cast("binary")).alias("kept"))


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, batches: int = BATCHES) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of every row: as
    ``without_repeats``, but texts don't move, only their names and digests."""
    cut = cut_texts(docs, text, least, batches).select(
        "hi", "lo", F.octet_length("kept").alias("left"), F.size("spans").alias("n"), F.sha2("kept", 256).alias("digest"))
    cut = written(cut, "digests")
    hi, lo = text_name(F.col(f"`{text}`"))
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = written(docs.select(F.col(f"`{key}`").alias("id"), hi.alias("r_hi"), lo.alias("r_lo"), F.octet_length(t).cast("long").alias("n_bytes"),
                               F.sha2(t.cast("binary"), 256).alias("all")), "rows")
    return rows.join(cut, (F.col("r_hi") == F.col("hi")) & (F.col("r_lo") == F.col("lo")), "left").select(
        F.col("id").alias(key), "n_bytes", F.coalesce(F.col("n_bytes") - F.col("left"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("digest", "all").alias("kept_sha256"))
