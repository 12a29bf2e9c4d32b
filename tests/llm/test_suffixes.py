"""Repeated strings against brute force; the family's levels; odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import common, queries, suffixes

SF = "/root/testdata/sf0.001"


def brute(raws, least):
    """[(bytes, removed, spans, digest)] of byte strings, by all strings of ``least`` bytes."""
    seen = Counter(r[i : i + least] for r in raws for i in range(len(r) - least + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - least + 1):
            if seen[r[i : i + least]] > 1:
                gone[i : i + least] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def rows_of(df):
    return sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op11_suffixes(spark, SF).collect()}
    want = dict(zip((d.doc_id for d in docs), brute([(d.text or "").encode() for d in docs], 400)))
    assert got == want and sum(w[1] for w in want.values()) > 0


@pytest.mark.parametrize("least,batches", [(24, 4), (40, 1)])
def test_made_up_texts_against_brute_force(spark, least, batches, monkeypatch):
    """Passages in many surroundings, at edges, overlapping, periodic, within
    one text; near copies; characters of several bytes; texts longer than a slice."""
    monkeypatch.setattr(suffixes, "SLICE_BYTES", 300)
    monkeypatch.setattr(common, "SLICE_BYTES", 300)
    rnd = random.Random(least + batches)
    alphabet = "abcdefgh é日"
    text = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    passages = [text(least * m // 10) for m in (9, 10, 11, 12, 15, 20, 30, 60)]
    texts = [text(rnd.randint(0, 30)) + rnd.choice(passages) + text(rnd.randint(0, 30)) for _ in range(150)]
    for _ in range(60):  # near copies
        t = list(rnd.choice(texts))
        for _ in range(rnd.randint(1, 4)):
            t[rnd.randrange(len(t))] = rnd.choice(alphabet)
        texts.append("".join(t))
    texts += [passages[5] + passages[6], passages[4][3:] + passages[4], "a" * 200, "b" * (least + 1), "b" * least, "ab" * 90, text(1500), None, None, "", text(least - 1)]
    texts += texts[:5] + [texts[0]] * 20
    df = spark.createDataFrame([(i % 7 if i % 11 else None, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, kept string, hi int")
    want = brute([(t or "").encode() for t in texts], least)
    assert rows_of(suffixes.removed(df, least=least, batches=batches)) == sorted(want)
    out = suffixes.without_repeats(df, least=least, batches=batches).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out) == sorted(want)
    assert {r.hi: r.doc_id for r in out} == {i: i % 7 if i % 11 else None for i in range(len(texts))}
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in out)
    assert suffixes.removed(df.limit(0), least=least).count() == 0


def test_levels_merge_geometrically(spark):
    tables = suffixes.Tables(spark, 4)
    family = suffixes.Family(tables)
    found, sizes = [], []
    for i in range(8):
        batch = [(0, 0, i, i, 0), (i + 1, 9, i, i, 1)] + ([(50, 1, i, i, 2)] if i in (2, 6) else []) + ([(60, 1, i, i, n) for n in (3, 4)] if i == 4 else [])
        found.append({r[0] for r in family.add(spark.createDataFrame(batch, suffixes._ENTRY)).distinct().collect()})
        sizes.append([n for n, _ in family.levels])
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1], [4, 1], [4, 1, 1], [4, 2, 1], [4, 2, 1, 1]]
    assert found[0] == set() and all(0 in f for f in found[1:]) and 50 in found[6] and 50 not in found[2] and 60 in found[4]
    top = {r.key: r.twice for r in family.levels[0][1].collect()}
    assert top == {0: True, 1: False, 2: False, 3: False, 4: False, 50: False}
    level = family.levels[0][1].select("key")
    for how in ("left_semi", "full_outer"):
        plan = level.join(level.hint("merge"), "key", how)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    names = list(tables.names)
    tables.close()
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_equal_windows_choose_suffixes_at_the_same_offset():
    rnd = random.Random(3)
    shape = suffixes.Shape(400)
    assert (shape.w, shape.k) == (300, 101)
    shared = bytes(rnd.choice(b"abcdefgh ") for _ in range(700))
    got = []
    for n in (0, 13, 901):
        raw = np.frombuffer(bytes(rnd.choice(b"xyz") for _ in range(n)) + shared + b"!" * 40, np.uint8)
        _, at, near, far, *_ = suffixes.sampled(raw, np.array([0, len(raw)]), shape)
        chosen = {int(p - b): int(p) for p, a, z in zip(at, near, far) for b in range(a, z + 1)}
        assert sorted(chosen) == list(range(len(raw) - 399))
        got.append([chosen[s + n] - n for s in range(301)])
    assert got[0] == got[1] == got[2]
