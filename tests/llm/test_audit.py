"""The transducer and its table against plain counts; the audit against a simulation of every order."""

import random
import re
from collections import defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest

from ledgerloom.llm import audit, common, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def arrays(texts):
    raws = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raws), np.uint8), np.cumsum([0, *map(len, raws)])


def some_texts(n=200):
    rnd = random.Random(4)
    bits = ["ab", "Ab", "é", "日本", "𝒳", " ", "  ", "\n", "\t", "#", "A", "|x", "\x0b", "\x1f", "\x85", " ", "zz", "The the"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(n)] + ["", "", " ", "A", "é" * 700, "x" * 900, "one two " * 300, ""]


@pytest.mark.parametrize("slice_bytes", [1 << 20, 64, 7])
def test_transducer_and_table(slice_bytes, monkeypatch):
    monkeypatch.setattr(audit, "SLICE_BYTES", slice_bytes)
    texts = some_texts()
    data, offsets = arrays(texts)
    starts, ends, counts = audit.transduce(data, offsets, audit.byte_classes())
    owner = np.searchsorted(offsets, starts, side="right") - 1
    got = defaultdict(list)
    for o, a, b in zip(owner, starts, ends):
        got[o].append(data[a:b].tobytes().decode())
    words = [WORD.findall(t) for t in texts]
    assert [got[i] for i in range(len(texts))] == words
    assert counts.tolist() == [[len(t), len(re.findall("[A-Z]", t)), len(re.findall(r"[#$%&*|]", t))] for t in texts]
    for hashes in (None, np.zeros(len(starts), np.uint64), (ends - starts).astype(np.uint64)):  # all hashes equal: only bytes tell
        if hashes is not None and slice_bytes != 64:
            continue
        kept = audit.distinct_spans(data, starts, ends, owner, hashes)
        distinct = defaultdict(set)
        for i in kept:
            word = data[starts[i] : ends[i]].tobytes()
            assert word not in distinct[owner[i]]
            distinct[owner[i]].add(word)
        assert [len(distinct[i]) for i in range(len(texts))] == [len(set(w)) for w in words]


def simulated(rows, labels, letters="ABCDE"):
    """{(part, order, step): counts} of rows (id, text, lang), by running every order."""
    good, toxic = {k for k, q, _ in labels if q == 1 and k is not None}, {k for k, _, t in labels if t == 1 and k is not None}
    least = {}
    for k, t, _ in rows:
        if k is not None:
            least[t or ""] = min(least.get(t or "", k), k)
    docs = []
    for k, t, p in rows:
        t = t or ""
        w = WORD.findall(t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
             "D": bool(re.search(r"[#$%&*|]", t)), "E": k is not None and least[t] < k}
        docs.append((k, p or "", {x for x in f if f[x]}))
    out, total = {}, defaultdict(int)
    for order in permutations(letters):
        for part in {p for _, p, _ in docs}:
            here, gone = [d for d in docs if d[1] == part], []
            for step, x in enumerate(order, 1):
                before = {i for i, *_ in gone}
                now = [(i, d) for i, d in enumerate(here) if x in d[2] and i not in before]
                redundant = sum(x in d[2] and i in before for i, d in enumerate(here))
                gone += now
                total[part, x] += len(now)
                out[part, "".join(order), step] = [len(here) - len(gone), len(now), redundant, sum(d[2] == {x} for d in here),
                                                   sum(d[0] in good for _, d in now), sum(d[0] in toxic for _, d in now)]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_every_order_against_a_simulation(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 5)))
    texts = [" ".join(word() for _ in range(rnd.choice([5, 150, 250, 600]))) + rnd.choice(["", "", "#", " AB " * 20]) for _ in range(40)]
    texts += [texts[0]] * 15 + ["", None, "", " ", "same " * 300, "A" * 5]
    rows = [(None if i % 17 == 3 else rnd.randint(0, 60), t, rnd.choice(["en", "de", "", None]), "x", i) for i, t in enumerate(texts)]
    rows += rows[:4]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(40)] + [(5, 1, 1), (5, 0, 0), (5, 1, 1), (None, 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, mask string, d1 long")
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.audit(audit.failures(df, said), "ABCDE").collect()
    want = simulated([r[:3] for r in rows], labels)
    assert len(got) == len(want) == 120 * 5 * 3
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == want
    assert audit.audit(audit.failures(df.limit(0), said), "ABCDE").count() == 0
    assert audit.audit(audit.failures(df, said.limit(0)), "ABCDE").where("good_lost > 0").count() == 0
    fewer = dict(list(audit.default_filters().items())[:2])
    two = audit.audit(audit.failures(df, said, filters=fewer), "AB").collect()
    assert len(two) == 2 * 2 * 3 and {r.filter_order for r in two} == {"AB", "BA"}


def test_long_text_and_slices(spark, monkeypatch):
    monkeypatch.setattr(common, "SLICE_BYTES", 500)
    monkeypatch.setattr(audit, "SLICE_BYTES", 500)
    texts = [*some_texts(60), "lorem Ipsum dolor é " * 4000, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_distinct, r.n_chars, r.n_capitals, r.n_symbols) for r in audit.measured(df, ["doc_id"], "text").collect()}
    texts[-1] = ""
    assert got == {i: (len(w := WORD.findall(t)), len(set(w)), len(t), len(re.findall("[A-Z]", t)), len(re.findall(r"[#$%&*|]", t))) for i, t in enumerate(texts)}


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.ORACLES["op13_audit"])
    names = [d[0] for d in want.description]
    got = queries.op13_audit(spark, SF)
    assert got.columns == names and sorted(map(tuple, got.collect())) == sorted(want.fetchall())
