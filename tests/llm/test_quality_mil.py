"""The net's gradient, the passages' codes, and held-out accuracy."""

import re
import zlib

import numpy as np

from ledgerloom.llm import quality_mil, queries
from ledgerloom.llm.quality_mil import WIDTH, WORDS, Net, encode_passages

SF = "/root/testdata/sf0.1"


def test_gradient_by_differences():
    rnd = np.random.default_rng(0)
    net, code, first, y = Net(), rnd.normal(size=(9, WIDTH)), np.array([0, 2, 5]), np.array([1.0, 0, 1])

    def loss():
        q, _ = net.forward(code, first)
        return -(y * np.log(q) + (1 - y) * np.log(1 - q)).mean()

    g = net.gradient(code, first, y)
    for k, v in net.p.items():
        v = np.array(v)
        for i in {tuple(rnd.integers(0, n) for n in v.shape) for _ in range(5)}:
            ends = []
            for e in (1e-5, -1e-5):
                moved = v.copy()
                moved[i] += e
                net.p[k] = moved
                ends.append(loss())
            net.p[k] = v
            assert np.isclose((ends[0] - ends[1]) / 2e-5, np.asarray(g[k])[i], atol=1e-7), k


def test_passages_cover_whole_texts():
    texts = ["", "a  b\tc", " \n", "Oh oh! " * 200, "ß é" * 50, "x"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    owner, code = encode_passages(np.frombuffer(b"".join(raw), np.uint8), offsets)
    n = [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]
    assert np.bincount(owner).tolist() == [max(1, -(-k // WORDS)) for k in n]
    for i, k in enumerate(n):
        mine = code[owner == i]
        assert np.isclose(mine[:, -4].sum() * WORDS, k)
        assert (mine[:, -1] == (k == 0)).all()
        if k:
            assert np.allclose(mine[:, :12].sum(1), 1)
    alone = encode_passages(np.frombuffer(raw[3], np.uint8), np.array([0, len(raw[3])]))[1]
    assert np.array_equal(alone, code[owner == 3])
    assert np.isclose(alone[0, -6], 2 / WORDS) and np.isclose(alone[0, -8], 2.5 / 10)


def test_held_out_documents(spark):
    got = queries.op1_quality_mil(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert ((got.score >= 0.3) == (got.predicted == 1)).all() and got.score.between(0, 1).all()
    out = got[got.held_out]
    assert (out.predicted == out.quality).mean() > 0.98


def test_edges_of_the_input(spark):
    docs = spark.createDataFrame([(i, "fine words stand here. " * 5 if i % 2 else "BAD!! $$$ " * 9, 1.0) for i in range(120)]
                                 + [(None, None, 0.0), (500, "", 0.0), (500, "", 0.0), (501, "fine words stand here. " * 40_000, 0.0)],
                                 "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)] + [(None, 1), (500, None)], "doc_id long, quality int")
    net = quality_mil.fit(docs, labels)
    rows = quality_mil.score(docs, net, ["doc_id"]).collect()
    by = {r.doc_id: r.score for r in rows}
    assert len(rows) == 124 and by[1] > 0.8 > 0.3 > by[0] and by[501] > 0.5 and by[None] == by[500] and 0 <= by[500] <= 1
    assert quality_mil.score(docs.limit(0), net, ["doc_id"]).count() == 0
    assert 0 <= quality_mil.score(docs, quality_mil.fit(docs, labels.limit(0)), ["doc_id"]).first().score <= 1


def plain_codes(text):
    """The codes of a text's passages, counted one by one."""
    raw = (text or "").encode()
    spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    if not spans:
        return [np.append(np.zeros(WIDTH - 1), 1.0)]
    kinds = quality_mil._TABLE
    out = []
    for n in range(0, len(spans), WORDS):
        mine = spans[n : n + WORDS]
        part = raw[mine[0][0] : spans[n + WORDS][0] if n + WORDS < len(spans) else len(raw)]
        code, words = np.zeros(WIDTH), [raw[a:b] for a, b in mine]
        for b in part:
            code[kinds[b]] += 1 / len(part)
        for a, b in zip(part, part[1:]):
            code[12 + 12 * int(kinds[a]) + int(kinds[b])] += 1 / len(part)
        lengths = np.array([len(w) for w in words], float)
        code[-8], code[-7] = lengths.mean() / 10, lengths.std() / 10
        code[-6], code[-5] = len(set(words)) / len(words), sum(a == b for a, b in zip(words, words[1:])) / len(words)
        code[-4], code[-3], code[-2] = len(words) / WORDS, lengths.mean() > 20, np.log1p(len(spans)) / 10
        out.append(code)
    return out


def plain_score(net, text):
    """The net's score of a text, passage by passage."""
    p, hidden, weight = net.p, [], []
    for code in plain_codes(text):
        x = np.clip((code - net.mean) / net.scale, -6, 6)
        h = np.tanh(x @ p["E"] + p["e"])
        gate = 1 / (1 + np.exp(-np.clip(h @ p["U"], -30, 30)))
        hidden.append(h)
        weight.append(np.exp((np.tanh(h @ p["V"]) * gate) @ p["w"]))
    z = sum(w * h for w, h in zip(weight, hidden)) / sum(weight)
    return 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))


def test_every_row_of_the_query_against_a_plain_scorer(spark):
    from ledgerloom.llm.toxicity import remainder

    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    net = quality_mil.fit(docs, labels.where(remainder("doc_id", 5) != 0))
    got = {r.doc_id: (r.score, r.predicted) for r in queries.op1_quality_mil(spark, sf).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys()
    for k, (score, predicted) in got.items():
        want = plain_score(net, texts[k])
        assert abs(score - want) < 1e-4, k  # codes are single precision in the job
        assert predicted == (want >= 0.3) or abs(want - 0.3) < 1e-4
