"""Base spans against the plain patterns, the estimates, the classifier and redaction."""

import hashlib
import random
import re

from ledgerloom.llm import pii, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base(text):
    out = []
    for n, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")[:4]) if kind == "ip" else True,
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), n, m.end(), kind))
    return sorted(out)


def spans(frame):
    return {r.doc_id: [(x.start, x.no, x.end, x.kind) for x in r.spans if x.base] for r in frame.collect()}


def test_odd_texts(spark):
    rnd = random.Random(4)
    bits = ["1", "23", "4", " ", "  ", "-", ".", "@", "+", "(", ")", "a", "b.c", "é", "𝒳", "_x", "4111 1111 1111 1111", "10.0.0.256",
            "9.8.7.6", "a@b.com", "+1 (582) 555-8400", "0000001.2.3.004", "%", "\n", "378282246310005", "4012-8888-8888-1881"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 40))) for _ in range(4000)]
    texts += ["a@b.com_x@y.org", "a@b c@d.e", "1.2.3.4.5.6.7.8", "5 -4111111111111111", "12345678901234567890123", "x@" + "b." * 3000 + "c",
              "1 " * 9000, "9" * 20_000, "a" * 50_000 + "@x.yz", "+1" + "." * 20_000, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = spans(pii.find(df, ["doc_id"])[0])
    for i, t in enumerate(texts):
        assert got[i] == base(t), t[:200]


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op8_pii(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    added = set()
    for r in rows:
        want = base(docs[r.doc_id])
        form = [f"{k}:{a}:{b}" for a, _, b, k in want]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[3] == k for x in want) for k in PLAIN)
        assert r.base_sha256 == hashlib.sha256(",".join(form).encode()).hexdigest()
        mine = r.spans.split(",") if r.spans else []
        assert [x for x in mine if x in set(form)] == form
        added |= {(x.split(":")[0], docs[r.doc_id][slice(*map(int, x.split(":")[1:]))]) for x in mine if x not in form}
    assert added and all(re.fullmatch(r"\"[0-9a-f]+\"|\"[0-9A-F]+\"", m) for k, m in added if k == "token")


def test_estimates_tell_good_labelers_from_bad():
    rnd = random.Random(2)
    right = (0.95, 0.9, 0.85, 0.6, 0.5)
    count = {}
    for _ in range(4000):
        y = rnd.random() < 0.4
        v = tuple((1 if (rnd.random() < p) == y else -1) if rnd.random() < 0.9 else 0 for p in right)
        count["token", v] = count.get(("token", v), 0) + 1
    got, q = pii.expectation_maximisation([(k, v, n) for (k, v), n in count.items()])
    assert got["shape"] > got["words"] > got["neighbours"] > 0.5 and abs(got["shape"] - 0.95) < 0.03 and abs(got["variety"] - 0.5) < 0.05
    share = sum(p * n for p, n in zip(q, count.values())) / 4000
    assert abs(share - 0.4) < 0.05


def test_redaction_and_edges(spark):
    rows = [(1, "mail é.a@mail1.example.com or +1 (582) 555-8400!", "s", 1), (2, None, "s", 2), (3, "", None, 3), (None, "card 4111 1111 1111 1111", "s", 4),
            (None, "card 4111 1111 1111 1111", "s", 4), (5, "clean words", "s", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, c0 long")
    out = pii.redact(df)
    assert out.columns == df.columns
    assert sorted((r.c0, r.text) for r in out.collect()) == [(1, "mail é[EMAIL] or [PHONE]!"), (2, None), (3, ""), (4, "card [CARD]"), (4, "card [CARD]"), (5, "clean words")]
    found, _ = pii.find(df, ["doc_id"])
    assert found.count() == 6 and pii.find(df.limit(0), ["doc_id"])[0].count() == 0
    assert pii.redact(df.limit(0)).count() == 0


def test_tokens_of_any_length(spark):
    """Secrets above and below the old bound of 256 characters, in quotes."""
    rnd = random.Random(9)
    token = lambda n: "".join(rnd.choice("abcdef0123456789XYZ") for _ in range(n))
    rows = [(i, f'api key = "{token(n)}" and more') for i, n in enumerate([16, 40, 255, 256, 257, 300, 5000] * 6)] + [(100, 'said "hello there" to all')]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found, _ = pii.find(df, ["doc_id"])
    lengths = {r.doc_id: [s.end - s.start - 2 for s in r.spans if s.kind == "token"] for r in found.collect()}
    assert all(lengths[i] == [len(t) - len('api key = "" and more')] for i, t in rows[:-1]) and lengths[100] == []
    assert all("[TOKEN]" in r.text for r in pii.redact(df).collect() if r.doc_id < 100)
