"""Chunk ends against a plain gear hash, and repeated passages against brute force."""

import random
from collections import defaultdict

import numpy as np

from ledgerloom.llm import chunks

SF = "/root/testdata/sf0.001"


def plain(raw):
    ends, last, h = [], 0, 0
    want = None
    for i, b in enumerate(raw, 1):
        h = (2 * h + int(chunks._GEAR[b])) % (1 << 32)
        window = raw[max(0, i - 16) : i]
        want = sum(int(chunks._GEAR[c]) << age for age, c in enumerate(reversed(window))) % (1 << 32)
        assert (h ^ want) & int(chunks._MASK) == 0
        if want & int(chunks._MASK) == 0 or i == len(raw):
            ends.append(i)
    out = []
    for end in dict.fromkeys([*ends, len(raw)]):
        while end - last > chunks.LONGEST:
            last += chunks.LONGEST
            while last < len(raw) and raw[last] & 0xC0 == 0x80:
                last += 1
            out.append(last)
        if end - last >= chunks.SHORTEST or end == len(raw):
            while end < len(raw) and raw[end] & 0xC0 == 0x80:
                end += 1
            if end > last:
                out.append(end)
                last = end
    return [raw[a:b] for a, b in zip([0, *out], out)]


def arrays(raws):
    return np.frombuffer(b"".join(raws), np.uint8), np.cumsum([0, *map(len, raws)])


def test_ends_are_those_of_the_rolling_hash():
    rnd = random.Random(1)
    raws = ["".join(rnd.choice("ab cdé\n日𝒳") for _ in range(rnd.randint(0, 900))).encode() for _ in range(60)] + [b"x" * 3000, "é".encode() * 2000, b""]
    data, offsets = arrays(raws)
    owner, end = chunks.cut(data, offsets)
    got = defaultdict(list)
    last = dict(enumerate(offsets[:-1]))
    for o, e in zip(owner, end):
        got[o].append(data[last[o] : e].tobytes())
        last[o] = e
    for n, raw in enumerate(raws):
        assert b"".join(got[n]) == raw and got[n] == plain(raw)
        for c in got[n]:
            c.decode()


def test_insertions_move_the_ends_near_them_alone():
    rnd = random.Random(2)
    raw = bytes(rnd.choice(b"abcdefghij klmnop") for _ in range(20_000))
    other = raw[:9000] + b"inserted here" + raw[9000:]
    a, b = plain(raw), plain(other)
    assert len(set(a) - set(b)) <= 4


def brute(docs, least=chunks.LEAST_WORDS):
    """{doc: spans} of documents (id, text), no text twice."""
    holders = defaultdict(set)
    cut = {i: plain((t or "").encode()) for i, t in docs}
    for i, cs in cut.items():
        for c in cs:
            holders[c].add(i)
    out = {}
    for i, cs in cut.items():
        at, run, spans = 0, None, []
        text = b"".join(cs)
        letter = [c not in b" \t\n\x0b\x0c\r" for c in text]
        begins = [n for n in range(len(text)) if letter[n] and (n == 0 or not letter[n - 1])]
        for c in [*cs, None]:
            if c is not None and len(holders[c]) > 1:
                run = run or [at, at]
                run[1] = at + len(c)
            elif run:
                if sum(run[0] <= b < run[1] for b in begins) >= least:
                    spans.append(tuple(run))
                run = None
            at += len(c or b"")
        if spans:
            out[i] = spans
    return out


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").dropDuplicates(["text"]).collect()
    df = spark.createDataFrame(docs)
    got = {r.doc_id: [tuple(map(int, x.split(":"))) for x in r.spans.split(",")] for r in chunks.repeated_documents(df).collect()}
    want = brute([tuple(r) for r in docs])
    assert got == want and got


def test_passages_and_their_owners(spark):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rnd.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, short = text(80), text(9)
    rows = [(i, f"{text(30)} {passage} {text(i)}" if i < 20 else f"{text(60)} {short}" if i < 40 else text(100), "s") for i in range(60)]
    rows += [(None, rows[3][1], "s"), (None, None, "t"), (80, "", None), (81, rows[59][1] + " again", "s"), (82, text(90), "x"), (82, text(50), "x")]
    rows += [rows[-1]]
    df = spark.createDataFrame(rows, "doc_id long, text string, doc string")
    got = {r.doc_id: r for r in chunks.repeated_documents(df).collect()}
    assert set(got) == {*range(20), None, 59, 81}
    assert all(got[i].n_passages == 1 and 0 in got[i].first_doc_ids for i in range(1, 20) if i != 3) and got[81].first_doc_ids == [59]
    left = chunks.deduplicated(df)
    assert left.columns == df.columns
    after = {r.doc_id: r.text for r in left.collect()}
    assert after[0] == rows[0][1] and len(after[7]) < len(rows[7][1]) - 300 and after[25] == rows[25][1] and after[80] == ""
    assert left.count() == len(rows) and chunks.repeated_documents(df.limit(0)).count() == 0 and chunks.deduplicated(df.limit(0)).count() == 0


def test_copies_that_share_a_passage_with_an_earlier_document(spark):
    rnd = random.Random(7)
    text = lambda n: " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rnd.randint(2, 9))) for _ in range(n))
    licence, body, tail = text(80), text(150), text(60)
    copy = f"{body} {licence} {tail}"
    df = spark.createDataFrame([(1, f"{text(40)} {licence} {text(40)}"), (2, copy), (3, text(90)), (4, copy)], "doc_id long, text string")
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in (df, chunks.deduplicated(df)))
    assert after[1] == before[1] and after[3] == before[3]
    # the first copy keeps all that only the copies hold, the second one is gone whole
    assert after[2].startswith(body[:-200]) and after[2].endswith(tail[200:]) and licence[200:-200] not in after[2] and after[4] == ""
    data, offsets = arrays([before[2].encode()])
    ends = chunks.cut(data, offsets)[1].tolist()
    assert all(any(before[2].encode()[a:b] in t.encode() for t in after.values()) for a, b in zip([0, *ends], ends))


def test_repeated_words_and_rows_are_cut_alike_in_any_surroundings():
    rnd = random.Random(8)
    text = lambda n: " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rnd.randint(2, 9))) for _ in range(n))

    def held(raw):
        data, offsets = arrays([text(50).encode(), raw, b"x"])
        owner, end = chunks.cut(data, offsets)
        ends = (end[owner == 1] - offsets[1]).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    missed = 0
    for n in range(60):
        passage = (text(1) + " ") * 60 if n % 2 else (text(rnd.randint(2, 5)).replace(" ", " | ") + "\n") * 30
        a, b = (held(f"{text(n % 7 + 9)} {passage}{text(12)}".encode()) for _ in range(2))
        assert all(len(c) <= chunks.LONGEST + 3 for c in a)
        missed += sum(len(c.split()) for c in a if c in b) < chunks.LEAST_WORDS
    assert missed <= 2
    # words said a few times are not the passage in which they are said over and over
    assert not set(held(f"{text(9)} {'the ' * 12}{text(9)}".encode())) & set(held(f"{text(9)} {'the ' * 70}{text(9)}".encode()))
