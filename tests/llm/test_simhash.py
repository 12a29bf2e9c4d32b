"""SimHash fingerprints and groups against a plain reading of their definition."""

import re

import xxhash

from ledgerloom.llm import simhash

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def fingerprint(text, width=4):
    w = words(text)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + width]).encode(), 42) for i in range(max(1, len(w) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=4):
    """prints: {id: fingerprint}; the smallest id each reaches."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in simhash.simhash_groups(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: fingerprint(t) for i, t in texts.items()}
    assert {i: r.fp & (1 << 64) - 1 for i, r in got.items()} == prints
    assert {i: r.component for i, r in got.items()} == components(prints)


def test_chunked_keys_lose_no_link(spark):
    import random

    rnd = random.Random(5)
    centre = rnd.getrandbits(63)
    prints = {centre ^ sum(1 << b for b in rnd.sample(range(63), k)) for k in (0, 1, 2, 3, 9, 12) for _ in range(60)}
    prints |= {rnd.getrandbits(63) for _ in range(300)}
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = simhash.fingerprint_links(df, 4, run=16)
    assert all(r.a in prints and r.b in prints for r in links.collect())
    got = {r.node: r.component for r in simhash.connected_components(links, "a", "b").collect()}
    assert {p: got.get(p, p) for p in prints} == components({p: p for p in prints})


def test_edges_of_the_input(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (None, "", "x"), (4, "One two", "a"), (4, "One two", "a"),
            (5, "one  TWO", "a"), (6, "Éa " * 5000, "b"), (None, "only here now", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(((r.doc_id, r.component) for r in simhash.simhash_groups(docs).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (3, 1), (None, 1), (4, 4), (4, 4), (5, 4), (6, 6), (None, None)], key=str)
    prints = {r.doc_id: r.fp & (1 << 64) - 1 for r in simhash.simhash_groups(docs).collect()}
    assert prints[6] == fingerprint("Éa " * 5000) and prints[1] == 0 and prints[5] == fingerprint("one two")
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) == sorted([r for r in docs.distinct().collect() if r.doc_id in (1, 4, 6) or r.fp == "c"], key=str)
    assert simhash.simhash_groups(docs.limit(0)).count() == 0 and simhash.drop_near_copies(docs.limit(0)).count() == 0
