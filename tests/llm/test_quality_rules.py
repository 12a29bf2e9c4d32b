"""The rules against their SQL, against a plain reading, and on odd rows."""

import re

import duckdb
import pytest

from ledgerloom.llm import quality_rules, queries


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeats(w):
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i : i + 5]), []).append(i)
    return len({i + k for places in at.values() if len(places) > 1 for i in places for k in range(5)})


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    assert sorted(tuple(r) for r in queries.op9_quality_rules(spark, sf).collect()) == sorted(con.execute(queries.ORACLES["op9_quality_rules"]).fetchall())


def test_lines_above_the_limits_go(spark):
    def own(i):  # digits are all alike to the rule
        return chr(97 + i % 26) + chr(97 + i // 26)

    body = "here are more than enough words of my own number %s to live on after all of that"
    docs = [(i, f"Read  our COOKIE rules {i % 10}\n{body % own(i)}\nx{own(i)}", "h" if i < 60 else "g") for i in range(75)]
    docs += [(100 + i, "Read our cookie rules 7\nread our cookie rules 1 \n  read our cookie rules 2\nand this bit", "h") for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality_rules.verdicts(df, most_percent=50).collect()}
    assert all(got[i].removed_words == (5 if i < 60 else 0) and got[i].kept for i in range(75))
    assert got[101].removed_words == 15 and not got[101].base_failed and not got[101].kept and got[101].n_dup_lines == 0
    left = {r.doc_id: r.text for r in quality_rules.cleaned(df, most_percent=50).collect()}
    assert left.keys() == set(range(75))
    assert left[0] == body % "aa" + "\nxaa" and left[70] == docs[70][1]


def test_edges_of_the_input(spark):
    long = "a b c d e f " * 30_000
    texts = [None, "", " \n\t", "one two three four five\x0bone two three four five", "p q r s t " * 2 + "z", long, "ß # é|\n\n| é #ß\nß # é|"]
    rows = [(i, t, None if i % 2 else "h", 5) for i, t in enumerate(texts)]
    rows += [(None, "null key", "h", 5), (9, "twice the same row of words that stands here more than once", "h", 6)] + [
        (9, "twice the same row of words that stands here more than once", "h", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words long")
    out = quality_rules.verdicts(df).collect()
    assert len(out) == len(rows) and len(quality_rules.verdicts(df.limit(0)).collect()) == 0
    for r in out:
        if r.doc_id is not None:
            t = next(x[1] for x in rows if x[0] == r.doc_id) or ""
            w = words(t)
            assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), repeats(w))
            assert r.n_symbols == len(re.findall("[#*$%&|<>]", t))
    by = {r.doc_id: r for r in out}
    assert by[6].n_dup_lines == 1 and by[9].kept and by[5].base_failed and by[0].base_failed
    assert quality_rules.cleaned(df).columns == df.columns
