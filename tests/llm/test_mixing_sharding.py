"""Mixing against its SQL and a plain reading of the rule; the lookup table's promises."""

import math
import re
from collections import Counter

import duckdb
import pytest

from ledgerloom.llm import mixing, queries, sharding

SF = "/root/testdata/sf0.01"


def oracle(name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    return sorted(con.execute(queries.ORACLES[name]).fetchall())


@pytest.mark.parametrize("name", ["op2_mixing", "op3_sharding"])
def test_query_matches_sql(spark, name):
    assert sorted(tuple(r) for r in queries.QUERIES[name](spark, SF).collect()) == oracle(name)


def targets(sizes, cap=3):
    """{source: size} to {source: target} by sharing and resharing."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    stopped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(cap * sizes[s] for s in stopped)
        load = sum(weight[s] for s in names if s not in stopped)
        share = {s: cap * sizes[s] if s in stopped else weight[s] * left / load for s in names}
        more = {s for s in names if s not in stopped and share[s] > cap * sizes[s]}
        if not more:
            return share
        stopped |= more


def test_targets_stop_and_reshare(spark):
    sizes = {"a": 900, "b": 10, "c": 3, "Z": 40, "é": 0, None: 47, "d": 500}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = targets(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s]) for s in want)
    assert got["c"] == 9 and got["é"] == 0


def test_edges_of_the_input(spark):
    rows = [(i, "w " * (i % 5 + 1), "s%d" % (i % 4) if i % 9 else None, 1) for i in range(600)]
    rows += [(None, None, "s0", 1), (None, None, None, 1), (7000, "", "empty", 1), (7001, "long " * 100_000, "long", 1)]
    rows += [(8000, "again and again", "s1", 2)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    out = mixing.mixed(docs).collect()
    assert len(out) == len(rows)
    size = Counter()
    for i, t, s, _ in rows:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want, taken = targets(size), Counter()
    for r in out:
        assert r["__source_size"] == size[r.source] and math.isclose(r["__target"], want[r.source], abs_tol=1e-9)
        assert 0 <= r["__copies"] <= 3
        taken[r.source] += r["__size"] * r["__copies"]
    assert all(abs(taken[s] - want[s]) <= 5 for s in want if s != "long")
    assert abs(taken["long"] - want["long"]) <= 50_000
    assert len({r["__copies"] for r in out if r.doc_id == 8000}) == 1
    mix = mixing.mix(docs)
    assert mix.columns == docs.columns and mix.count() == sum(r["__copies"] for r in out)
    assert mixing.mixed(docs.limit(0)).count() == 0
    again = mixing.mixed(docs.repartition(13)).collect()
    assert sorted(again, key=str) == sorted(out, key=str)


def test_table_is_even_and_moves_little():
    names = [f"shard-{i:04d}" for i in range(16)]
    table = sharding.fill_table(names, 2039)
    assert sorted(Counter(table).values()) == [127] * 9 + [128] * 7
    fewer = sharding.fill_table(names[:7] + names[8:], 2039)
    back = {i: i if i < 7 else i + 1 for i in range(15)}
    moved = sum(a != back[b] for a, b in zip(table, fewer) if a != 7)
    assert moved < 0.15 * 2039
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill_table(bad, 2039)
    with pytest.raises(ValueError):
        sharding.fill_table(["a"], 2040)


def test_placing_rows(spark):
    docs = spark.createDataFrame([(1, "x", 5), (1, "y", 6), (None, "z", 7), (None, None, 8), (2, "", 9)], "doc_id long, text string, slot long")
    out = sharding.place(docs, ["a", "b", "c"], 13)
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "slot", "shard"] and len(rows) == 5
    assert len({(r.slot, r.shard) for r in rows if r.doc_id == 1}) == 1 and len({r.slot for r in rows if r.doc_id is None}) == 1
    assert all(sharding.fill_table(["a", "b", "c"], 13)[r.slot] == r.shard for r in rows)
    assert sharding.place(docs.limit(0), ["a"], 13).count() == 0


def test_no_row_is_taken_more_often_than_the_cap(spark):
    """Rows without words lie on both sides of the threshold of a source that stops at three times its size."""
    rows = [(i, "a b c" if i % 3 else "", "small") for i in range(120)] + [(1000 + i, "word " * 400, "large") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mixed(df).collect()
    assert max(r["__copies"] for r in plan) <= 3
    copies = Counter(r.doc_id for r in mixing.mix(df).collect())
    assert max(copies.values()) <= 3


@pytest.mark.parametrize("parts", [1, 7])
def test_a_budget_that_ends_among_repeated_rows(spark, parts):
    """One document repeated holds most of a source: as many of its rows are taken as come nearest to the target."""
    rows = [(1, "one two three four five six seven", "a")] * 400 + [(i, f"w{i} x", "a") for i in range(2, 40)] + [(i, "y " * 30, "b") for i in range(100, 160)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
    out = mixing.mixed(df).collect()
    for source in ("a", "b"):
        mine = [r for r in out if r.source == source]
        taken, target = sum(r["__size"] * r["__copies"] for r in mine), mine[0]["__target"]
        assert abs(taken - target) <= max(r["__size"] for r in mine)
    assert len(out) == len(rows) and len({r["__copies"] for r in out if r.doc_id == 1}) == 2


def test_columns_of_any_name(spark):
    names = ["passes", "below", "__s", "__hash", "__size", "some", "alike", "__slot", "__shard", "__at", "at", "hash", "copies"]
    rows = [(i, f"text {i}", "s" if i % 3 else None, *range(len(names))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` int" for n in names))
    mixed = mixing.mixed(df)
    assert mixed.columns == [c for c in df.columns if c != "__size"] + ["__size", "__source_size", "__target", "__copies"]
    assert all(r["__hash"] == 3 and r.passes == 0 and r.copies == 12 for r in mixed.collect())
    assert mixing.mix(df).columns == df.columns and {r["__size"] for r in mixing.mix(df).collect()} <= {4}
    placed = sharding.place(df, ["x", "y"], 11)
    assert placed.columns == [*df.columns, "slot", "shard"]
    assert all((r["__slot"], r["__shard"], r["__at"], r["at"]) == (7, 8, 9, 10) for r in placed.collect())
