"""Operator properties: distributed ranks / quantiles equal their
single-node definitions, skew-safe lag equals the window lag, shares sum
to one, and answers do not depend on the shuffle partition count."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators.journey import lag_within
from ledgerloom.operators.ranking import exact_quantiles, global_row_number, quantile_band, rank_bin, rank_cuts
from ledgerloom.operators.shares import share_of

from conftest import SF_SMALL


def _skewed(spark, n=3000):
    rng = np.random.default_rng(7)
    key = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 50, n))  # one key holds a third
    val = np.round(rng.gamma(2.0, 50.0, n), 2)
    val[::7] = 42.0  # heavy ties
    pdf = pd.DataFrame({"k": key.astype("int64"), "id": np.arange(n, dtype="int64"), "v": val})
    return spark.createDataFrame(pdf), pdf


def test_global_row_number_matches_sort(spark):
    df, pdf = _skewed(spark)
    got = global_row_number(df, ["v", "id"], "r", num_partitions=7).select("id", "r").toPandas()
    want = pdf.sort_values(["v", "id"]).reset_index(drop=True)
    want["r"] = np.arange(1, len(want) + 1)
    m = got.merge(want[["id", "r"]], on="id", suffixes=("", "_w"))
    assert len(m) == len(pdf) and (m["r"] == m["r_w"]).all()


def test_exact_quantiles_match_numpy(spark):
    df, pdf = _skewed(spark)
    probs = [0.0, 0.2, 0.5, 0.75, 1.0]
    got = exact_quantiles(df, "v", probs, by=["k"], name="q", num_partitions=5).toPandas().set_index("k")
    for k, g in pdf.groupby("k"):
        want = np.quantile(g["v"].to_numpy(), probs)
        assert np.allclose(got.loc[k, [f"q{i}" for i in range(len(probs))]].to_numpy(float), want)


def test_quantile_band_is_qcut(spark):
    df, pdf = _skewed(spark)
    got = quantile_band(df.where(F.col("k") > 0), "v", 4, ["a", "b", "c", "d"], "b").select("id", "b").toPandas()
    sub = pdf[pdf.k > 0]
    want = pd.qcut(sub["v"], 4, labels=["a", "b", "c", "d"], duplicates="drop")
    m = got.merge(pd.DataFrame({"id": sub["id"], "w": want.astype(str)}), on="id")
    assert (m["b"] == m["w"]).mean() == 1.0


def test_rank_bins_equal_qcut_of_rank(spark):
    """Ties, two measures at once, few rows, and one value that half the rows have."""
    rng = np.random.default_rng(3)
    for n in [1, 2, 6, 7, 23, 354]:
        pdf = pd.DataFrame({"id": rng.permutation(n).astype("int64"), "a": rng.integers(0, 4, n).astype("int64"), "b": np.round(rng.normal(size=n), 1)})
        df = spark.createDataFrame(pdf)
        cuts = rank_cuts(df, ["a", "b"], "id", 5)
        assert cuts.count() == 1
        got = df.crossJoin(F.broadcast(cuts)).select("id", rank_bin("a", "id").alias("a"), rank_bin("b", "id").alias("b")).toPandas().set_index("id")
        for m in ("a", "b"):
            order = pdf.sort_values([m, "id"])["id"].to_numpy()
            want = pd.qcut(pd.Series(np.arange(1, n + 1)), 5, labels=[1, 2, 3, 4, 5]).astype(int).to_numpy() if n > 1 else [3]
            assert list(got.loc[order, m]) == list(want), (n, m)


def test_one_group_of_all_rows_and_unique_values(spark):
    """No window spans a group: the plan partitions its windows by the range too, and a null is a group."""
    df = spark.range(20_000).select(F.when(F.col("id") % 1000 > 0, F.lit("all")).alias("g"), (F.col("id") * 7919 % 20_011).cast("double").alias("v"))
    got = exact_quantiles(df, "v", [0.1, 0.5, 0.99], by=["g"], num_partitions=6)
    rows = {r.g: (r.q0, r.q1, r.q2) for r in got.collect()}
    pdf = df.toPandas()
    for g, some in (("all", pdf[pdf.g == "all"]), (None, pdf[pdf.g.isna()])):
        assert np.allclose(rows[g], np.quantile(some["v"], [0.1, 0.5, 0.99]))
    plan = got._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x and "sum(_w" in x]
    assert windows and all("_pid" in x.split("windowspecdefinition(")[1] for x in windows)
    weighted = df.groupBy("g", "v").agg(F.lit(3).cast("long").alias("w"))
    assert exact_quantiles(weighted, "v", [0.5], by=["g"], weight="w").where("g = 'all'").first().q0 == np.quantile(np.repeat(pdf[pdf.g == "all"]["v"], 3), 0.5)


def test_equal_edges_of_quantile_bins_are_an_error(spark):
    import pytest

    df = spark.createDataFrame([(float(min(i, 2)),) for i in range(20)], "v double")
    with pytest.raises(Exception, match="two edges are equal"):
        quantile_band(df, "v", 4).collect()


def test_lag_within_equals_window_lag(spark):
    df, pdf = _skewed(spark)
    got = lag_within(df, "k", ["v", "id"], "id", "prev").select("id", "prev").toPandas()
    w = Window.partitionBy("k").orderBy("v", "id")
    want = df.select("id", F.lag("id").over(w).alias("p")).toPandas()
    m = got.merge(want, on="id")
    assert len(m) == len(pdf)
    assert ((m["prev"] == m["p"]) | (m["prev"].isna() & m["p"].isna())).all()


def test_shares_sum_to_one(spark):
    df, _ = _skewed(spark)
    agg = df.groupBy("k").agg(F.sum("v").alias("s"))
    total = share_of(agg, "s", name="sh").agg(F.sum("sh")).first()[0]
    assert abs(total - 1.0) < 1e-9


def test_same_answer_at_2_and_64_partitions(spark):
    import __spark_entry__ as entry

    qs = entry.queries()
    names = ["L01_yearly_kpis", "K01_customers", "L23_transitions", "L18_return_by_price_quintile"]
    out = {}
    for parts in (2, 64):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        out[parts] = {n: sorted(map(tuple, qs[n](spark, SF_SMALL).collect()), key=repr) for n in names}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[2] == out[64]


def test_ranks_without_exchange_reuse(spark):
    """Range bounds are sampled: at this size two evaluations would differ."""
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(500_000).select(F.col("id"), F.xxhash64("id").alias("v"), (F.col("id") % 7).alias("k"))
        r = global_row_number(df, ["v", "id"], "r", num_partitions=8)
        row = r.agg(F.min("r"), F.max("r"), F.count_distinct("r")).first()
        assert tuple(row) == (1, 500_000, 500_000)
        lagged = lag_within(df, "k", ["v", "id"], "v", "p")
        bad = lagged.where(F.col("p") > F.col("v")).count()
        assert bad == 0 and lagged.where(F.col("p").isNull()).count() == 7
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_association_rules_from_bit_sets(spark):
    """More items than a word has bits, repeats, nulls, an entity with everything, too many items."""
    import pytest

    from ledgerloom.operators.journey import association_rules

    rng = np.random.default_rng(5)
    rows = [(int(e), f"i{i:03d}") for e in range(120) for i in rng.choice(90, rng.integers(1, 6), replace=False)]
    rows += [(500, f"i{i:03d}") for i in range(90)] + rows[:50] + [(None, "i000"), (3, None)]
    df = spark.createDataFrame(rows, "e long, i string")
    got = {(r["from"], r["to"]): (r.support, r.confidence) for r in association_rules(df, "e", "i").collect()}
    sets = {}
    for e, i in rows:
        if e is not None and i is not None:
            sets.setdefault(e, set()).add(i)
    items = sorted(set().union(*sets.values()))
    assert len(got) == len(items) * (len(items) - 1)
    for a in items:
        own = sum(a in s for s in sets.values())
        for b in items:
            if a != b:
                both = sum(a in s and b in s for s in sets.values())
                assert got[a, b] == (both / len(sets), both / own)
    plan = association_rules(df, "e", "i")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "HashJoin" not in plan
    with pytest.raises(ValueError, match="more than 80 items"):
        association_rules(df, "e", "i", max_items=80)
    assert association_rules(df.limit(0), "e", "i").count() == 0
