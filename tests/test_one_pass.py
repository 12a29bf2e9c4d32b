"""Texts are worked out once, and rows written or read no more often than the answer needs."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (the registry comes first)
from ledgerloom.operators import cleaning as C
from ledgerloom.operators import quality as Q
from ledgerloom.plans import cleaning as P
from ledgerloom.plans import profiles, raw_profiles
from ledgerloom.plans.dirty import dirty_sales
from ledgerloom.sources.tables import sales

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_a_numbers_text_is_worked_out_once(spark):
    texts = [" 12 ", "-3.5", "+.5e2", "1d", "0x1p3", "NaN", "Infinity", "", " ", None, "1.2.3", "12\n", "7\u0085", "1,5", "5.", "."]
    rows = _texts(spark, *texts).select("t", C._num(F.col("t")).alias("v"))
    assert _plan(rows.select("v")).count("trim(") <= 1
    want = {" 12 ": 12.0, "-3.5": -3.5, "+.5e2": 50.0, "12\n": 12.0, "5.": 5.0}
    assert {r.t: r.v for r in rows.collect()} == {t: want.get(t) for t in texts}


def test_null_like_texts_need_no_distinct_texts(spark):
    rows = spark.createDataFrame([("a", None), (" NaN ", "x"), ("", "x"), ("a", "y")], "p string, q string")
    got = {r["column"]: (r.missing, r.missing_pct) for r in Q.null_like(rows).collect()}
    assert got == {"p": (2, 50.0), "q": (1, 25.0)}
    assert Q.null_like(rows.where("false")).collect() == []
    assert "value" not in _plan(raw_profiles.k05_raw(spark, SF_SMALL))


@pytest.mark.parametrize("query", [raw_profiles.k07_distinct, raw_profiles.k07_top, profiles.e16, profiles.k11, P.c01])
def test_the_texts_are_not_written_first(spark, query):
    assert "l_orderkey" in _plan(query(spark, SF_SMALL))


def test_the_texts_are_counted_with_their_nulls(spark):
    rows = spark.createDataFrame([("a", 1), (None, 1), ("a", None)], "p string, q int")
    assert {(r["column"], r.value, r.rows) for r in Q.text_counts(rows, ["p", "q"]).collect()} == {("p", "a", 2), ("p", None, 1), ("q", "1", 2), ("q", None, 1)}


def test_groups_are_hashed_not_sorted(spark):
    plan = profiles.e16(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_the_lines_meet_orders_and_customers_in_one_join(spark):
    lines = [x for x in _plan(sales(spark, SF_SMALL, ["transaction_id", "customer_state"], lines_last=True)).splitlines() if "Join Inner" in x]
    assert "l_orderkey" in lines[0] and not any("l_orderkey" in x for x in lines[1:])


def test_price_evidence_parses_each_price_once(spark):
    assert _plan(profiles.k11(spark, SF_SMALL)).count("INR") <= 2


def test_metrics_take_distinct_values_from_groups(spark):
    raw = dirty_sales(spark, SF_SMALL).select(*profiles._METRIC_COLUMNS)
    plan = _plan(profiles.cleaning_metrics(raw))
    assert plan.count("Expand") <= 1 and "discount_percent" not in plan.split("Expand")[0]


def test_the_run_writes_its_rows_three_times(spark, monkeypatch):
    names = []
    monkeypatch.setattr(C, "stored", lambda df, name, real=C.stored: (names.append(name), real(df, name))[1])
    run, metrics = C.run_cleaning(dirty_sales(spark, SF_SMALL))
    assert names == ["clean", "clean", "cleaned"] and run.count() == metrics["rows_after"]


@pytest.mark.parametrize("query, column", [(raw_profiles.k13_raw, "rel"), (raw_profiles.k11_ratios, "r")])
def test_numbers_are_stored_where_they_are_read_twice(spark, query, column, monkeypatch):
    kept = []
    monkeypatch.setattr(raw_profiles, "stored", lambda df, name, real=raw_profiles.stored: (kept.append(df.columns), real(df, name))[1])
    query(spark, SF_SMALL)
    assert len(kept) == 1 and kept[0][-1] == column


@pytest.mark.parametrize("query, columns", [(P.c03, {"customer_rating", "product_rating"}), (P.c12, {"order_date", "customer_age_group"})])
def test_parsed_values_are_stored_where_they_are_read_twice(spark, query, columns, monkeypatch):
    kept = []
    monkeypatch.setattr(P, "stored", lambda df, name, real=P.stored: (kept.append(df), real(df, name))[1])
    query(spark, SF_SMALL)
    assert len(kept) == 1 and columns <= set(kept[0].columns) and dict(kept[0].dtypes).get("order_date", "date") == "date"
