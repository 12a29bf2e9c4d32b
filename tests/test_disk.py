"""Rows that are cleaned in parts, and files that don't outlive their use: the same results with less on disk at a time."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.operators import cleaning as C
from ledgerloom.plans.dirty import RAW_INPUT
from ledgerloom.session import forget, stored_parts
from ledgerloom.sources import raw as R

from conftest import SF_SMALL


def _raw(spark):
    """Rows with clones, repeated and null keys, several products with ratings, several years."""
    base = dict.fromkeys([c for c in RAW_INPUT if c != "order_day"], "") | {
        "order_date": "2016-02-03", "order_month": "2", "order_year": "2016", "final_amount_inr": "90.00", "original_price_inr": "Rs 100",
        "discounted_price_inr": "90", "discount_percent": "10", "customer_city": "pune", "payment_method": "upi", "source_file": "b.csv"}
    rows = [{"transaction_id": f"t{i}", "customer_id": str(i % 7) if i % 7 else None, "product_id": str(i % 3) if i % 3 else None, "order_date": f"{2014 + i % 4}-02-0{1 + i % 5}",
             "customer_rating": f"{1 + i % 5}" if i % 4 else "", "customer_age_group": "55+" if i % 6 == 1 else ""} for i in range(60)]
    rows += [r | {"transaction_id": r["transaction_id"] + "_DUP", "customer_rating": "5"} for r in rows[:9]] + [r | {"source_file": "c.csv"} for r in rows[5:20]] + rows[30:33]
    rows += [{"transaction_id": "u", "order_date": "never", "customer_id": "1", "product_id": "1"}]
    names = list({**base, "transaction_id": "", "customer_id": "", "product_id": ""})
    return spark.createDataFrame([tuple((base | r)[c] for c in names) for r in rows], ", ".join(f"{c} string" for c in names))


def _sorted(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def _files(spark):
    at = spark.sparkContext.getCheckpointDir()
    return {d for d in os.listdir(at.removeprefix("file:")) if "-" in d}


@pytest.mark.parametrize("columns", [None, ["customer_rating_imputed", "order_day"]])
def test_rows_cleaned_in_parts_are_the_same(spark, columns):
    raw = _raw(spark)
    at_once, in_parts = C.clean_transactions(raw, columns), C.clean_transactions(raw, columns, parts=2)
    assert at_once.columns == in_parts.columns and _sorted(at_once) == _sorted(in_parts)
    assert at_once.count() == 60


def test_a_customer_lies_in_one_part(spark):
    raw = _raw(spark)
    parts = [{r.customer_id for r in x.select("customer_id").collect()} for x in C.by_customer(raw, 4)]
    assert sum(map(len, parts)) == len(set.union(*parts)) == 7 and None in set.union(*parts)
    assert (C.parts_of(0), C.parts_of(C.ROWS_A_PART), C.parts_of(C.ROWS_A_PART + 1), C.parts_of(10**12)) == (1, 1, 2, C.MOST_PARTS)


def test_a3_leaves_its_rows_and_nothing_else(spark, monkeypatch):
    was = sorted(map(repr, entry.queries()["A3_cleaned_by_year"](spark, SF_SMALL).collect()))
    monkeypatch.setattr(C, "parts_of", lambda rows: 2)
    before = _files(spark)
    got = entry.queries()["A3_cleaned_by_year"](spark, SF_SMALL)
    left = _files(spark) - before
    assert {x.rpartition("-")[0] for x in left} == {"cleaning-run"}
    assert sorted(map(repr, got.collect())) == was


def test_sorted_years_are_written_in_runs(spark):
    rows = spark.createDataFrame([(y, f"{y}-0{d}-01", str(i)) for i, (y, d) in enumerate((y, d) for y in (None, 2001, 2002, 2003, 2004) for d in (3, 1, 2))],
                                 "order_year int, order_date string, transaction_id string")
    assert len(R._in_runs(rows, "order_year", 3)) == 3 and len(R._in_runs(rows.where("false"), "order_year", 3)) == 1
    out = tempfile.mkdtemp(prefix="ll-years-", dir="/tmp")
    for _ in range(2):  # a second write takes the first one's place
        R.write_parquet(rows, f"{out}/t", parts=3)
    back = spark.read.parquet(f"{out}/t")
    assert _sorted(back) == _sorted(rows) and len([x for x in os.listdir(f"{out}/t") if x.startswith("order_year=")]) == 5
    for file in back.where("order_year = 2003").inputFiles():
        dates = [r.order_date for r in spark.read.parquet(file).collect()]
        assert dates == sorted(dates)


def test_shuffle_files_go_with_the_write(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    was = local.getAllFiles().size()
    frame = stored_parts([spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()], "freed")
    assert local.getAllFiles().size() <= was
    assert frame.count() == 7
    forget(frame)
    assert not os.path.exists(frame._stored_at)
    assert spark.conf.get(key) == before


def test_a_run_in_parts_reports_the_same(spark, monkeypatch):
    raw, out = _raw(spark), tempfile.mkdtemp(prefix="ll-parts-", dir="/tmp")
    run, metrics = C.run_cleaning(raw)
    rows = _sorted(run)
    monkeypatch.setattr(C, "parts_of", lambda n: 2)
    before = _files(spark)
    again, same = C.run_cleaning(raw, None, out)
    assert same == metrics and _sorted(again) == rows and not _files(spark) - before
    assert spark.read.option("header", True).csv(f"{out}/transactions_cleaned_csv").count() == len(rows) == metrics["rows_after"]
    empty, none = C.run_cleaning(raw.where("false"))
    assert empty.count() == 0 and none["rows_after"] == 0 and none["date_min"] is None


def test_k14_verifies_the_same_rows_in_parts(spark, monkeypatch):
    was = _sorted(entry.queries()["K14_verification"](spark, SF_SMALL))
    monkeypatch.setattr(C, "parts_of", lambda rows: 2)
    before = _files(spark)
    got = entry.queries()["K14_verification"](spark, SF_SMALL)
    assert _sorted(got) == was
    assert {x.rpartition("-")[0] for x in _files(spark) - before}.isdisjoint({"raw", "kept", "medians"})


def test_a1_scans_packed_files(spark):
    before = _files(spark)
    got = entry.queries()["A1_raw_scan"](spark, SF_SMALL).collect()
    at = next(x for x in _files(spark) - before if x.startswith("raw-csv"))
    top = f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/{at}"
    files = [f"{d}/{f}" for d, _, names in os.walk(top) for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert spark.read.option("header", True).csv(files).count() == sum(r.rows for r in got) > 0
