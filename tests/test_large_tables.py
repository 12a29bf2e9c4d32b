"""Work that must not grow with more than the rows: texts copied through steps, lines a task, batches handed to Python."""

import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (the registry comes first)
import corpus_pipeline
from ledgerloom.functions.exprs import is_null_token
from ledgerloom.llm.common import BATCHES
from ledgerloom.operators import cleaning as C
from ledgerloom.plans import dims, raw_profiles
from ledgerloom.plans.dirty import _fixed, dirty_sales

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_are_cloned_before_their_texts_are_made(spark):
    above = _plan(dirty_sales(spark, SF_SMALL)).split("Generate explode")
    assert len(above) == 2 and "date_format" in above[0] and "date_format" not in above[1]


def test_null_like_texts_are_made_where_they_are_counted(spark):
    lines = _plan(raw_profiles.k05_raw(spark, SF_SMALL)).splitlines()
    made = [x for x in lines if "date_format" in x]
    assert len(made) == 1 and "INSET" in made[0] and "AS b1#" in made[0]
    assert "lower(" not in "".join(lines)


def test_missing_value_tokens_in_any_case(spark):
    texts = ["", "  ", "NaN", " nAn", "None", "NULL", "na", "N/a", "NaT", "nanx", "n", "0", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", is_null_token("t").alias("v")).collect()
    assert [r.t for r in rows if not r.v] == ["nanx", "n", "0"]


@pytest.mark.parametrize("places", [0, 1, 2])
def test_numbers_are_written_as_a_formatter_writes_them(spark, places):
    numbers = [0.0, 0.005, 0.015, 1.005, 2.5, 3.5, 0.25, 1234567.895, 99999999999.99, -1.255, -2.0, 1e20, 123456789012345678.0, None, float("nan"), float("inf")]
    rows = spark.createDataFrame([(x,) for x in numbers], "x double")
    got = rows.select(_fixed(F.col("x"), places).alias("a"), F.format_string(f"%.{places}f", "x").alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]


def test_prices_with_and_without_words(spark):
    want = {"INR 5": 5.0, "rs 7.5": 7.5, "Rs 1,200": 1200.0, "₹3": 3.0, "-4": -4.0, "12": 12.0, "INRs 2": None, "por": None, "N/A": None}
    rows = spark.createDataFrame([(t,) for t in want], "t string").select("t", C.parse_price("t").alias("v")).collect()
    assert {r.t: r.v for r in rows} == want


def test_lines_meet_their_customers_in_tasks_of_bounded_size(spark, monkeypatch):
    at = tempfile.mkdtemp(prefix="ll-lines-", dir="/tmp")
    whole = dims.customer_base(spark, SF_SMALL, set(dims.CUSTOMER_COLUMNS))
    whole.write.parquet(f"{at}/whole")
    monkeypatch.setattr(dims, "LINES_A_TASK", 200)
    dealt = dims.customer_base(spark, SF_SMALL, set(dims.CUSTOMER_COLUMNS))
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert f"RepartitionByExpression [o_custkey" in _plan(dealt) and f", {-(-n // 200)}" in _plan(dealt)
    assert "RepartitionByExpression" not in _plan(whole)
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, spark.read.parquet(f"{at}/whole").select(*dealt.columns).collect()))


def test_stages_hand_small_batches_to_python(spark):
    for key in BATCHES:
        spark.conf.unset(key)
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        docs = spark.createDataFrame([(1, "a b c", "en", "s", 5)], ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long"]))
        dict(corpus_pipeline.STAGES)["sentencepiece"](spark, docs, SF_SMALL)
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(4 << 20)
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "7"  # the caller's own
    finally:
        for key in BATCHES:
            spark.conf.unset(key)


def test_stored_buckets_grow_with_the_lines(spark, monkeypatch):
    from ledgerloom.sources.tables import sales
    from ledgerloom.sources.warehouse import StoredWarehouse

    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(dims, "LINES_A_TASK", 400)
    house = StoredWarehouse(spark, "grown_").store(SF_SMALL, ["final_amount_inr"])
    assert house.buckets == -(-n // 400) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = house.table("transactions").join(house.table("customers").hint("merge"), "customer_id")
    assert both.count() == n and "Exchange" not in both._jdf.queryExecution().sparkPlan().toString()
    assert both.rdd.getNumPartitions() == house.buckets
    house.forget()
    plan = _plan(sales(spark, SF_SMALL, ["customer_id"], rows_a_task=400))
    assert "RepartitionByExpression [l_orderkey" in plan and "RepartitionByExpression [o_orderkey" in plan
    fixed = StoredWarehouse(spark, "fixed_", buckets=2).store(SF_SMALL, ["order_year"])
    assert fixed.buckets == 2
    fixed.forget()


def test_days_and_festivals_are_read_off_dates_not_lines(spark):
    from ledgerloom.sources.tables import sales

    got = dims.build_time_dimension(spark, SF_SMALL)
    assert "l_orderkey" not in _plan(got) and "min_by" not in _plan(got)
    tx = sales(spark, SF_SMALL, ["order_date", "is_festival_sale", "festival_name", "transaction_id"])
    by_transaction = dims.build_time_dimension(spark, SF_SMALL, tx)
    rows = got.collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, by_transaction.collect()))
    assert any(r.is_festival for r in rows) and not all(r.is_festival for r in rows)
