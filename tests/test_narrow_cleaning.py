"""Cleaned rows without the run's report: the same rows, from the raw columns
they need, each value carried once."""

import __spark_entry__ as entry
from ledgerloom.operators import cleaning as C
from ledgerloom.plans.dirty import RAW_INPUT

from conftest import SF_SMALL


def _raw(spark):
    base = dict.fromkeys([c for c in RAW_INPUT if c != "order_day"], "") | {
        "order_date": "2016-02-03", "order_month": "2", "order_year": "2016", "customer_id": "7", "product_id": "1", "final_amount_inr": "90.00",
        "original_price_inr": "Rs 100", "discounted_price_inr": "90", "discount_percent": "10", "customer_city": " new  delhi", "delivery_days": "express",
        "payment_method": "upi", "customer_rating": "4 stars", "source_file": "b.csv"}
    rows = [{"transaction_id": "t1"}, {"transaction_id": "t1_DUP"}, {"transaction_id": "t0", "source_file": "c.csv", "customer_rating": "1"},
            {"transaction_id": "t2", "customer_id": None, "customer_age_group": "18-25"}, {"transaction_id": "t3", "customer_id": None, "order_date": "05/02/2016"},
            {"transaction_id": "t3", "customer_id": None, "order_date": "05/02/2016"}, {"transaction_id": None, "product_id": "2", "customer_age_group": "55+"},
            {"transaction_id": "t4", "order_date": "never"}]
    names = list({**base, "transaction_id": ""})
    return spark.createDataFrame([tuple((base | r)[c] for c in names) for r in rows], ", ".join(f"{c} string" for c in names))


def test_narrow_rows_are_those_of_the_run(spark):
    raw = _raw(spark)
    run = C.run_cleaning(raw)[0]
    assert run.count() == 4
    every = C.clean_transactions(raw)
    assert sorted(every.columns) == sorted(run.columns)
    assert sorted(map(repr, every.select(*run.columns).collect())) == sorted(map(repr, run.collect()))
    for columns in (["delivery_days", "delivery_type"], ["order_day", "customer_city"], ["customer_rating_imputed", "original_price_inr"],
                    ["payment_method_group", "customer_age_group"], ["transaction_id", "customer_id", "final_amount_inr", "quantity"]):
        few = C.clean_transactions(raw.select(*C.raw_columns(columns)), columns)
        assert few.columns == columns
        assert sorted(map(repr, few.collect())) == sorted(map(repr, run.select(*columns).collect()))


def test_a_row_travels_once_to_its_key(spark):
    raw = _raw(spark)
    sent = C.first_rows(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert sent.count("brand, brand#") == 1
    got = {r.transaction_id: r["__more"] for r in C.first_rows(raw).collect()}
    assert got == {"t1": 2, "t2": 0, "t3": 1, None: 0, "t4": 0}


def test_amounts_are_parsed_without_the_age_look_up(spark):
    plan = entry.queries()["C11_residual_roundtrip"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" not in plan and "c_acctbal" not in plan.split("Relation")[0]
