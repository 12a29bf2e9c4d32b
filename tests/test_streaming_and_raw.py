import os
import tempfile

from pyspark.sql import functions as F

from ledgerloom.sources.raw import headers, load_raw_transactions, scan_raw_transactions, write_csv
from ledgerloom.streaming.monitor import month_monitor, monthly_batch, monthly_stream, months_from_sink

from conftest import SF_SMALL


def test_stream_equals_batch_after_disorder_and_a_restart(spark):
    """Files out of order, one a batch; stopped and started again; late events counted as such and as events."""
    work = tempfile.mkdtemp(prefix="ll-stream-", dir="/tmp")
    # the table's events all lie in one month: they are dealt over two years
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.expr("ts + make_dt_interval(CAST(event_id * 37 % 730 AS INT))"))
    events.write.parquet(f"{work}/all")
    events = spark.read.parquet(f"{work}/all")
    middle = events.agg(F.expr("percentile_approx(CAST(ts AS TIMESTAMP), 0.3)")).first()[0]
    early = F.col("ts").cast("timestamp") < F.lit(middle)
    parts = events.withColumn("late", early)
    for late in (False, True):  # the earliest events come last
        parts.where(F.col("late") == late).drop("late").repartition(3, "event_id").write.mode("append").parquet(f"{work}/events")
        q = monthly_stream(spark, f"{work}/events", f"{work}/sink", f"{work}/ckpt", late="1 day", files_per_batch=1)
        q.awaitTermination(240)
        assert q.exception() is None
    rows = months_from_sink(spark, f"{work}/sink").collect()
    want = {tuple(r) for r in monthly_batch(events).select("month_start", "value_cents", "events", "last_day").collect()}
    assert {(r.month_start, r.value_cents, r.events, r.last_day) for r in rows} == want and len(rows) == len(want)
    n_late = events.where(early & (F.col("ts").cast("timestamp") < F.date_sub(F.lit(middle), 3))).count()
    assert sum(r.late_events for r in rows) >= n_late > 0
    files = [f for _, _, fs in os.walk(f"{work}/sink") for f in fs if f.endswith(".parquet")]
    assert len(files) == len(want)  # one a month, however many batches ran
    row = month_monitor(months_from_sink(spark, f"{work}/sink")).first()
    assert row == month_monitor(monthly_batch(events)).first()
    assert month_monitor(monthly_batch(events.limit(0))).count() == 0


def test_raw_csv_round_trip(spark):
    from ledgerloom.plans.dirty import dirty_sales

    work = tempfile.mkdtemp(prefix="ll-raw-", dir="/tmp")
    raw = dirty_sales(spark, SF_SMALL).drop("source_file")
    write_csv(raw, f"{work}/csv")
    back = load_raw_transactions(spark, f"{work}/csv/*.csv", raw.columns)
    assert back.count() == raw.count()
    assert back.where(F.col("source_file").isNull()).count() == 0


def test_csv_columns_bind_by_name_and_blanks_stay(spark):
    work = tempfile.mkdtemp(prefix="ll-raw-", dir="/tmp")
    for name, text in (("a.csv", "x,y\n1,\n2,b\n"), ("b.csv", "y,x\nc,3\n"), ("c.csv", "x\n\"4\"\n")):
        with open(f"{work}/{name}", "w") as f:
            f.write(text)
    rows = load_raw_transactions(spark, f"{work}/*.csv", ["x", "y"]).collect()
    assert sorted(map(tuple, rows)) == [("1", "", "a.csv"), ("2", "b", "a.csv"), ("3", "c", "b.csv"), ("4", None, "c.csv")]
    assert load_raw_transactions(spark, f"{work}/a.csv", ["y", "z"]).columns == ["y", "z", "source_file"]


def test_ragged_lines_are_kept_apart_and_headers_need_no_full_read(spark):
    work = tempfile.mkdtemp(prefix="ll-raw-", dir="/tmp")
    with open(f"{work}/a.csv", "w") as f:
        f.write("x,y\n1,a\n2\n3,c,d\n\"4\",\"e,f\"\n")
    with open(f"{work}/b.csv", "w") as f:
        f.write("\ufeffy,x\nb,5\n")
    open(f"{work}/empty.csv", "w").close()
    rows, ragged = scan_raw_transactions(spark, f"{work}/*.csv", ["x", "y"])
    assert sorted(map(tuple, rows.collect())) == [("1", "a", "a.csv"), ("4", "e,f", "a.csv"), ("5", "b", "b.csv")]
    assert sorted(map(tuple, ragged.collect())) == [("2", "a.csv"), ("3,c,d", "a.csv")]
    assert {h: len(f) for h, f in headers(spark, f"{work}/*.csv").items()} == {("x", "y"): 1, ("y", "x"): 1}


def test_a_cleaning_run_leaves_sorted_files_and_its_report(spark):
    from ledgerloom.operators.cleaning import run_cleaning
    from ledgerloom.plans.dirty import dirty_files
    from ledgerloom.sources.raw import read_metrics
    from ledgerloom.sources.tables import catalog

    out = tempfile.mkdtemp(prefix="ll-run-", dir="/tmp")
    raw = dirty_files(spark, SF_SMALL)
    df, metrics = run_cleaning(raw, catalog(spark, SF_SMALL), out)
    assert metrics == read_metrics(spark, f"{out}/cleaning_metrics.json")
    assert metrics["rows_before"] == raw.count() and metrics["rows_after"] == df.count() == metrics["q8_duplicates"]["rows_after"]
    assert metrics["rows_before"] == sum(metrics["q6_category"]["raw_value_counts"].values()) == sum(metrics["q6_category"]["after_value_counts"].values())
    assert sum(metrics["q10_payment"]["hierarchy_counts"].values()) == metrics["rows_after"]
    # within every file rows are in the order of date and id, and a file belongs to one year
    held = df.select("order_year", "order_date", "transaction_id", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")).toPandas()
    for _, g in held.sort_values("i").groupby("f"):
        pairs = list(zip(g["order_date"], g["transaction_id"]))
        assert pairs == sorted(pairs) and g["order_year"].nunique() == 1
    # nothing is read but the raw files and what the run itself wrote, and a second run agrees
    again, same = run_cleaning(raw, catalog(spark, SF_SMALL))
    assert same == metrics and again.count() == df.count()
    empty, none = run_cleaning(raw.limit(0))
    assert empty.count() == 0 and none["rows_after"] == 0 and none["date_min"] is None


def test_stored_warehouse_joins_without_an_exchange(spark):
    from ledgerloom.sources.warehouse import StoredWarehouse

    house = StoredWarehouse(spark, "t_", buckets=4).store(SF_SMALL, ["final_amount_inr", "transaction_id"])
    counts = {r.table_name: r.row_count for r in house.counts().collect()}
    assert set(counts) == set(house.TABLES) and all(counts.values())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = house.table("transactions").join(house.table("customers"), "customer_id")
        by = joined.groupBy("customer_id").agg(F.sum("final_amount_inr").alias("s"), F.first("monetary").alias("m"))
        plan = by._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert by.where("abs(s - m) > 0.01").count() == 0 and by.count() == counts["customers"]
        orders = house.table("transactions").groupBy("customer_id", "transaction_id").count().groupBy("customer_id").count()
        assert "Exchange" not in orders._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    before = {r.order_year: r["count"] for r in house.table("transactions").groupBy("order_year").count().collect()}
    year = min(before)
    seven = house.table("transactions").where(F.col("order_year") == year).limit(7).collect()
    house.replace_years(spark.createDataFrame(seven, house.table("transactions").schema))
    after = {r.order_year: r["count"] for r in house.table("transactions").groupBy("order_year").count().collect()}
    assert after == before | {year: 7}
    house.forget()
    assert not spark.catalog.tableExists("t_transactions")
