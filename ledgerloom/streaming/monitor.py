"""Structured Streaming version of the month monitor (J14) on ``events``.

Each micro-batch is reduced to days inside the tasks that read it (a busy
month sends a row a task and day, not its events), then every month's running
state -- amount, events, last day, late events -- is brought up to date by
``applyInPandasWithState``.  The state is the stream's own: it survives a
restart from the checkpoint, and its size is the calendar's.  An event counts
whenever it comes; one whose day had ended before the watermark is counted as
late as well.

The sink holds one folder a month, replaced as a whole when the month
changes: a batch that is replayed after a failure writes the same rows again,
and a reader sees as many files as there are months, however many batches ran.
``monthly_batch`` is the same answer as a batch plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerloom import config

_DAY = "month_start date, day date, value_cents long, events long, seen timestamp"
_MONTH = "month_start date, value_cents long, events long, last_day date, late_events long"
_STATE = "value_cents long, events long, last_day int, late_events long"


def _with_day(events: DataFrame) -> DataFrame:
    """Events with their calendar day, as the table states it, and a time for the watermark."""
    return events.select(F.to_date("ts").alias("day"), F.col("ts").cast("timestamp").alias("ts"), F.round(F.col("value") * 100).cast("long").alias("cents"))


def monthly_batch(events: DataFrame) -> DataFrame:
    """(month_start, value_cents, events, last_day) of a whole table."""
    return _with_day(events).groupBy(F.trunc("day", "month").alias("month_start")).agg(
        F.sum("cents").alias("value_cents"), F.count("*").alias("events"), F.max("day").alias("last_day"))


def _to_days(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's events by day, with the latest of each: it moves the watermark."""
    held: dict = {}
    for batch in batches:
        some = batch.dropna(subset=["day"])
        by = some.groupby("day").agg(cents=("cents", "sum"), n=("cents", "size"), seen=("ts", "max"))
        for day, cents, n, seen in zip(by.index, by["cents"], by["n"], by["seen"]):
            a, b, c = held.get(day, (0, 0, seen))
            held[day] = (a + int(cents), b + int(n), max(c, seen))
    if held:
        yield pd.DataFrame({"month_start": [d.replace(day=1) for d in held], "day": list(held), "value_cents": [c for c, _, _ in held.values()],
                            "events": [n for _, n, _ in held.values()], "seen": [s for _, _, s in held.values()]})


def _month(key: tuple, days: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A month's state brought up to date, and its row."""
    cents, events, last, late = state.get if state.exists else (0, 0, 0, 0)
    watermark = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms").date()
    for part in days:
        cents, events = cents + int(part["value_cents"].sum()), events + int(part["events"].sum())
        last = max(last, max(d.day for d in part["day"]))
        late += int(part.loc[[d < watermark for d in part["day"]], "events"].sum())
    state.update((cents, events, last, late))
    yield pd.DataFrame({"month_start": [key[0]], "value_cents": [cents], "events": [events], "last_day": [key[0].replace(day=last)], "late_events": [late]})


def monthly_stream(spark: SparkSession, events_dir: str, sink_dir: str, checkpoint_dir: str,
                   late: str = "7 days", files_per_batch: int | None = None) -> StreamingQuery:
    """Start the monitor with ``availableNow`` (process what is there, stop)."""
    reader = spark.readStream.schema(spark.read.parquet(events_dir).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    days = _with_day(reader.parquet(events_dir)).mapInPandas(_to_days, _DAY).withWatermark("seen", late)
    months = days.groupBy("month_start").applyInPandasWithState(_month, _MONTH, _STATE, "update", GroupStateTimeout.NoTimeout)

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("month", F.date_format("month_start", "yyyy-MM")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(sink_dir))

    return (months.writeStream.outputMode("update").option("checkpointLocation", checkpoint_dir)
            .foreachBatch(write).trigger(availableNow=True).start())


def months_from_sink(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The latest row of every month."""
    return spark.read.parquet(sink_dir).drop("month")


def month_monitor(months: DataFrame) -> DataFrame:
    """J14 on months (month_start, value_cents, last_day): the latest month's
    actual, the same month a year before, the target, the run rate to the
    month's end and the status.  One row; no row for an empty frame."""
    last = months.agg(F.max(F.struct("month_start", "last_day")).alias("x")).where("x IS NOT NULL").select(F.col("x.month_start").alias("m0"), F.col("x.last_day").alias("d"))
    sums = months.crossJoin(F.broadcast(last)).groupBy("d", "m0").agg(
        (F.sum(F.when(F.col("month_start") == F.col("m0"), F.col("value_cents"))) / 100).alias("actual"),
        (F.coalesce(F.sum(F.when(F.col("month_start") == F.add_months("m0", -12), F.col("value_cents"))), F.lit(0)) / 100).alias("last_year"))
    out = sums.withColumn("target", F.col("last_year") * config.TARGET_UPLIFT).withColumn(
        "run_rate", F.col("actual") / F.dayofmonth("d") * F.dayofmonth(F.last_day("d")))
    status = (F.when((F.col("target") > 0) & (F.col("actual") < config.ALERT_BELOW * F.col("target")), "alert")
              .when((F.col("target") > 0) & (F.col("actual") >= F.col("target")), "on_target").otherwise("watch"))
    return out.select(F.col("m0").alias("month_start"), "actual", "last_year", "target", "run_rate", status.alias("status"))
