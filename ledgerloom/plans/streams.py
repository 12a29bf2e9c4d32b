"""Queries that run a stream over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import config
from ledgerloom.plans.registry import register
from ledgerloom.session import run_folder, stored
from ledgerloom.sources.tables import read_table
from ledgerloom.streaming.monitor import month_monitor, monthly_stream, months_from_sink

_MONTHS_SQL = """
m AS (SELECT CAST(date_trunc('month', ts) AS DATE) AS month_start, sum(CAST(round(value * 100) AS BIGINT)) AS cents, count(*) AS events,
             CAST(max(ts) AS DATE) AS last_day FROM events GROUP BY 1)"""


def _streamed(spark: SparkSession, d: str) -> DataFrame:
    """The months after the events came in four unordered files, one a batch,
    and the stream was stopped and started again in between."""
    folder = run_folder(spark, "stream")
    events = read_table(spark, d, "events")
    parts = events.withColumn("_no", F.pmod(F.xxhash64("event_id"), F.lit(4)))
    for start in (0, 2):
        parts.where(F.col("_no").between(start, start + 1)).repartition(2, "_no").drop("_no").write.mode("append").parquet(f"{folder}/events")
        query = monthly_stream(spark, f"{folder}/events", f"{folder}/months", f"{folder}/state", files_per_batch=1)
        query.awaitTermination()
    return stored(months_from_sink(spark, f"{folder}/months"), "months")


@register("S1_stream_months", f"""WITH {_MONTHS_SQL}
SELECT month_start, CAST(cents AS BIGINT) AS value_cents, events, last_day FROM m""")
def s1_months(spark: SparkSession, d: str) -> DataFrame:
    """Every month's amount, events and last day, kept as state by the stream."""
    return _streamed(spark, d).select("month_start", "value_cents", "events", "last_day")


@register("S1_stream_monitor", f"""WITH {_MONTHS_SQL},
l AS (SELECT *, cents / 100 AS actual FROM m WHERE month_start = (SELECT max(month_start) FROM m)),
p AS (SELECT l.month_start, l.last_day, l.actual, coalesce(m.cents, 0) / 100 AS last_year FROM l LEFT JOIN m ON m.month_start = l.month_start - INTERVAL 12 MONTH),
t AS (SELECT *, last_year * {config.TARGET_UPLIFT} AS target FROM p)
SELECT month_start, actual, last_year, target, actual / day(last_day) * day(last_day(last_day)) AS run_rate,
       CASE WHEN target > 0 AND actual < {config.ALERT_BELOW} * target THEN 'alert' WHEN target > 0 AND actual >= target THEN 'on_target' ELSE 'watch' END AS status FROM t""")
def s1_monitor(spark: SparkSession, d: str) -> DataFrame:
    """The month monitor's row on the streamed months."""
    return month_monitor(_streamed(spark, d))
