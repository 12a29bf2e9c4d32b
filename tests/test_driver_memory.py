"""What reaches the driver: keys that compress well are not broadcast, and
questions that need several sums of the fact read it once."""

import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.operators.journey import transitions
from ledgerloom.operators.shares import share_of

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_side_of_several_mb_of_parquet_is_not_broadcast(spark):
    at = tempfile.mkdtemp(prefix="ll-keys-", dir="/tmp")
    spark.range(600_000).select(F.xxhash64("id").alias("k")).write.mode("overwrite").parquet(f"{at}/keys")
    keys = spark.read.parquet(f"{at}/keys")
    both = keys.join(keys.withColumnRenamed("k", "j"), F.col("k") == F.col("j"))
    assert "Broadcast" not in both._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["L11_category_performance", "L12_prime_impact", "L19_top8_share_first_last", "L23_top_transitions", "L44_top8_brand_share"])
def test_the_fact_is_read_once(spark, name):
    assert "l_orderkey" not in _plan(entry.queries()[name](spark, SF_SMALL))


def test_shares_and_states_come_from_stored_rows(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, None), (2, 1, "b"), (None, 1, "c")], "e int, t int, s string")
    got = {(r["from_state"], r["to_state"]): r["transitions"] for r in transitions(rows, "e", ["t"], "s").collect()}
    assert got == {(x, y): int((x, y) == ("a", "b")) for x in "abc" for y in "abc"}
    shares = share_of(rows.groupBy("s").agg(F.count("*").alias("n")), "n")
    assert "LocalRelation" not in _plan(shares) and sorted((r.s or "", r.share) for r in shares.collect()) == [("", 0.2), ("a", 0.2), ("b", 0.4), ("c", 0.2)]
