"""Raw scans (A1, A2, A9) and sinks.

The raw transaction files are read all-string (no inference pass), columns
bound by *name*: files are grouped by their header line, each group is one
scan with its own column order, and the groups are combined with
``unionByName(allowMissingColumns=True)``.  Blank fields stay ``""``; only a
column that a file lacks is null.  ``source_file`` is the file's name.
"""

from __future__ import annotations

import csv
import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import freed_shuffles

RAW_TRANSACTION_COLUMNS = [
    "transaction_id", "order_date", "customer_id", "product_id", "product_name", "category", "subcategory",
    "brand", "original_price_inr", "discount_percent", "discounted_price_inr", "quantity", "subtotal_inr",
    "delivery_charges", "final_amount_inr", "customer_city", "customer_state", "customer_tier",
    "customer_spending_tier", "customer_age_group", "payment_method", "delivery_days", "delivery_type",
    "is_prime_member", "is_festival_sale", "festival_name", "customer_rating", "return_status", "order_month",
    "order_year", "order_quarter", "product_weight_kg", "is_prime_eligible", "product_rating",
]
CATALOG_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType()), T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("subcategory", T.StringType()),
    T.StructField("brand", T.StringType()), T.StructField("base_price_2015", T.DoubleType()),
    T.StructField("weight_kg", T.DoubleType()), T.StructField("rating", T.DoubleType()),
    T.StructField("is_prime_eligible", T.StringType()), T.StructField("launch_year", T.IntegerType()),
    T.StructField("model", T.StringType()),
])


def all_string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def headers(spark: SparkSession, path_glob: str) -> dict[tuple[str, ...], list[str]]:
    """{header columns: files} of the matching files.

    A listing names the files (their content isn't a column that is read);
    each file's first line comes from a ``limit(1)`` scan, which ends with the
    first bytes of the first split.  No file is read as a whole."""
    files = sorted(r.path for r in spark.read.format("binaryFile").load(path_glob).select("path").collect())

    def first(path: str) -> str | None:
        row = spark.read.text(path).first()
        return row and row.value

    with ThreadPoolExecutor(8) as pool:
        lines = list(pool.map(first, files))
    out: dict[tuple[str, ...], list[str]] = {}
    for path, line in zip(files, lines):
        if line is not None:  # an empty file has no rows either
            out.setdefault(tuple(next(csv.reader([line.lstrip("\ufeff")]))), []).append(path)
    return out


#: The text of a line that has more or fewer fields than its file's header.
RAGGED = "ragged_line"


def scan_raw_lines(spark: SparkSession, path_glob: str, columns: list[str] | None = None) -> DataFrame:
    """A1: all-string CSV scan of every matching file, plus ``ragged_line`` (null
    for a row) and ``source_file``: rows and ragged lines in one frame, for
    who asks for both in one pass.

    ``columns`` (the known raw columns by default) come back in this order,
    whatever order a file has them in; a file without one gives nulls.  A
    file that has none of them is an error.  A line with more or fewer fields
    than its file's header would put values into wrong columns: its text is
    in ``ragged_line``.
    """
    wanted = list(columns or RAW_TRANSACTION_COLUMNS)
    parts = []
    for header, files in headers(spark, path_glob).items():
        present = [c for c in wanted if c in header]
        if not present or len(set(header)) != len(header):
            raise ValueError(f"no known column, or one twice, in the header {header} of {files[0]}")
        schema = all_string_schema([*header, RAGGED])
        df = (spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", RAGGED).option("emptyValue", "").csv(files))
        # the reader gives unquoted blanks as null; a text file has no nulls
        texts = [F.coalesce(c, F.lit("")).alias(c) for c in present]
        # read with all fields beside it: the reader only notices a missing or extra field among those it is asked for
        ragged = F.when(F.length(F.concat_ws("", *header)) >= 0, F.col(RAGGED)).alias(RAGGED)
        parts.append(df.select(*texts, ragged, F.col("_metadata.file_name").alias("source_file")))
    if not parts:
        raise FileNotFoundError(path_glob)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    missing = [F.lit(None).cast("string").alias(c) for c in wanted if c not in out.columns]
    return out.select("*", *missing).select(*wanted, RAGGED, "source_file")


def scan_raw_transactions(spark: SparkSession, path_glob: str, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """A1: ``scan_raw_lines`` as (rows, ragged lines)."""
    out = scan_raw_lines(spark, path_glob, columns)
    return out.where(F.col(RAGGED).isNull()).drop(RAGGED), out.where(F.col(RAGGED).isNotNull()).select(RAGGED, "source_file")


def load_raw_transactions(spark: SparkSession, path_glob: str,
                          columns: list[str] | None = None) -> DataFrame:
    """The rows of ``scan_raw_transactions``."""
    return scan_raw_transactions(spark, path_glob, columns)[0]


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A2: catalog CSV with a fixed schema, then category / flag / trim cleaning."""
    from ledgerloom.operators.cleaning import parse_bool, standardise_category

    df = spark.read.schema(CATALOG_SCHEMA).option("header", True).csv(path)
    return df.withColumns({
        "category": standardise_category("category"),
        "is_prime_eligible": parse_bool("is_prime_eligible"),
        "product_name": F.trim("product_name"), "brand": F.trim("brand"), "subcategory": F.trim("subcategory"),
    })


def _in_runs(df: DataFrame, column: str, parts: int) -> list[DataFrame]:
    """``df`` cut between values of ``column`` into runs of about equal size, ``parts`` at most."""
    sizes = sorted(((r[0], r[1]) for r in df.groupBy(column).count().collect()), key=lambda r: (r[0] is not None, r[0]))
    rows, seen, runs = sum(n for _, n in sizes), 0, {}
    for value, n in sizes:
        runs.setdefault(seen * parts // rows, []).append(value)
        seen += n
    is_in = [F.col(column).isin([v for v in run if v is not None]) | (F.col(column).isNull() if None in run else F.lit(False)) for run in runs.values()]
    return [df.where(F.coalesce(x, F.lit(False))) for x in is_in] or [df]


def write_parquet(df: DataFrame, path: str, partition_by: str | None = "order_year",
                  sort_by: tuple[str, ...] = ("order_date", "transaction_id"), sort: bool = True, parts: int = 1) -> None:
    """A3 / G1: parquet sink sorted by (date, id); partitioned by year so later
    year filters prune files.  The sort is a range partitioning, so no task
    holds more than its share, and files hold runs of dates.  ``sort=False``:
    the rows are in ranges already.  With ``parts`` the partitions are written
    in so many runs, and only one run's rows lie in shuffle files at a time
    (``df`` is read once a run: for stored frames)."""
    order = [c for c in sort_by if c in df.columns]
    by = [partition_by] if partition_by and partition_by in df.columns else []
    with freed_shuffles(df.sparkSession):
        for i, run in enumerate(_in_runs(df, *by, parts) if by and parts > 1 else [df]):
            if order and sort:
                run = run.repartitionByRange(*order)
            if order:  # the writer's own order by partition comes first, or it would sort the rows again
                run = run.sortWithinPartitions(*by, *order)
            w = run.write.mode("overwrite")
            if i:  # beside the runs before it
                w = w.option("partitionOverwriteMode", "dynamic")
            (w.partitionBy(*by) if by else w).parquet(path)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """A4: CSV sink with header."""
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)


def write_metrics(spark: SparkSession, metrics: dict, path: str) -> None:
    """A report as one JSON document, written by Spark (so to any store it reaches)."""
    spark.createDataFrame([(json.dumps(metrics, indent=2, default=str, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_metrics(spark: SparkSession, path: str) -> dict:
    """The report that ``write_metrics`` left."""
    return json.loads(spark.read.text(path, wholetext=True).first().value)
