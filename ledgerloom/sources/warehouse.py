"""Warehouse views (A7) and parameterised SQL.

``register_views`` exposes the star schema under the reference's table
names -- ``transactions``, ``products``, ``customers``, ``time_dimension``
-- as session temp views.  Views are logical plans: Catalyst pushes the
statement's filters and column selection into the parquet scans, and the
``transactions`` view carries only the columns the caller lists.

``StoredWarehouse`` is the same schema as tables on disk.  Transactions and
customers are bucketed and sorted by the customer, so per-customer work over
them needs no shuffle however often it runs; transactions are partitioned by
year, so a year can be read, or replaced, by itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import run_folder
from ledgerloom.sources.tables import SALES_COLUMNS, catalog, line_tasks, sales


def register_views(spark: SparkSession, sf_dir: str, transactions: Iterable[str] | None = None,
                   products: bool = False, customers: bool | list[str] = False, time_dimension: bool = False) -> None:
    if transactions is not None:
        sales(spark, sf_dir, transactions).createOrReplaceTempView("transactions")
    if products:
        catalog(spark, sf_dir).createOrReplaceTempView("products")
    if customers:
        from ledgerloom.plans.dims import build_customers

        build_customers(spark, sf_dir, None if customers is True else customers).createOrReplaceTempView("customers")
    if time_dimension:
        from ledgerloom.plans.dims import build_time_dimension

        build_time_dimension(spark, sf_dir).createOrReplaceTempView("time_dimension")


def run_sql(spark: SparkSession, statement: str, params: Mapping | None = None) -> DataFrame:
    """Run a (named-parameter) SQL statement; ``:name`` markers bind ``params``."""
    return spark.sql(statement, args=dict(params) if params else None)


def table_counts(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Row count of each of the registered tables ``names`` (A7 report), one small union."""
    return spark.sql(" UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in sorted(names)))


class StoredWarehouse:
    """The star schema as stored tables named ``<prefix><table>`` in a folder
    (a new one in the shared folder by default).  Unless ``buckets`` is given,
    their number is the session's partitions, and grows with the lines stored
    beyond them: one task writes, and later joins, one bucket."""

    TABLES = ("transactions", "products", "customers", "time_dimension")

    def __init__(self, spark: SparkSession, prefix: str = "", folder: str | None = None, buckets: int | None = None):
        self.spark, self.prefix = spark, prefix
        self.folder = folder or run_folder(spark, "warehouse")
        self.grows = not buckets
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def name(self, table: str) -> str:
        return f"{self.prefix}{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def _write(self, df: DataFrame, table: str, bucket: str | None, partition: str | None = None) -> None:
        if bucket:  # one file a bucket (and partition): each task holds whole buckets
            df = df.repartition(self.buckets, bucket)
        w = df.write.mode("overwrite").option("path", f"{self.folder}/{table}")
        if partition:
            w = w.partitionBy(partition)
        if bucket:
            w = w.bucketBy(self.buckets, bucket).sortBy(bucket)
        w.saveAsTable(self.name(table))

    def store(self, sf_dir: str, columns: Iterable[str] | None = None) -> "StoredWarehouse":
        """Write all four tables; ``columns`` narrows the transactions."""
        from ledgerloom.plans.dims import LINES_A_TASK, build_customers, build_time_dimension

        if self.grows:
            self.buckets = line_tasks(self.spark, sf_dir, LINES_A_TASK)
        wanted = list(columns) if columns is not None else list(SALES_COLUMNS)
        wanted = list(dict.fromkeys([*wanted, "customer_id", "order_year"]))
        self._write(sales(self.spark, sf_dir, wanted, rows_a_task=LINES_A_TASK), "transactions", "customer_id", "order_year")
        self._write(build_customers(self.spark, sf_dir), "customers", "customer_id")
        self._write(catalog(self.spark, sf_dir), "products", "product_id")
        self._write(build_time_dimension(self.spark, sf_dir), "time_dimension", None)
        return self

    def replace_years(self, rows: DataFrame) -> None:
        """Replace the years that ``rows`` hold, and no others, by ``rows``:
        dynamic partition overwrite, in the table's own buckets."""
        have = self.table("transactions").columns
        rows = rows.select(*have).repartition(self.buckets, "customer_id")
        # inserts into a table take this from the session alone; it is put back as it was
        setting, conf = "spark.sql.sources.partitionOverwriteMode", self.spark.conf
        before = conf.get(setting)
        conf.set(setting, "dynamic")
        try:
            rows.write.insertInto(self.name("transactions"), overwrite=True)
        finally:
            conf.set(setting, before)
        self.spark.catalog.refreshTable(self.name("transactions"))

    def counts(self) -> DataFrame:
        """Rows of each of the four tables."""
        parts = [f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {self.name(t)}" for t in self.TABLES]
        return self.spark.sql(" UNION ALL ".join(parts))

    def forget(self) -> None:
        """Drop the tables' names; their files stay in the folder."""
        for t in self.TABLES:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(t)}")
