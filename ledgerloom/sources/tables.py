"""Input tables and the enriched ``sales`` view.

The analytics questions run over one fact table of order lines with
customer, product, geography, payment and delivery attributes.  On the
provided star schema that table is ``lineitem ⋈ orders ⋈ customer ⋈
nation ⋈ region ⋈ part`` with the column mapping below.

Scale notes
-----------
* ``sales(spark, dir, columns)`` joins **only** the tables the requested
  columns need.  Spark cannot drop an inner join by itself, so a question
  about revenue by year never shuffles the fact against ``customer`` or
  ``part``.  Every source is read with just the columns it contributes,
  so the parquet scan's ``ReadSchema`` is the minimum.
* ``lineitem ⋈ orders`` is the one fact-to-fact join, made only when a
  column of ``orders`` (or beyond) is asked for: every line has its order
  (the D14 integrity query counts lines that don't).  It is an equi-join on ``orderkey`` that Spark executes as a sort-merge join (or shuffled
  hash join under AQE).  ``nation``/``region`` are tiny and are joined to
  ``customer`` *before* the fact join, so the fact meets one pre-joined
  customer table.  No side is forced into a broadcast: Spark's
  size-checked ``autoBroadcastJoinThreshold`` and AQE decide at run time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import config

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

DEFAULT_DIR = "/root/testdata/sf0.01"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------------ mapping
# Fixture mapping of the star schema onto sales attributes (ours, see
# FIXTURES.md §2).  Labels reuse the fixed vocabularies in ``config``.
PRIORITY_TO_PAYMENT = {
    "1-URGENT": "UPI",
    "2-HIGH": "Credit Card",
    "3-MEDIUM": "Debit Card",
    "4-NOT SPECIFIED": "COD",
    "5-LOW": "Wallet",
}
TIER_BY_NATION_MOD4 = ["Metro", "Tier1", "Tier2", "Rural"]
AGE_BANDS = [(0, "18-25"), (2000, "26-35"), (4000, "36-45"), (6000, "46-55"), (8000, "55+")]
FESTIVAL_BY_MONTH = {10: "Diwali Sale", 11: "Amazon Great Indian Festival"}
RETURN_BY_FLAG = {"R": "Returned", "A": "Cancelled", "N": "Delivered"}
DELIVERY_TYPE_BY_LINE_MOD3 = ["Same Day", "Express", "Standard"]
LAUNCH_BASE_YEAR = 1994


def _lit_map(mapping: dict) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def _order_date() -> Column:
    return F.to_date(F.col("o_orderdate"))


def _quantity() -> Column:
    return F.col("l_quantity").cast("int")


# Money is whole paise: amounts are built in exact integer arithmetic and
# rounded half-up to the paisa, as transaction amounts are, so every sum of
# money is an exact integer sum (see functions.exprs.msum).
_EP_PAISE = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_DISC = "CAST(round(abs(l_discount) * 100) AS BIGINT)"
_QTY = "CAST(l_quantity AS BIGINT)"


def _disc_pct() -> Column:
    # abs() turns the fixture's -0.0 into 0.0
    return F.expr(_DISC)


def _paise(integer_expr: str) -> Column:
    return F.expr(integer_expr) / 100.0


def _age_group() -> Column:
    expr = F.when(F.col("c_acctbal") < 0, F.lit("Unknown"))
    for lo, label in reversed(AGE_BANDS):
        expr = expr.when(F.col("c_acctbal") >= lo, F.lit(label))
    return expr


def _festival_name() -> Column:
    m = F.month(_order_date())
    expr = None
    for month, name in FESTIVAL_BY_MONTH.items():
        expr = F.when(m == month, F.lit(name)) if expr is None else expr.when(m == month, F.lit(name))
    return expr


def _payment_method() -> Column:
    expr = None
    for priority, method in PRIORITY_TO_PAYMENT.items():
        expr = (F if expr is None else expr).when(F.col("o_orderpriority") == priority, F.lit(method))
    return expr


# name -> (source columns, expression builder)
_SALES: dict[str, tuple[tuple[str, ...], object]] = {
    "transaction_id": (
        ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"),
        lambda: F.concat_ws(
            "-",
            F.col("l_orderkey").cast("string"),
            F.col("l_linenumber").cast("string"),
            F.col("l_partkey").cast("string"),
            F.col("l_suppkey").cast("string"),
            _quantity().cast("string"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
        ),
    ),
    "order_date": (("o_orderdate",), _order_date),
    "order_year": (("o_orderdate",), lambda: F.year(_order_date())),
    "order_month": (("o_orderdate",), lambda: F.month(_order_date())),
    "order_quarter": (("o_orderdate",), lambda: F.quarter(_order_date())),
    "order_day": (("o_orderdate",), lambda: F.dayofmonth(_order_date())),
    "customer_id": (("o_custkey",), lambda: F.col("o_custkey")),
    "product_id": (("l_partkey",), lambda: F.col("l_partkey")),
    "product_name": (("p_name",), lambda: F.col("p_name")),
    "category": ((), lambda: F.lit("Electronics")),
    "subcategory": (("p_type",), lambda: F.col("p_type")),
    "brand": (("p_brand",), lambda: F.col("p_brand")),
    "quantity": (("l_quantity",), _quantity),
    "discount_percent": (("l_discount",), lambda: _disc_pct().cast("double")),
    "original_price_inr": (("l_extendedprice", "l_quantity"), lambda: _paise(
        f"(2 * {_EP_PAISE} + {_QTY}) DIV (2 * {_QTY})")),
    "discounted_price_inr": (("l_extendedprice", "l_quantity", "l_discount"), lambda: _paise(
        f"(2 * {_EP_PAISE} * (100 - {_DISC}) + 100 * {_QTY}) DIV (200 * {_QTY})")),
    "subtotal_inr": (("l_extendedprice", "l_discount"), lambda: _paise(
        f"({_EP_PAISE} * (100 - {_DISC}) + 50) DIV 100")),
    "delivery_charges": (("l_extendedprice", "l_tax"), lambda: _paise(
        f"({_EP_PAISE} * CAST(round(l_tax * 100) AS BIGINT) + 50) DIV 100")),
    "final_amount_inr": (("l_extendedprice", "l_discount"), lambda: _paise(
        f"({_EP_PAISE} * (100 - {_DISC}) + 50) DIV 100")),
    "customer_city": (("n_name",), lambda: F.col("n_name")),
    "customer_state": (("r_name",), lambda: F.col("r_name")),
    "customer_tier": (
        ("c_nationkey",),
        lambda: F.element_at(
            F.array(*[F.lit(t) for t in TIER_BY_NATION_MOD4]),
            (F.col("c_nationkey") % 4 + 1).cast("int"),
        ),
    ),
    "customer_spending_tier": (("c_mktsegment",), lambda: F.col("c_mktsegment")),
    "customer_age_group": (("c_acctbal",), _age_group),
    "payment_method": (("o_orderpriority",), _payment_method),
    "payment_method_group": (
        ("o_orderpriority",),
        lambda: F.coalesce(F.try_element_at(_lit_map(config.PAYMENT_HIERARCHY), _payment_method()), F.lit("Other")),
    ),
    "delivery_days": (
        ("l_orderkey", "l_partkey"),
        lambda: (1 + (F.col("l_orderkey") + F.col("l_partkey")) % 7).cast("int"),
    ),
    "delivery_type": (
        ("l_linenumber",),
        lambda: F.element_at(
            F.array(*[F.lit(t) for t in DELIVERY_TYPE_BY_LINE_MOD3]),
            (F.col("l_linenumber") % 3 + 1).cast("int"),
        ),
    ),
    "is_prime_member": (("l_orderkey",), lambda: (F.col("l_orderkey") % 3) == 0),
    "is_festival_sale": (("o_orderdate",), lambda: F.month(_order_date()).isin(*FESTIVAL_BY_MONTH)),
    "festival_name": (("o_orderdate",), _festival_name),
    "customer_rating": (
        ("l_orderkey", "l_partkey"),
        lambda: F.when((F.col("l_orderkey") % 10) >= 3, 3 + 0.5 * (F.col("l_partkey") % 5)),
    ),
    "return_status": (("l_returnflag",), lambda: F.try_element_at(_lit_map(RETURN_BY_FLAG), F.col("l_returnflag"))),
    "product_weight_kg": (("p_size",), lambda: F.col("p_size") / 10.0),
    "is_prime_eligible": (("p_size",), lambda: (F.col("p_size") % 2) == 0),
    "product_rating": (("p_size",), lambda: 3 + (F.col("p_size") % 21) / 10),
}

SALES_COLUMNS = tuple(_SALES)

_PREFIX_TABLE = {"l_": "lineitem", "o_": "orders", "c_": "customer", "n_": "nation", "r_": "region", "p_": "part"}


def _table_of(col: str) -> str:
    return _PREFIX_TABLE[col[:2]]


def line_tasks(spark: SparkSession, sf_dir: str, rows_a_task: int) -> int:
    """Tasks for work over all lines: the session's partitions, and beyond them
    as many as the lines fill at ``rows_a_task`` (the files state their rows,
    none is read for it)."""
    lines = read_table(spark, sf_dir, "lineitem").count()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines // rows_a_task))


def sales(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None,
          years: tuple[int, int] | None = None, lines_last: bool = False, rows_a_task: int | None = None) -> DataFrame:
    """The enriched order-line fact with only ``columns`` (default: all), of
    orders in ``years`` (a range on the date column itself, which parquet
    statistics answer).  ``lines_last`` joins the customers to the orders
    before the lines, which then travel once for both; without it the lines
    are left by customer, which saves who groups by customer an exchange.
    ``rows_a_task`` bounds the lines that meet their orders, and their
    customers, in one task, on average (see ``line_tasks``)."""
    cols = list(columns) if columns is not None else list(SALES_COLUMNS)
    unknown = [c for c in cols if c not in _SALES]
    if unknown:
        raise KeyError(f"unknown sales columns: {unknown}")
    src: dict[str, set[str]] = {}
    for c in cols:
        for s in _SALES[c][0]:
            src.setdefault(_table_of(s), set()).add(s)
    # join keys
    need_part = "part" in src
    need_geo = "nation" in src or "region" in src
    need_cust = "customer" in src or need_geo
    if years is not None:
        src.setdefault("orders", set()).add("o_orderdate")
    need_orders = "orders" in src or need_cust
    lines = src.setdefault("lineitem", set())
    if need_orders or not lines:
        lines.add("l_orderkey")
    if need_orders:
        src.setdefault("orders", set()).add("o_orderkey")
    if need_part:
        src["lineitem"].add("l_partkey")
        src["part"].add("p_partkey")
    if need_cust:
        src["orders"].add("o_custkey")
        src.setdefault("customer", set()).add("c_custkey")
    if need_geo:
        src["customer"].add("c_nationkey")
        src.setdefault("nation", set()).update({"n_nationkey", "n_regionkey"} if "region" in src else {"n_nationkey"})
        if "region" in src:
            src["region"].add("r_regionkey")

    def scan(name: str) -> DataFrame:
        table = read_table(spark, sf_dir, name)
        if name == "orders" and years is not None:
            kind = table.schema["o_orderdate"].dataType
            table = table.where((F.col("o_orderdate") >= F.lit(f"{years[0]:04d}-01-01").cast(kind))
                                & (F.col("o_orderdate") < F.lit(f"{years[1] + 1:04d}-01-01").cast(kind)))
        return table.select(*sorted(src[name]))

    tasks = line_tasks(spark, sf_dir, rows_a_task) if rows_a_task is not None and need_orders else 0
    more = tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))

    def dealt(df: DataFrame, key: str) -> DataFrame:
        return df.repartition(tasks, key) if more else df

    fact = scan("lineitem")
    if need_orders:
        orders = scan("orders")
        if not lines_last:
            fact = dealt(fact, "l_orderkey").join(dealt(orders, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    if need_cust:
        cust = scan("customer")
        if need_geo:
            geo = scan("nation")
            if "region" in src:
                geo = geo.join(scan("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            cust = cust.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
        if lines_last:
            orders = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
        else:
            fact = dealt(fact, "o_custkey").join(cust, F.col("o_custkey") == F.col("c_custkey"))
    if need_orders and lines_last:
        fact = dealt(fact, "l_orderkey").join(dealt(orders, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    if need_part:
        fact = fact.join(scan("part"), F.col("l_partkey") == F.col("p_partkey"))
    return fact.select(*[_SALES[c][1]().alias(c) for c in cols])


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product catalog (one row per product) from ``part``."""
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.lit("Electronics").alias("category"),
        F.col("p_type").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("base_price_2015"),
        (F.col("p_size") / 10.0).alias("weight_kg"),
        (3 + (F.col("p_size") % 21) / 10).alias("rating"),
        ((F.col("p_size") % 2) == 0).alias("is_prime_eligible"),
        (LAUNCH_BASE_YEAR + F.col("p_partkey") % 8).cast("int").alias("launch_year"),
        F.concat(F.lit("M-"), F.col("p_partkey").cast("string")).alias("model"),
    )
