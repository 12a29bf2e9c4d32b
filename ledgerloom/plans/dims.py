"""Customer, time and product dimensions (K1-K4) with RFM and CLV.

* ``build_customers`` groups the fact by customer (map-side partial
  aggregates: a customer holding a third of all lines collapses before the
  shuffle) for the columns asked for, in one scan and join of the fact,
  then per-customer column expressions.  The only global quantities -- the
  snapshot date, the recency quintile edges and the bounds of the frequency
  and monetary rank quintiles -- are one-row frames (broadcast); no step
  puts all customers in one task, and none joins ranks back.
* ``build_time_dimension`` is a date spine (``sequence`` + ``explode``),
  bounded by the calendar, left-joined with one festival name per date.
* ``build_products`` left-joins lifetime metrics onto the catalog.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import config
from ledgerloom.functions.exprs import flag, lookup, money, msum, paise
from ledgerloom.operators.ranking import rank_bin, rank_cuts
from ledgerloom.session import stored
from ledgerloom.sources.tables import catalog, sales

#: Lines that a task joins to their orders and customers, sorts by transaction (about 600 bytes each, texts included) or stores.
LINES_A_TASK = 500_000
LAST_VALUE_COLUMNS = ["customer_city", "customer_state", "customer_tier", "customer_spending_tier",
                      "customer_age_group"]


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Ordered rule ladder (J8).  r>=4, f>=3, m<=2 falls through to Lost,
    exactly as the rule order of the original leaves it."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 4) & (f >= 3) & (m >= 3), "Loyal Customers")
        .when((r >= 4) & (f <= 2) & (m >= 3), "Potential Loyalists")
        .when((r >= 4) & (f == 1), "New Customers")
        .when((r >= 4) & (f <= 2), "Promising")
        .when((r == 3) & (f >= 3) & (m >= 3), "Loyal Customers")
        .when((r == 3) & (f >= 3), "Need Attention")
        .when((r == 3) & (m >= 4), "Need Attention")
        .when(r == 3, "About to Sleep")
        .when((r <= 2) & (f >= 4) & (m >= 4), "Cannot Lose Them")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r <= 2) & (m >= 4), "At Risk")
        .when(r == 2, "Hibernating")
        .otherwise("Lost")
    )


#: A customer's measures: the inputs they read, what a transaction's lines are reduced to, and what these are reduced to.
_MEASURES = {
    "is_prime_member": (["is_prime_member"], {"p": lambda: F.bool_or("is_prime_member")}, lambda: F.bool_or("p")),
    "first_order_date": (["order_date"], {"d0": lambda: F.min("order_date")}, lambda: F.min("d0")),
    "last_order_date": (["order_date"], {"d1": lambda: F.max("order_date")}, lambda: F.max("d1")),
    "monetary": (["final_amount_inr"], {"m": lambda: F.sum(paise("final_amount_inr"))}, lambda: F.sum("m") / 100.0),
    "units": (["quantity"], {"u": lambda: F.sum("quantity")}, lambda: F.sum("u")),
    "avg_order_value": (["final_amount_inr"], {"m": lambda: F.sum(paise("final_amount_inr")), "mn": lambda: F.count("final_amount_inr")},
                        lambda: F.sum("m") / F.sum("mn") / 100.0),
    "avg_rating": (["customer_rating"], {"r": lambda: F.sum("customer_rating"), "rn": lambda: F.count("customer_rating")},
                   lambda: F.try_divide(F.sum("r"), F.sum("rn"))),
    "return_rate": (["return_status"], {"b": lambda: F.count_if(F.col("return_status") == "Returned"), "bn": lambda: F.count("return_status")},
                    lambda: F.try_divide(F.sum("b").cast("double"), F.sum("bn"))),
    "frequency": (["transaction_id"], {}, lambda: F.count("transaction_id")),
}
#: Columns that derive from others.
_DERIVED = {
    "recency_days": ["last_order_date"], "tenure_days": ["first_order_date", "last_order_date"],
    "acquisition_year": ["first_order_date"], "r_score": ["recency_days"], "f_score": ["frequency"],
    "m_score": ["monetary"], "rfm_segment": ["r_score", "f_score", "m_score"], "rfm_action": ["rfm_segment"],
    "clv": ["avg_order_value", "frequency", "tenure_days", "monetary"],
}
CUSTOMER_COLUMNS = ["customer_id", *LAST_VALUE_COLUMNS, "is_prime_member", "first_order_date", "last_order_date",
                    "frequency", "monetary", "units", "avg_order_value", "avg_rating", "return_rate", "recency_days",
                    "tenure_days", "acquisition_year", "r_score", "f_score", "m_score", "rfm_segment", "rfm_action", "clv"]


def _with_needs(columns: list[str]) -> set[str]:
    todo, seen = list(columns), set()
    while todo:
        c = todo.pop()
        if c not in seen:
            seen.add(c)
            todo += _DERIVED.get(c, [])
    return seen


def customer_base(spark: SparkSession, sf_dir: str, need: set[str]) -> DataFrame:
    """One row per customer with the aggregates in ``need`` and no others, from
    one scan and join of the fact.

    Lines are reduced to transactions, then these to customers: the first
    step's key spreads a customer that holds a third of all lines, and leaves
    one row a transaction, so distinct transactions are a plain count.  Without
    a transaction's columns in ``need`` the first step falls away.  Last
    non-null values travel as (date, value) of their transaction and are
    picked by (date, transaction) in the second step.
    """
    measures = [c for c in _MEASURES if c in need]
    last = [c for c in LAST_VALUE_COLUMNS if c in need]
    by_transaction = bool(last) or "frequency" in need
    inputs = [i for c in measures for i in _MEASURES[c][0]] + (["order_date", "transaction_id", *last] if last else [])
    lines = sales(spark, sf_dir, list(dict.fromkeys(["customer_id", *inputs])), rows_a_task=LINES_A_TASK)
    steps = {n: f() for c in measures for n, f in _MEASURES[c][1].items()}
    steps |= {f"last_{c}": F.max(F.when(F.col(c).isNotNull(), F.struct("order_date", c))) for c in last}
    keys = ["customer_id", "transaction_id"] if by_transaction else ["customer_id"]
    if not steps:  # nothing but the keys
        reduced = lines.select(*keys).distinct()
    else:
        reduced = lines.groupBy(*keys).agg(*[v.alias(n) for n, v in steps.items()])
    out = [_MEASURES[c][2]().alias(c) for c in measures]
    out += [F.max(F.when(F.col(f"last_{c}").isNotNull(), F.struct(f"last_{c}.order_date", "transaction_id", f"last_{c}.{c}")))[c].alias(c) for c in last]
    return reduced.groupBy("customer_id").agg(*out) if out else reduced.select("customer_id").distinct()


def score_rfm(c: DataFrame) -> DataFrame:
    """Add ``r_score``, ``f_score`` and ``m_score`` (J7) to stored customers
    with ``recency_days``, ``frequency`` and ``monetary``."""
    # r: value quintiles of recency, 5 = most recent (right-closed bins)
    # recency takes at most (#days in the calendar span) distinct values, so
    # the built-in exact percentile's value->count map is bounded.
    edges = c.agg(F.percentile("recency_days", [0.2, 0.4, 0.6, 0.8]).alias("_re"))
    x = F.col("recency_days").cast("double")
    higher = F.size(F.filter("_re", lambda e: x > e))
    # f, m: quintile of the rank (ties broken by customer_id), from its eight bounds
    cuts = rank_cuts(c.select("customer_id", "frequency", "monetary"), ["frequency", "monetary"], "customer_id", 5)
    return c.crossJoin(F.broadcast(edges)).crossJoin(F.broadcast(cuts)).withColumns({
        "r_score": (5 - higher).cast("int"), "f_score": rank_bin("frequency", "customer_id"),
        "m_score": rank_bin("monetary", "customer_id")}).drop("_re", "_n", "_cut_frequency", "_cut_monetary")


def build_customers(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """K1: one row per customer: last attributes, value metrics, RFM, CLV.

    ``columns`` (all by default, besides ``customer_id``) decides what is
    read, joined and aggregated; ranks are taken, and the aggregate stored,
    only where a score is asked for.
    """
    wanted = CUSTOMER_COLUMNS if columns is None else list(dict.fromkeys(["customer_id", *columns]))
    need = _with_needs(wanted)
    scored = bool(need & {"r_score", "f_score", "m_score"})
    if scored:
        need |= _with_needs(["rfm_action"])
    c = customer_base(spark, sf_dir, need)
    if "recency_days" in need:
        # the frame feeds the snapshot (one global row: max(date)+1), the
        # quantile edges and the ranks: stored once, so the fact is read once
        c = stored(c, "customers")
        glob = c.agg(F.date_add(F.max("last_order_date"), 1).alias("_snapshot"))
        c = c.crossJoin(F.broadcast(glob)).withColumn("recency_days", F.datediff("_snapshot", "last_order_date")).drop("_snapshot")
    if "tenure_days" in need:
        c = c.withColumn("tenure_days", F.greatest(F.datediff("last_order_date", "first_order_date"), F.lit(0)))
    if "acquisition_year" in need:
        c = c.withColumn("acquisition_year", F.year("first_order_date"))
    if "clv" in need:
        per_year = F.col("frequency") / F.greatest(F.col("tenure_days") / 365.25, F.lit(1 / 12))
        c = c.withColumn("clv", money(F.greatest(F.col("avg_order_value") * per_year * 3, F.col("monetary"))))
    if scored:
        seg = rfm_segment(F.col("r_score"), F.col("f_score"), F.col("m_score"))
        c = score_rfm(c).withColumn("rfm_segment", seg).withColumn("rfm_action", lookup(config.RFM_SEGMENT_MAP, F.col("rfm_segment")))
    return c.select(*wanted)


def build_time_dimension(spark: SparkSession, sf_dir: str, tx: DataFrame | None = None) -> DataFrame:
    """K2: one row per calendar day from first to last order date."""
    if tx is None:
        # the view's festivals follow from the date: no transaction is needed, and the dates, stored once, feed both branches
        # (Spark would drop a distinct below a min, and sort all lines for the names)
        tx = stored(sales(spark, sf_dir, ["order_date", "is_festival_sale", "festival_name"], rows_a_task=LINES_A_TASK).distinct(), "days")
        first = F.min("festival_name")
    else:  # first festival name per date in (date, transaction id) order
        first = F.min_by("festival_name", "transaction_id")
    span = tx.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    spine = span.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    fest = (
        tx.where(F.col("is_festival_sale") & F.col("festival_name").isNotNull())
        .groupBy("order_date")
        .agg(first.alias("festival_name"))
        .withColumnRenamed("order_date", "date")
    )
    d = F.col("date")
    return spine.join(fest, "date", "left").select(
        "date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day"),
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekday(d).isin(5, 6).alias("is_weekend"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        "festival_name",
        F.col("festival_name").isNotNull().alias("is_festival"),
    )


def build_products(spark: SparkSession, sf_dir: str, tx: DataFrame | None = None) -> DataFrame:
    """K3: catalog plus lifetime metrics (D1: left join, missing counts -> 0)."""
    tx = tx if tx is not None else sales(spark, sf_dir, [
        "product_id", "quantity", "transaction_id", "final_amount_inr", "discount_percent",
        "customer_rating", "return_status", "order_date"])
    metrics = tx.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        F.countDistinct("transaction_id").alias("orders"),
        msum("final_amount_inr").alias("revenue"),
        F.avg("discount_percent").alias("avg_discount"),
        F.avg("customer_rating").alias("avg_customer_rating"),
        F.avg(flag(F.col("return_status") == "Returned")).alias("return_rate"),
        F.min("order_date").alias("first_sold"),
        F.max("order_date").alias("last_sold"),
    )
    out = catalog(spark, sf_dir).join(metrics, "product_id", "left")
    return out.select(
        *[c for c in out.columns if c not in ("units_sold", "orders", "revenue")],
        F.coalesce("units_sold", F.lit(0)).cast("long").alias("units_sold"),
        F.coalesce("orders", F.lit(0)).cast("long").alias("orders"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
    )


def dimension_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: long-form summary (metric, key, value) of the three dimensions."""
    cust = build_customers(spark, sf_dir, ["rfm_segment"])
    seg = cust.groupBy("rfm_segment").agg(F.count("*").alias("value")).select(
        F.lit("rfm_segment").alias("metric"), F.col("rfm_segment").alias("key"), F.col("value").cast("long"))
    n_c = cust.agg(F.count("*").alias("value")).select(F.lit("customers").alias("metric"),
                                                        F.lit(None).cast("string").alias("key"), "value")
    n_t = build_time_dimension(spark, sf_dir).agg(F.count("*").alias("value")).select(
        F.lit("time_rows").alias("metric"), F.lit(None).cast("string").alias("key"), "value")
    n_p = catalog(spark, sf_dir).agg(F.count("*").alias("value")).select(
        F.lit("products").alias("metric"), F.lit(None).cast("string").alias("key"), "value")
    snap = sales(spark, sf_dir, ["order_date"]).agg(F.date_add(F.max("order_date"), 1).alias("d")).select(
        F.lit("snapshot_date").alias("metric"), F.col("d").cast("string").alias("key"), F.lit(0).cast("long").alias("value"))
    return n_c.unionByName(seg).unionByName(n_t).unionByName(n_p).unionByName(snap)


# ------------------------------------------------------------------ registry
from ledgerloom.plans.oracle_sql import CATALOG_CTE, CUSTOMERS_CTE, sql_mavg, sql_msum, with_sales  # noqa: E402
from ledgerloom.plans.registry import register  # noqa: E402


@register("K01_customers", with_sales("SELECT * FROM customers", CUSTOMERS_CTE))
def q_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 customer dimension (J7 RFM scores, J8 segments, J9 CLV)."""
    return build_customers(spark, sf_dir)


@register("K02_time_dimension", with_sales("""
SELECT d AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, strftime(d, '%b') AS month_name,
       CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day,
       CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
       isodow(d) >= 6 AS is_weekend, strftime(d, '%Y-%m') AS year_month,
       CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter,
       f.festival_name, f.festival_name IS NOT NULL AS is_festival
FROM (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS d
      FROM sales) spine
LEFT JOIN (SELECT order_date, arg_min(festival_name, transaction_id) AS festival_name
           FROM sales WHERE is_festival_sale AND festival_name IS NOT NULL GROUP BY order_date) f
  ON f.order_date = spine.d
"""))
def q_time_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 time dimension."""
    return build_time_dimension(spark, sf_dir)


@register("K03_products", with_sales("""
SELECT p.*,
  m.avg_discount, m.avg_customer_rating, m.return_rate, m.first_sold, m.last_sold,
  CAST(coalesce(m.units_sold, 0) AS BIGINT) AS units_sold,
  CAST(coalesce(m.orders, 0) AS BIGINT) AS orders,
  coalesce(m.revenue, 0.0) AS revenue
FROM products p LEFT JOIN (
  SELECT product_id, sum(quantity) AS units_sold, count(DISTINCT transaction_id) AS orders,
         (SUM(CAST(round(final_amount_inr * 100) AS BIGINT)) / 100) AS revenue,
         avg(discount_percent) AS avg_discount,
         avg(customer_rating) AS avg_customer_rating,
         avg(CASE WHEN return_status = 'Returned' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS return_rate,
         min(order_date) AS first_sold, max(order_date) AS last_sold
  FROM sales GROUP BY product_id) m ON p.product_id = m.product_id
""", CATALOG_CTE))
def q_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 product dimension."""
    return build_products(spark, sf_dir)


@register("K04_dimension_summary", with_sales("""
SELECT 'customers' AS metric, CAST(NULL AS VARCHAR) AS key, count(*) AS value FROM customers
UNION ALL SELECT 'rfm_segment', rfm_segment, count(*) FROM customers GROUP BY rfm_segment
UNION ALL SELECT 'time_rows', NULL, max(order_date) - min(order_date) + 1 FROM sales
UNION ALL SELECT 'products', NULL, count(*) FROM part
UNION ALL SELECT 'snapshot_date', CAST(max(order_date) + 1 AS VARCHAR), 0 FROM sales
""", CUSTOMERS_CTE))
def q_dimension_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 dimension summary (counts, segment counts, snapshot date)."""
    return dimension_summary(spark, sf_dir)


L5_SQL = f"""
SELECT rfm_segment,
       COUNT(*)                   AS customers,
       {sql_msum("monetary")}         AS revenue,
       {sql_mavg("clv")}              AS avg_clv
FROM customers
GROUP BY rfm_segment
ORDER BY revenue DESC
"""


@register("L05_rfm_segment_value", with_sales(L5_SQL, CUSTOMERS_CTE))
def rfm_segment_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFM segment customers, revenue, average CLV (SQL over the customers view)."""
    from ledgerloom.sources.warehouse import register_views, run_sql

    register_views(spark, sf_dir, customers=["rfm_segment", "monetary", "clv"])
    return run_sql(spark, L5_SQL)
