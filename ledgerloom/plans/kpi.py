"""SQL KPI set (L1-L6) -- the warehouse questions, as Spark SQL.

Each question registers the ``transactions`` view (A7) with just the
columns its SQL reads, so the view never drags in a dimension join the
statement does not need, then runs the statement with ``spark.sql`` (A8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans.oracle_sql import CATALOG_CTE, sql_mavg, sql_msum, with_sales
from ledgerloom.plans.registry import register
from ledgerloom.sources.warehouse import register_views, run_sql

L1_SQL = f"""
SELECT order_year,
       {sql_msum("final_amount_inr")}   AS revenue,
       COUNT(*)                          AS orders,
       COUNT(DISTINCT customer_id)       AS active_customers,
       {sql_mavg("final_amount_inr")}   AS aov
FROM transactions
GROUP BY order_year
ORDER BY order_year
"""


@register("L01_yearly_kpis", with_sales(L1_SQL.replace("transactions", "sales")))
def yearly_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: yearly revenue, orders, active customers, AOV."""
    register_views(spark, sf_dir, transactions=["order_year", "final_amount_inr", "customer_id"])
    return run_sql(spark, L1_SQL)


L2_SQL = f"""
SELECT subcategory,
       {sql_msum("final_amount_inr")}   AS revenue,
       CAST(SUM(quantity) AS BIGINT)     AS units,
       COUNT(DISTINCT customer_id)       AS customers
FROM transactions
GROUP BY subcategory
ORDER BY revenue DESC
"""


@register("L02_subcategory_contribution", with_sales(L2_SQL.replace("transactions", "sales")))
def subcategory_contribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: subcategory revenue, units, customers."""
    register_views(spark, sf_dir, transactions=["subcategory", "final_amount_inr", "quantity", "customer_id"])
    return run_sql(spark, L2_SQL)


L3_SQL = f"""
SELECT customer_state, customer_tier,
       {sql_msum("final_amount_inr")}   AS revenue,
       COUNT(*)                          AS orders
FROM transactions
GROUP BY customer_state, customer_tier
ORDER BY revenue DESC
"""


@register("L03_geographic_revenue", with_sales(L3_SQL.replace("transactions", "sales")))
def geographic_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: state x tier revenue and orders."""
    register_views(spark, sf_dir, transactions=["customer_state", "customer_tier", "final_amount_inr"])
    return run_sql(spark, L3_SQL)


L4_SQL = f"""
SELECT is_prime_member,
       COUNT(*)                          AS orders,
       {sql_msum("final_amount_inr")}   AS revenue,
       {sql_mavg("final_amount_inr")}   AS aov,
       AVG(delivery_days)      AS avg_delivery_days
FROM transactions
GROUP BY is_prime_member
"""


@register("L04_prime_vs_nonprime", with_sales(L4_SQL.replace("transactions", "sales")))
def prime_vs_nonprime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: prime vs non-prime orders, revenue, AOV, delivery days."""
    register_views(spark, sf_dir, transactions=["is_prime_member", "final_amount_inr", "delivery_days"])
    return run_sql(spark, L4_SQL)


L6_SQL = f"""
SELECT t.order_year, t.brand,
       {sql_msum("t.final_amount_inr")} AS revenue,
       CAST(SUM(t.quantity) AS BIGINT)   AS units
FROM transactions t
JOIN products p ON t.product_id = p.product_id
GROUP BY t.order_year, t.brand
ORDER BY t.order_year, revenue DESC
"""


@register("L06_brand_by_year", with_sales(L6_SQL.replace("transactions", "sales"), CATALOG_CTE))
def brand_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand x year revenue and units through the products join."""
    register_views(
        spark, sf_dir,
        transactions=["order_year", "brand", "final_amount_inr", "quantity", "product_id"],
        products=True,
    )
    return run_sql(spark, L6_SQL)
