"""DuckDB oracle text for every registered query.

The oracle is an independent statement of each answer in plain SQL over
the raw tables (``lineitem``, ``orders`` ...), starting from the same
``sales`` mapping written here as a CTE.  The driver runs it next to the
Spark plan at sf0.01 and compares row counts, schemas and value hashes.

Conventions shared with the Spark side so hashes compare: money rounded to
2 decimals, ratios to 6; integer sums cast to BIGINT; years as INTEGER.
"""

from __future__ import annotations

from ledgerloom import config

SALES_CTE = """
sales AS (
  SELECT
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CAST(l_quantity AS INTEGER),
              CAST(round(l_extendedprice * 100) AS BIGINT))        AS transaction_id,
    CAST(o_orderdate AS DATE)                                      AS order_date,
    CAST(year(o_orderdate) AS INTEGER)                             AS order_year,
    CAST(month(o_orderdate) AS INTEGER)                            AS order_month,
    CAST(quarter(o_orderdate) AS INTEGER)                          AS order_quarter,
    CAST(day(o_orderdate) AS INTEGER)                              AS order_day,
    o_custkey                                                      AS customer_id,
    l_partkey                                                      AS product_id,
    p_name                                                         AS product_name,
    'Electronics'                                                  AS category,
    p_type                                                         AS subcategory,
    p_brand                                                        AS brand,
    CAST(l_quantity AS INTEGER)                                    AS quantity,
    CAST(round(abs(l_discount) * 100) AS DOUBLE)                   AS discount_percent,
    ((2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
       // (2 * CAST(l_quantity AS BIGINT))) / 100                  AS original_price_inr,
    ((2 * CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(abs(l_discount) * 100) AS BIGINT))
       + 100 * CAST(l_quantity AS BIGINT)) // (200 * CAST(l_quantity AS BIGINT))) / 100
                                                                   AS discounted_price_inr,
    ((CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(abs(l_discount) * 100) AS BIGINT))
       + 50) // 100) / 100                                         AS subtotal_inr,
    ((CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_tax * 100) AS BIGINT) + 50) // 100) / 100
                                                                   AS delivery_charges,
    ((CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(abs(l_discount) * 100) AS BIGINT))
       + 50) // 100) / 100                                         AS final_amount_inr,
    n_name                                                         AS customer_city,
    r_name                                                         AS customer_state,
    CASE c_nationkey % 4 WHEN 0 THEN 'Metro' WHEN 1 THEN 'Tier1'
         WHEN 2 THEN 'Tier2' ELSE 'Rural' END                      AS customer_tier,
    c_mktsegment                                                   AS customer_spending_tier,
    CASE WHEN c_acctbal < 0 THEN 'Unknown'
         WHEN c_acctbal >= 8000 THEN '55+'
         WHEN c_acctbal >= 6000 THEN '46-55'
         WHEN c_acctbal >= 4000 THEN '36-45'
         WHEN c_acctbal >= 2000 THEN '26-35'
         ELSE '18-25' END                                          AS customer_age_group,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'UPI'
         WHEN '2-HIGH' THEN 'Credit Card' WHEN '3-MEDIUM' THEN 'Debit Card'
         WHEN '4-NOT SPECIFIED' THEN 'COD' WHEN '5-LOW' THEN 'Wallet' END
                                                                   AS payment_method,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Digital Payments'
         WHEN '2-HIGH' THEN 'Card Payments' WHEN '3-MEDIUM' THEN 'Card Payments'
         WHEN '4-NOT SPECIFIED' THEN 'Cash on Delivery'
         WHEN '5-LOW' THEN 'Digital Payments' ELSE 'Other' END     AS payment_method_group,
    CAST(1 + (l_orderkey + l_partkey) % 7 AS INTEGER)              AS delivery_days,
    CASE l_linenumber % 3 WHEN 0 THEN 'Same Day' WHEN 1 THEN 'Express'
         ELSE 'Standard' END                                       AS delivery_type,
    (o_orderkey % 3 = 0)                                           AS is_prime_member,
    (month(o_orderdate) IN (10, 11))                               AS is_festival_sale,
    CASE month(o_orderdate) WHEN 10 THEN 'Diwali Sale'
         WHEN 11 THEN 'Amazon Great Indian Festival' END           AS festival_name,
    CASE WHEN l_orderkey % 10 >= 3
         THEN CAST(3 AS DOUBLE) + CAST(0.5 AS DOUBLE) * (l_partkey % 5) END
                                                                   AS customer_rating,
    CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Cancelled'
         WHEN 'N' THEN 'Delivered' END                             AS return_status,
    CAST(p_size AS DOUBLE) / 10                                    AS product_weight_kg,
    (p_size % 2 = 0)                                               AS is_prime_eligible,
    CAST(3 AS DOUBLE) + CAST(p_size % 21 AS DOUBLE) / 10           AS product_rating
  FROM lineitem
  JOIN orders   ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation   ON c_nationkey = n_nationkey
  JOIN region   ON n_regionkey = r_regionkey
  JOIN part     ON l_partkey = p_partkey
)"""

CATALOG_CTE = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, 'Electronics' AS category,
         p_type AS subcategory, p_brand AS brand, p_retailprice AS base_price_2015,
         CAST(p_size AS DOUBLE) / 10 AS weight_kg,
         CAST(3 AS DOUBLE) + CAST(p_size % 21 AS DOUBLE) / 10 AS rating,
         (p_size % 2 = 0) AS is_prime_eligible,
         CAST(1994 + p_partkey % 8 AS INTEGER) AS launch_year,
         'M-' || CAST(p_partkey AS VARCHAR) AS model
  FROM part
)"""


def sql_msum(c: str) -> str:
    """Exact money sum: integer paise, then INR."""
    return f"(SUM(CAST(round({c} * 100) AS BIGINT)) / 100)"


def sql_msum_over(c: str, over: str = "") -> str:
    """Exact money window sum ``OVER (<over>)``."""
    return f"(SUM(CAST(round({c} * 100) AS BIGINT)) OVER ({over}) / 100)"


def sql_mavg(c: str) -> str:
    """Money mean over non-null values from the exact paise sum."""
    return f"(SUM(CAST(round({c} * 100) AS BIGINT)) / COUNT({c}) / 100)"


def with_sales(body: str, *extra_ctes: str) -> str:
    """``WITH sales AS (...), <extra> <body>``."""
    ctes = [SALES_CTE.strip()] + [c.strip() for c in extra_ctes]
    body = body.strip().lstrip(",").strip()
    sep = "\n" if body[:6].upper() == "SELECT" else ",\n"
    return "WITH " + ",\n".join(ctes) + sep + body


SQL_DISC_BAND = ("CASE WHEN discount_percent > -0.01 AND discount_percent <= 0 THEN '0%' "
                 "WHEN discount_percent > 0 AND discount_percent <= 10 THEN '0-10' "
                 "WHEN discount_percent > 10 AND discount_percent <= 20 THEN '10-20' "
                 "WHEN discount_percent > 20 AND discount_percent <= 30 THEN '20-30' "
                 "WHEN discount_percent > 30 AND discount_percent <= 50 THEN '30-50' "
                 "WHEN discount_percent > 50 THEN '50+' END")

_ACTION_CASE = "CASE rfm_segment " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in config.RFM_SEGMENT_MAP.items()) + " END"

CUSTOMERS_CTE = f"""
cust_agg AS (
  SELECT customer_id,
    arg_max(customer_city, (order_date, transaction_id))          AS customer_city,
    arg_max(customer_state, (order_date, transaction_id))         AS customer_state,
    arg_max(customer_tier, (order_date, transaction_id))          AS customer_tier,
    arg_max(customer_spending_tier, (order_date, transaction_id)) AS customer_spending_tier,
    arg_max(customer_age_group, (order_date, transaction_id))     AS customer_age_group,
    bool_or(is_prime_member)                                      AS is_prime_member,
    min(order_date)                                               AS first_order_date,
    max(order_date)                                               AS last_order_date,
    count(DISTINCT transaction_id)                                AS frequency,
    (SUM(CAST(round(final_amount_inr * 100) AS BIGINT)) / 100)    AS monetary,
    CAST(sum(quantity) AS BIGINT)                                 AS units,
    (SUM(CAST(round(final_amount_inr * 100) AS BIGINT)) / COUNT(final_amount_inr) / 100) AS aov_raw,
    avg(customer_rating)                                          AS rating_raw,
    avg(CASE WHEN return_status = 'Returned' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)
                                                                  AS return_raw
  FROM sales GROUP BY customer_id
),
cust_base AS (
  SELECT *,
    CAST((SELECT max(last_order_date) FROM cust_agg) + 1 - last_order_date AS INTEGER) AS recency_days,
    CAST(greatest(last_order_date - first_order_date, 0) AS INTEGER)                     AS tenure_days,
    CAST(year(first_order_date) AS INTEGER)                                              AS acquisition_year,
    row_number() OVER (ORDER BY frequency, customer_id)                                  AS f_rank,
    row_number() OVER (ORDER BY monetary, customer_id)                                   AS m_rank,
    count(*) OVER ()                                                                     AS n_cust
  FROM cust_agg
),
rec_edges AS (
  SELECT quantile_cont(recency_days, [0.2, 0.4, 0.6, 0.8]) AS e FROM cust_base
),
cust_scored AS (
  SELECT b.*,
    CAST(5 - ((recency_days > e[1])::INT + (recency_days > e[2])::INT
            + (recency_days > e[3])::INT + (recency_days > e[4])::INT) AS INTEGER) AS r_score,
    CAST(CASE WHEN n_cust > 1 THEN greatest(1, (5 * (f_rank - 1) + n_cust - 2) // (n_cust - 1))
         ELSE 3 END AS INTEGER) AS f_score,
    CAST(CASE WHEN n_cust > 1 THEN greatest(1, (5 * (m_rank - 1) + n_cust - 2) // (n_cust - 1))
         ELSE 3 END AS INTEGER) AS m_score
  FROM cust_base b, rec_edges
),
cust_seg AS (
  SELECT *,
    CASE
      WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
      WHEN r_score >= 4 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
      WHEN r_score >= 4 AND f_score <= 2 AND m_score >= 3 THEN 'Potential Loyalists'
      WHEN r_score >= 4 AND f_score = 1 THEN 'New Customers'
      WHEN r_score >= 4 AND f_score = 2 THEN 'Promising'
      WHEN r_score = 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
      WHEN r_score = 3 AND f_score >= 3 THEN 'Need Attention'
      WHEN r_score = 3 AND m_score >= 4 THEN 'Need Attention'
      WHEN r_score = 3 THEN 'About to Sleep'
      WHEN r_score <= 2 AND f_score >= 4 AND m_score >= 4 THEN 'Cannot Lose Them'
      WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
      WHEN r_score <= 2 AND m_score >= 4 THEN 'At Risk'
      WHEN r_score = 2 THEN 'Hibernating'
      ELSE 'Lost' END AS rfm_segment
  FROM cust_scored
),
customers AS (
  SELECT customer_id, customer_city, customer_state, customer_tier, customer_spending_tier,
    customer_age_group, is_prime_member, first_order_date, last_order_date, frequency, monetary, units,
    aov_raw AS avg_order_value, rating_raw AS avg_rating,
    return_raw AS return_rate, recency_days, tenure_days, acquisition_year,
    r_score, f_score, m_score, rfm_segment, {_ACTION_CASE} AS rfm_action,
    round(greatest((aov_raw * (frequency / greatest(tenure_days / CAST(365.25 AS DOUBLE),
                                               CAST(1 AS DOUBLE) / 12))) * 3, monetary), 2) AS clv
  FROM cust_seg
)"""
