"""The twenty EDA questions (L7-L26) as named DataFrame queries.

Each question of the original produces a chart and a few metrics; here
each produces the frame(s) behind them, one registered query per frame.
All start from column-pruned ``sales`` (so e.g. revenue by year never
joins ``part``), aggregate with two-phase ``groupBy`` first, and only
then apply series / share / rank operators to the reduced frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom import config
from ledgerloom.functions.exprs import band, flag, lookup, mavg, msum, paise, ratio
from ledgerloom.operators.journey import cohort_retention, event_windows, top_k, transitions
from ledgerloom.operators.ranking import exact_quantiles, five_number, quantile_band
from ledgerloom.operators.series import period_change, polyfit2
from ledgerloom.operators.shares import crosstab_pct, share_of
from ledgerloom.plans.dims import build_customers
from ledgerloom.plans.oracle_sql import CATALOG_CTE, CUSTOMERS_CTE, sql_mavg, sql_msum, sql_msum_over, with_sales
from ledgerloom.plans.oracle_sql import SQL_DISC_BAND as _SQL_DISC_BAND
from ledgerloom.plans.registry import register
from ledgerloom.session import stored
from ledgerloom.sources.tables import catalog, sales

AMT = "final_amount_inr"
MS = sql_msum(AMT)
MA = sql_mavg(AMT)
FLAG_RET = "CASE WHEN return_status = 'Returned' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
FLAG_CAN = "CASE WHEN return_status = 'Cancelled' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


def _sql_polyfit(frame: str, x: str, y: str, name: str) -> str:
    """SQL of the degree-2 least-squares fitted value (oracle of polyfit2)."""
    def det(a, b, c, d, e, f, g, h, i):
        return f"(({a})*(({e})*({i})-({f})*({h}))-({b})*(({d})*({i})-({f})*({g}))+({c})*(({d})*({h})-({e})*({g})))"
    D = det("s4", "s3", "s2", "s3", "s2", "s1", "s2", "s1", "s0")
    A = det("t2", "s3", "s2", "t1", "s2", "s1", "t0", "s1", "s0")
    B = det("s4", "t2", "s2", "s3", "t1", "s1", "s2", "t0", "s0")
    C = det("s4", "s3", "t2", "s3", "s2", "t1", "s2", "s1", "t0")
    return f"""
_pc AS (SELECT *, {x} - avg(CAST({x} AS DOUBLE)) OVER () AS _u FROM {frame}),
_ps AS (SELECT CAST(count(*) AS DOUBLE) s0, sum(_u) s1, sum(_u*_u) s2, sum(_u*_u*_u) s3,
               sum(_u*_u*_u*_u) s4, sum({y}) t0, sum(_u*{y}) t1, sum(_u*_u*{y}) t2 FROM _pc),
_pk AS (SELECT {A}/{D} AS _A, {B}/{D} AS _B, {C}/{D} AS _C FROM _ps),
_pf AS (SELECT _pc.*, _A*_u*_u + _B*_u + _C AS {name} FROM _pc, _pk)"""


def tx(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return sales(spark, d, list(cols))


# ------------------------------------------------------------------ L7 q1
@register("L07_revenue_trend", with_sales(f"""
, y AS (SELECT order_year, {MS} AS revenue, count(*) AS orders FROM sales GROUP BY order_year),
g AS (SELECT *, (revenue / NULLIF(lag(revenue) OVER (ORDER BY order_year), 0) - 1) * 100 AS growth_pct,
             revenue / CAST(1e7 AS DOUBLE) AS _cr FROM y),
{_sql_polyfit("g", "order_year", "_cr", "_trend")}
SELECT order_year, revenue, orders, growth_pct, round(_trend, 6) AS trend_cr FROM _pf
"""))
def l07_revenue_trend(spark: SparkSession, d: str) -> DataFrame:
    """q1: yearly revenue, orders, growth %, quadratic trend (Cr)."""
    y = tx(spark, d, "order_year", AMT).groupBy("order_year").agg(
        msum(AMT).alias("revenue"), F.count("*").alias("orders"))
    y = period_change(y, "revenue", "order_year", "growth_pct", 100.0)
    y = polyfit2(y.withColumn("_cr", F.col("revenue") / 1e7), "order_year", "_cr", "_trend")
    return y.select("order_year", "revenue", "orders", "growth_pct", F.round("_trend", 6).alias("trend_cr"))


@register("L07_revenue_trend_summary", with_sales(f"""
y AS (SELECT order_year, {MS} AS revenue FROM sales GROUP BY order_year),
g AS (SELECT *, (revenue / NULLIF(lag(revenue) OVER (ORDER BY order_year), 0) - 1) * 100 AS growth_pct FROM y)
SELECT {sql_msum("revenue")} AS total_revenue,
       round(pow(arg_max(revenue, order_year) / arg_min(revenue, order_year),
                 CAST(1 AS DOUBLE) / (count(*) - 1)) - 1, 9) AS cagr,
       arg_max(order_year, growth_pct) AS peak_growth_year,
       max(growth_pct) AS peak_growth_pct
FROM g
"""))
def l07_summary(spark: SparkSession, d: str) -> DataFrame:
    """q1 metrics: total revenue, CAGR, fastest-growth year."""
    y = tx(spark, d, "order_year", AMT).groupBy("order_year").agg(msum(AMT).alias("revenue"))
    y = period_change(y, "revenue", "order_year", "growth_pct", 100.0)
    return y.agg(
        msum("revenue").alias("total_revenue"),
        F.round(F.pow(F.max_by("revenue", "order_year") / F.min_by("revenue", "order_year"),
                      1.0 / (F.count("*") - 1)) - 1, 9).alias("cagr"),
        F.max_by("order_year", "growth_pct").alias("peak_growth_year"),
        F.max("growth_pct").alias("peak_growth_pct"),
    )


# ------------------------------------------------------------------ L8 q2
@register("L08_seasonality_year_month", with_sales(f"""
SELECT order_year, order_month, {MS} AS revenue FROM sales GROUP BY order_year, order_month"""))
def l08_year_month(spark: SparkSession, d: str) -> DataFrame:
    """q2: year x month revenue (long form of the heatmap)."""
    return tx(spark, d, "order_year", "order_month", AMT).groupBy("order_year", "order_month").agg(
        msum(AMT).alias("revenue"))


@register("L08_seasonality_monthly", with_sales(f"""
m AS (SELECT order_month, {MS} AS revenue FROM sales GROUP BY order_month)
SELECT order_month, revenue, revenue / {sql_msum_over("revenue")} AS share,
       revenue = max(revenue) OVER () AS is_peak FROM m"""))
def l08_monthly(spark: SparkSession, d: str) -> DataFrame:
    """q2: revenue by calendar month, share of year, peak flag."""
    m = tx(spark, d, "order_month", AMT).groupBy("order_month").agg(msum(AMT).alias("revenue"))
    m = share_of(m, "revenue", name="share", money=True)
    peak = m.agg(F.max("revenue").alias("_peak"))
    return m.crossJoin(F.broadcast(peak)).select(
        "order_month", "revenue", "share", (F.col("revenue") == F.col("_peak")).alias("is_peak"))


@register("L08_seasonality_subcategory_month", with_sales(f"""
SELECT subcategory, order_month, {MS} AS revenue FROM sales GROUP BY subcategory, order_month"""))
def l08_sub_month(spark: SparkSession, d: str) -> DataFrame:
    """q2: subcategory x month revenue."""
    return tx(spark, d, "subcategory", "order_month", AMT).groupBy("subcategory", "order_month").agg(
        msum(AMT).alias("revenue"))


# ------------------------------------------------------------------ L9 q3
@register("L09_rfm_segments", with_sales(f"""
SELECT rfm_segment, count(*) AS customers, {sql_msum("monetary")} AS revenue
FROM customers GROUP BY rfm_segment""", CUSTOMERS_CTE))
def l09_segments(spark: SparkSession, d: str) -> DataFrame:
    """q3: customers and revenue per RFM segment."""
    return build_customers(spark, d, ["rfm_segment", "monetary"]).groupBy("rfm_segment").agg(
        F.count("*").alias("customers"), msum("monetary").alias("revenue"))


@register("L09_rfm_sample", with_sales("""
SELECT customer_id, recency_days, frequency, monetary, round(ln(1 + monetary), 6) AS log_monetary, rfm_segment
FROM customers ORDER BY md5('42-' || CAST(customer_id AS VARCHAR)), customer_id LIMIT 100""", CUSTOMERS_CTE))
def l09_sample(spark: SparkSession, d: str, n: int = 100, seed: int = 42) -> DataFrame:
    """q3 scatter sample (G5): at most ``n`` customers, deterministic.

    A seeded hash order + limit is a distributed top-n (each partition
    keeps n), so the sample is the same on any cluster and never needs
    the full customer set in one place.  The limit *is* the feature here.
    """
    c = build_customers(spark, d, ["recency_days", "frequency", "monetary", "rfm_segment"])
    return c.orderBy(F.md5(F.concat(F.lit(f"{seed}-"), F.col("customer_id").cast("string")).cast("binary")), "customer_id").limit(n).select(
        "customer_id", "recency_days", "frequency", "monetary", F.round(F.log1p("monetary"), 6).alias("log_monetary"),
        "rfm_segment")


# ------------------------------------------------------------------ L10 q4
@register("L10_payment_share_by_year", with_sales("""
c AS (SELECT order_year, payment_method, count(*) AS n FROM sales GROUP BY ALL),
grid AS (SELECT y.order_year, m.payment_method FROM (SELECT DISTINCT order_year FROM sales) y,
         (SELECT DISTINCT payment_method FROM sales) m)
SELECT g.order_year, g.payment_method, CAST(coalesce(c.n, 0) AS BIGINT) AS orders,
       coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER (PARTITION BY g.order_year) * 100 AS share_pct
FROM grid g LEFT JOIN c USING (order_year, payment_method)"""))
def l10_payment(spark: SparkSession, d: str) -> DataFrame:
    """q4: payment method share of orders per year, zero-filled grid."""
    t = tx(spark, d, "order_year", "payment_method")
    c = t.groupBy("order_year", "payment_method").agg(F.count("*").alias("n"))
    grid = F.broadcast(t.select("order_year").distinct()).crossJoin(
        F.broadcast(t.select("payment_method").distinct()))  # a calendar and a vocabulary
    g = grid.join(c, ["order_year", "payment_method"], "left").withColumn(
        "orders", F.coalesce("n", F.lit(0)).cast("long"))
    return share_of(g, "orders", ["order_year"], "share_pct", 100.0).select(
        "order_year", "payment_method", "orders", "share_pct")


# ------------------------------------------------------------------ L11 q5
@register("L11_category_performance", with_sales(f"""
cat AS (SELECT subcategory, {MS} AS revenue, CAST(sum(quantity) AS BIGINT) AS units, count(*) AS orders
        FROM sales GROUP BY subcategory),
sy AS (SELECT subcategory, order_year, {MS} AS rev FROM sales GROUP BY ALL),
yr AS (SELECT min(order_year) AS y0, max(order_year) AS y1, count(DISTINCT order_year) AS n FROM sales),
cg AS (SELECT s.subcategory,
              round((pow(max(CASE WHEN order_year = y1 THEN rev END) / max(CASE WHEN order_year = y0 THEN rev END),
                         CAST(1 AS DOUBLE) / (max(n) - 1)) - 1) * 100, 6) AS cagr_pct
       FROM sy s, yr GROUP BY s.subcategory)
SELECT cat.*, revenue / {sql_msum_over("revenue")} AS share, cg.cagr_pct
FROM cat JOIN cg USING (subcategory)"""))
def l11_category(spark: SparkSession, d: str) -> DataFrame:
    """q5: subcategory revenue, units, orders, share, CAGR % (first to last year).
    The fact is read once: its sums by (subcategory, year), stored, give all of them."""
    t = stored(tx(spark, d, "subcategory", "order_year", "quantity", AMT).groupBy("subcategory", "order_year").agg(
        F.sum(paise(AMT)).alias("paise"), F.sum("quantity").alias("units"), F.count("*").alias("orders")), "category-years")
    cat = t.groupBy("subcategory").agg((F.sum("paise") / 100.0).alias("revenue"), F.sum("units").alias("units"),
                                       F.sum("orders").alias("orders"))
    cat = share_of(cat, "revenue", name="share", money=True)
    yr = t.agg(F.min("order_year").alias("y0"), F.max("order_year").alias("y1"),
               F.countDistinct("order_year").alias("n"))
    sy = t.select("subcategory", "order_year", (F.col("paise") / 100.0).alias("rev")).crossJoin(F.broadcast(yr))
    cg = sy.groupBy("subcategory").agg(
        F.max(F.when(F.col("order_year") == F.col("y1"), F.col("rev"))).alias("_l"),
        F.max(F.when(F.col("order_year") == F.col("y0"), F.col("rev"))).alias("_f"),
        F.max("n").alias("_n"),
    ).select("subcategory", F.round((F.pow(F.col("_l") / F.col("_f"), 1.0 / (F.col("_n") - 1)) - 1) * 100, 6)
             .alias("cagr_pct"))
    return cat.join(cg, "subcategory")


# ------------------------------------------------------------------ L12 q6
@register("L12_prime_impact", with_sales(f"""
pc AS (SELECT customer_id, is_prime_member, count(*) AS orders, {MA} AS aov FROM sales GROUP BY ALL),
pcs AS (SELECT is_prime_member, round(avg(aov), 6) AS aov_per_customer, avg(orders) AS orders_per_customer
        FROM pc GROUP BY ALL),
g AS (SELECT is_prime_member, count(*) AS orders, count(DISTINCT customer_id) AS customers,
             {MS} AS revenue, {MA} AS aov FROM sales GROUP BY ALL)
SELECT g.*, revenue / {sql_msum_over("revenue")} AS revenue_share, pcs.aov_per_customer,
       pcs.orders_per_customer
FROM g JOIN pcs USING (is_prime_member)"""))
def l12_prime(spark: SparkSession, d: str) -> DataFrame:
    """q6: prime vs non-prime orders, customers, revenue, AOV, revenue share,
    and the per-customer mean AOV and orders.  The fact is read once: its sums
    by (customer, flag), stored, give all of them."""
    pc = stored(tx(spark, d, "customer_id", "is_prime_member", AMT).groupBy("customer_id", "is_prime_member").agg(
        F.count("*").alias("orders"), F.sum(paise(AMT)).alias("paise"), F.count(AMT).alias("amounts")), "prime-customers")
    aov = F.try_divide(F.col("paise"), F.col("amounts")) / 100.0
    pcs = pc.groupBy("is_prime_member").agg(ratio(F.avg(aov)).alias("aov_per_customer"),
                                            F.avg("orders").alias("orders_per_customer"))
    g = pc.groupBy("is_prime_member").agg(
        F.sum("orders").alias("orders"), F.count("customer_id").alias("customers"),
        (F.sum("paise") / 100.0).alias("revenue"), (F.try_divide(F.sum("paise"), F.sum("amounts")) / 100.0).alias("aov"))
    g = share_of(g, "revenue", name="revenue_share", money=True)
    return g.join(pcs, "is_prime_member")


@register("L12_prime_mix", with_sales("""
c AS (SELECT is_prime_member, subcategory, count(*) AS n FROM sales GROUP BY ALL)
SELECT is_prime_member, subcategory, n, n / sum(n) OVER (PARTITION BY is_prime_member) * 100 AS pct FROM c"""))
def l12_mix(spark: SparkSession, d: str) -> DataFrame:
    """q6: subcategory mix % within prime / non-prime (row-normalised cross-tab)."""
    return crosstab_pct(tx(spark, d, "is_prime_member", "subcategory"), "is_prime_member", "subcategory")


# ------------------------------------------------------------------ L13 q7
_LAT = "CASE customer_city " + " ".join(f"WHEN '{c}' THEN {v[0]}" for c, v in config.CITY_COORDS.items()) + " END"
_LON = "CASE customer_city " + " ".join(f"WHEN '{c}' THEN {v[1]}" for c, v in config.CITY_COORDS.items()) + " END"
_LAT_MAP = {c: v[0] for c, v in config.CITY_COORDS.items()}
_LON_MAP = {c: v[1] for c, v in config.CITY_COORDS.items()}


def _city_frame(spark, d):
    return tx(spark, d, "customer_city", "customer_tier", "customer_state", AMT).groupBy(
        "customer_city", "customer_tier", "customer_state").agg(
        msum(AMT).alias("revenue"), F.count("*").alias("orders")).select(
        "*", lookup(_LAT_MAP, "customer_city").alias("lat"), lookup(_LON_MAP, "customer_city").alias("lon"))


@register("L13_geo_city", with_sales(f"""
SELECT customer_city, customer_tier, customer_state, {MS} AS revenue, count(*) AS orders,
       CAST({_LAT} AS DOUBLE) AS lat, CAST({_LON} AS DOUBLE) AS lon
FROM sales GROUP BY ALL"""))
def l13_city(spark: SparkSession, d: str) -> DataFrame:
    """q7: revenue per city (with tier, state) and coordinates."""
    return _city_frame(spark, d)


@register("L13_geo_top_cities", with_sales(f"""
SELECT customer_city, customer_tier, {MS} AS revenue FROM sales GROUP BY customer_city, customer_tier, customer_state
ORDER BY revenue DESC, customer_city LIMIT 10"""))
def l13_top_cities(spark: SparkSession, d: str) -> DataFrame:
    """q7: top 10 cities by revenue."""
    return top_k(_city_frame(spark, d), 10, "revenue", ["customer_city"]).select(
        "customer_city", "customer_tier", "revenue")


@register("L13_geo_tier", with_sales(f"""
t AS (SELECT customer_tier, {MS} AS revenue FROM sales GROUP BY customer_tier)
SELECT o.customer_tier, o.tier_ord, t.revenue
FROM (VALUES ('Metro', 1), ('Tier1', 2), ('Tier2', 3), ('Rural', 4)) o(customer_tier, tier_ord)
LEFT JOIN t USING (customer_tier)"""))
def l13_tier(spark: SparkSession, d: str) -> DataFrame:
    """q7: revenue by tier in the fixed tier order, absent tiers kept null."""
    t = tx(spark, d, "customer_tier", AMT).groupBy("customer_tier").agg(msum(AMT).alias("revenue"))
    order = spark.createDataFrame([(n, i + 1) for i, n in enumerate(config.TIER_ORDER)],
                                  "customer_tier string, tier_ord int")
    return order.join(t, "customer_tier", "left").select("customer_tier", "tier_ord", "revenue")


@register("L13_geo_top_states", with_sales(f"""
SELECT customer_state, {MS} AS revenue FROM sales GROUP BY customer_state
ORDER BY revenue DESC, customer_state LIMIT 8"""))
def l13_states(spark: SparkSession, d: str) -> DataFrame:
    """q7: top 8 states by revenue."""
    s = tx(spark, d, "customer_state", AMT).groupBy("customer_state").agg(msum(AMT).alias("revenue"))
    return top_k(s, 8, "revenue", ["customer_state"])


# ------------------------------------------------------------------ L14 q8
@register("L14_festival_revenue", with_sales(f"""
SELECT festival_name, {MS} AS revenue FROM sales WHERE festival_name IS NOT NULL GROUP BY festival_name"""))
def l14_festival_revenue(spark: SparkSession, d: str) -> DataFrame:
    """q8: revenue per festival (null festival dropped)."""
    return tx(spark, d, "festival_name", AMT).where(F.col("festival_name").isNotNull()).groupBy(
        "festival_name").agg(msum(AMT).alias("revenue"))


@register("L14_festival_monthly", with_sales(f"""
m AS (SELECT date_trunc('month', order_date) AS month_start, {MS} AS revenue,
             avg(CASE WHEN is_festival_sale THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS festival_share
      FROM sales GROUP BY 1)
SELECT CAST(month_start AS DATE) AS month_start, revenue, festival_share, festival_share > 0.4 AS is_spike FROM m"""))
def l14_monthly(spark: SparkSession, d: str) -> DataFrame:
    """q8: monthly revenue with festival order share and spike months (> 0.4)."""
    m = tx(spark, d, "order_date", "is_festival_sale", AMT).groupBy(
        F.trunc("order_date", "month").alias("month_start")).agg(
        msum(AMT).alias("revenue"), F.avg(flag("is_festival_sale")).alias("festival_share"))
    return m.withColumn("is_spike", F.col("festival_share") > 0.4)


@register("L14_festival_summary", with_sales("""
SELECT avg(CASE WHEN is_festival_sale THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS festival_order_share
FROM sales"""))
def l14_summary(spark: SparkSession, d: str) -> DataFrame:
    """q8: share of orders in festival sales."""
    return tx(spark, d, "is_festival_sale").agg(F.avg(flag("is_festival_sale")).alias("festival_order_share"))


@register("L14_diwali_windows", with_sales(f"""
daily AS (SELECT order_date, {MS} AS rev FROM sales GROUP BY order_date),
ev AS (SELECT CAST(year(order_date) AS INTEGER) AS year, min(order_date) AS s, max(order_date) AS e, {MS} AS during
       FROM sales WHERE festival_name = 'Diwali Sale' GROUP BY 1)
SELECT year,
  coalesce((SELECT sum(CAST(round(rev * 100) AS BIGINT)) FROM daily
            WHERE order_date >= s - 14 AND order_date < s), 0) / 100 / 14 AS before_daily,
  during / greatest(e - s + 1, 1) AS during_daily,
  coalesce((SELECT sum(CAST(round(rev * 100) AS BIGINT)) FROM daily
            WHERE order_date > e AND order_date <= e + 14), 0) / 100 / 14 AS after_daily
FROM ev"""))
def l14_diwali(spark: SparkSession, d: str) -> DataFrame:
    """q8: daily revenue 14 days before / during / 14 days after each year's
    Diwali sale (D9 range join on the daily series)."""
    t = tx(spark, d, "order_date", "festival_name", AMT)
    return event_windows(t, "order_date", AMT, F.col("festival_name") == "Diwali Sale")


# ------------------------------------------------------------------ L15 q9
@register("L15_age_spend", with_sales(f"""
a AS (SELECT customer_age_group, {MS} AS revenue, {MA} AS aov, count(*) AS orders FROM sales GROUP BY 1),
pc AS (SELECT customer_id, customer_age_group, count(*) AS n FROM sales GROUP BY ALL),
f AS (SELECT customer_age_group, avg(n) AS orders_per_customer FROM pc GROUP BY 1)
SELECT o.customer_age_group, o.age_ord, a.revenue, a.aov, a.orders, f.orders_per_customer
FROM (VALUES ('18-25', 1), ('26-35', 2), ('36-45', 3), ('46-55', 4), ('55+', 5), ('Unknown', 6))
     o(customer_age_group, age_ord)
LEFT JOIN a USING (customer_age_group) LEFT JOIN f USING (customer_age_group)"""))
def l15_age(spark: SparkSession, d: str) -> DataFrame:
    """q9: revenue, AOV, orders and orders per customer by age band, fixed order."""
    t = tx(spark, d, "customer_id", "customer_age_group", AMT)
    a = t.groupBy("customer_age_group").agg(msum(AMT).alias("revenue"), mavg(AMT).alias("aov"),
                                            F.count("*").alias("orders"))
    f = t.groupBy("customer_id", "customer_age_group").agg(F.count("*").alias("n")).groupBy(
        "customer_age_group").agg(F.avg("n").alias("orders_per_customer"))
    order = spark.createDataFrame([(n, i + 1) for i, n in enumerate(config.AGE_ORDER)],
                                  "customer_age_group string, age_ord int")
    return order.join(a, "customer_age_group", "left").join(f, "customer_age_group", "left").select(
        "customer_age_group", "age_ord", "revenue", "aov", "orders", "orders_per_customer")


@register("L15_age_mix", with_sales("""
c AS (SELECT customer_age_group, subcategory, count(*) AS n FROM sales GROUP BY ALL)
SELECT customer_age_group, subcategory, n, n / sum(n) OVER (PARTITION BY customer_age_group) * 100 AS pct FROM c"""))
def l15_mix(spark: SparkSession, d: str) -> DataFrame:
    """q9: subcategory mix % per age band."""
    return crosstab_pct(tx(spark, d, "customer_age_group", "subcategory"), "customer_age_group", "subcategory")


# ------------------------------------------------------------------ L16 q10
def _product_price_demand(spark, d):
    """One scan of the fact: its sums by (product, price), stored, give both
    the products' totals and the weights of their median price."""
    keys = ["product_id", "subcategory"]
    t = tx(spark, d, *keys, "discounted_price_inr", "quantity", "discount_percent", AMT)
    prices = stored(t.groupBy(*keys, "discounted_price_inr").agg(
        F.sum("quantity").alias("units"), F.sum(paise(AMT)).alias("paise"), F.sum("discount_percent").alias("discount"),
        F.count("discount_percent").alias("discounts"), F.count("*").alias("rows")), "product-prices")
    agg = prices.groupBy(*keys).agg(F.sum("units").alias("units"), (F.sum("paise") / 100.0).alias("revenue"),
                                    F.try_divide(F.sum("discount"), F.sum("discounts")).alias("discount"))
    med = exact_quantiles(prices, "discounted_price_inr", [0.5], by=keys, name="_p", weight="rows")
    return agg.join(med, keys).withColumnRenamed("_p0", "price")


@register("L16_product_price_demand", with_sales(f"""
SELECT product_id, subcategory, CAST(sum(quantity) AS BIGINT) AS units, {MS} AS revenue,
       avg(discount_percent) AS discount, quantile_cont(discounted_price_inr, 0.5) AS price
FROM sales GROUP BY ALL"""))
def l16_products(spark: SparkSession, d: str) -> DataFrame:
    """q10: per product median price, units, revenue, mean discount."""
    return _product_price_demand(spark, d)


def _corr_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation matrix in long form (J1); null for a constant column
    instead of the ANSI divide-by-zero error."""
    exprs = []
    for a in cols:
        for b in cols:
            c = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
            exprs.append(F.struct(F.lit(a).alias("var_x"), F.lit(b).alias("var_y"),
                                  F.round(c, 6).alias("corr")))
    return df.agg(F.array(*exprs).alias("_m")).select(F.inline("_m"))


def _sql_corr_long(frame: str, cols: list[str]) -> str:
    parts = [f"SELECT '{a}' AS var_x, '{b}' AS var_y, round(corr({a}, {b}), 6) AS corr FROM {frame}"
             for a in cols for b in cols]
    return " UNION ALL ".join(parts)


@register("L16_price_demand_corr", with_sales(f"""
p AS (SELECT product_id, subcategory, CAST(sum(quantity) AS DOUBLE) AS units, {MS} AS revenue,
             avg(discount_percent) AS discount, quantile_cont(discounted_price_inr, 0.5) AS price
      FROM sales GROUP BY ALL)
{_sql_corr_long("p", ["price", "units", "revenue", "discount"])}"""))
def l16_corr(spark: SparkSession, d: str) -> DataFrame:
    """q10: correlation of price, units, revenue, discount across products."""
    p = _product_price_demand(spark, d).withColumn("units", F.col("units").cast("double"))
    return _corr_long(p, ["price", "units", "revenue", "discount"])


# ------------------------------------------------------------------ L17 q11
@register("L17_delivery_summary", with_sales("""
SELECT avg(delivery_days) AS avg_delivery_days,
       quantile_cont(delivery_days, 0.5) AS median_delivery_days,
       avg(CASE WHEN delivery_days <= CASE delivery_type WHEN 'Same Day' THEN 1 WHEN 'Express' THEN 2
                                        WHEN 'Standard' THEN 7 END
                THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS on_time_vs_sla
FROM sales"""))
def l17_summary(spark: SparkSession, d: str) -> DataFrame:
    """q11: mean / median delivery days and on-time share vs the EDA SLA."""
    t = tx(spark, d, "delivery_days", "delivery_type")
    on_time = F.coalesce(F.col("delivery_days") <= lookup(config.SLA_EDA, "delivery_type"), F.lit(False))
    agg = t.agg(F.avg("delivery_days").alias("avg_delivery_days"),
                F.avg(flag(on_time)).alias("on_time_vs_sla"))
    med = exact_quantiles(t, "delivery_days", [0.5], name="_m")
    return agg.crossJoin(F.broadcast(med)).select("avg_delivery_days", F.col("_m0").alias("median_delivery_days"),
                                     "on_time_vs_sla")


@register("L17_delivery_by_tier", with_sales("""
SELECT customer_tier, avg(delivery_days) AS avg_days, avg(customer_rating) AS rating FROM sales GROUP BY 1"""))
def l17_by_tier(spark: SparkSession, d: str) -> DataFrame:
    """q11: mean delivery days and rating by tier."""
    return tx(spark, d, "customer_tier", "delivery_days", "customer_rating").groupBy("customer_tier").agg(
        F.avg("delivery_days").alias("avg_days"), F.avg("customer_rating").alias("rating"))


@register("L17_rating_by_days", with_sales("""
SELECT delivery_days, avg(customer_rating) AS rating, count(*) AS orders FROM sales GROUP BY 1"""))
def l17_rating_by_days(spark: SparkSession, d: str) -> DataFrame:
    """q11: mean rating per delivery-days value, with the histogram count (I8)."""
    return tx(spark, d, "delivery_days", "customer_rating").groupBy("delivery_days").agg(
        F.avg("customer_rating").alias("rating"), F.count("*").alias("orders"))


# ------------------------------------------------------------------ L18 q12
@register("L18_return_rates", with_sales(f"""
SELECT avg({FLAG_RET}) AS return_rate, avg({FLAG_CAN}) AS cancel_rate FROM sales"""))
def l18_rates(spark: SparkSession, d: str) -> DataFrame:
    """q12: overall return and cancel rates."""
    t = tx(spark, d, "return_status")
    return t.agg(F.avg(flag(F.col("return_status") == "Returned")).alias("return_rate"),
                 F.avg(flag(F.col("return_status") == "Cancelled")).alias("cancel_rate"))


@register("L18_status_mix", with_sales("""
c AS (SELECT return_status, count(*) AS n FROM sales WHERE return_status IS NOT NULL GROUP BY 1)
SELECT return_status, n, n / sum(n) OVER () AS share FROM c"""))
def l18_status(spark: SparkSession, d: str) -> DataFrame:
    """q12: order status mix (normalised value counts, E10)."""
    c = tx(spark, d, "return_status").where(F.col("return_status").isNotNull()).groupBy("return_status").agg(
        F.count("*").alias("n"))
    return share_of(c, "n", name="share")


@register("L18_return_by_subcategory", with_sales(f"""
SELECT subcategory, avg({FLAG_RET}) AS return_rate FROM sales GROUP BY 1"""))
def l18_by_sub(spark: SparkSession, d: str) -> DataFrame:
    """q12: return rate by subcategory."""
    return tx(spark, d, "subcategory", "return_status").groupBy("subcategory").agg(
        F.avg(flag(F.col("return_status") == "Returned")).alias("return_rate"))


@register("L18_return_by_price_quintile", with_sales(f"""
e AS (SELECT quantile_cont(discounted_price_inr, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM sales),
b AS (SELECT s.*, CASE WHEN discounted_price_inr >= q[1] AND discounted_price_inr <= q[6] THEN
        1 + (discounted_price_inr > q[2])::INT + (discounted_price_inr > q[3])::INT
          + (discounted_price_inr > q[4])::INT + (discounted_price_inr > q[5])::INT END AS band_ord
      FROM sales s, e)
SELECT band_ord, ['Q1 cheap', 'Q2', 'Q3', 'Q4', 'Q5 expensive'][band_ord] AS price_band,
       avg({FLAG_RET}) AS return_rate, avg(customer_rating) AS rating, round(avg(product_rating), 6) AS product_rating
FROM b WHERE band_ord IS NOT NULL GROUP BY 1, 2"""))
def l18_by_quintile(spark: SparkSession, d: str) -> DataFrame:
    """q12: return rate and ratings by price quintile (I7 qcut on exact quantiles)."""
    t = tx(spark, d, "discounted_price_inr", "return_status", "customer_rating", "product_rating")
    b = quantile_band(t, "discounted_price_inr", 5, config.PRICE_QUINTILE_LABELS, "price_band", "band_ord")
    return b.where(F.col("band_ord").isNotNull()).groupBy("band_ord", "price_band").agg(
        F.avg(flag(F.col("return_status") == "Returned")).alias("return_rate"),
        F.avg("customer_rating").alias("rating"),
        ratio(F.avg("product_rating")).alias("product_rating"))


# ------------------------------------------------------------------ L19 q13
@register("L19_brand_share_by_year", with_sales(f"""
b AS (SELECT order_year, brand, {MS} AS revenue FROM sales GROUP BY ALL)
SELECT order_year, brand, revenue,
       revenue / {sql_msum_over("revenue", "PARTITION BY order_year")} * 100 AS share_pct FROM b"""))
def l19_share(spark: SparkSession, d: str) -> DataFrame:
    """q13: brand share of each year's revenue (%)."""
    b = tx(spark, d, "order_year", "brand", AMT).groupBy("order_year", "brand").agg(msum(AMT).alias("revenue"))
    return share_of(b, "revenue", ["order_year"], "share_pct", 100.0, money=True)


@register("L19_top_brands", with_sales(f"""
SELECT brand, {MS} AS revenue FROM sales GROUP BY brand ORDER BY revenue DESC, brand LIMIT 12"""))
def l19_top(spark: SparkSession, d: str) -> DataFrame:
    """q13: top 12 brands by revenue."""
    b = tx(spark, d, "brand", AMT).groupBy("brand").agg(msum(AMT).alias("revenue"))
    return top_k(b, 12, "revenue", ["brand"])


@register("L19_top8_share_first_last", with_sales(f"""
top AS (SELECT brand FROM sales GROUP BY brand ORDER BY {MS} DESC, brand LIMIT 8),
yr AS (SELECT min(order_year) AS y0, max(order_year) AS y1 FROM sales),
yb AS (SELECT order_year, brand, {MS} AS revenue FROM sales GROUP BY ALL),
tot AS (SELECT order_year, {sql_msum("revenue")} AS total FROM yb GROUP BY 1),
cells AS (SELECT y.order_year, t.brand FROM (SELECT y0 AS order_year FROM yr UNION SELECT y1 FROM yr) y, top t)
SELECT c.order_year, c.brand, coalesce(yb.revenue, 0) / tot.total * 100 AS share_pct
FROM cells c JOIN tot USING (order_year) LEFT JOIN yb USING (order_year, brand)"""))
def l19_first_last(spark: SparkSession, d: str) -> DataFrame:
    """q13: share of the top-8 brands in the first and the last year (0 when absent)."""
    yb = stored(tx(spark, d, "order_year", "brand", AMT).groupBy("order_year", "brand").agg(msum(AMT).alias("revenue")), "brand-years")
    top = top_k(yb.groupBy("brand").agg(msum("revenue").alias("r")), 8, "r", ["brand"]).select("brand")
    yr = yb.agg(F.min("order_year").alias("y0"), F.max("order_year").alias("y1"))
    years = yr.select(F.explode(F.array_distinct(F.array("y0", "y1"))).alias("order_year"))
    tot = yb.groupBy("order_year").agg(msum("revenue").alias("total"))
    cells = years.crossJoin(F.broadcast(top))
    return cells.join(tot, "order_year").join(yb, ["order_year", "brand"], "left").select(
        "order_year", "brand", (F.coalesce("revenue", F.lit(0.0)) / F.col("total") * 100).alias("share_pct"))


# ------------------------------------------------------------------ L20 q14
@register("L20_clv_summary", with_sales(f"""
SELECT quantile_cont(clv, 0.5) AS median_clv, {sql_mavg("clv")} AS mean_clv FROM customers""", CUSTOMERS_CTE))
def l20_summary(spark: SparkSession, d: str) -> DataFrame:
    """q14: median and mean CLV."""
    c = build_customers(spark, d, ["clv"])
    med = exact_quantiles(c, "clv", [0.5], name="_m")
    return c.agg(mavg("clv").alias("mean_clv")).crossJoin(F.broadcast(med)).select(
        F.col("_m0").alias("median_clv"), "mean_clv")


@register("L20_clv_by_segment", with_sales("""
SELECT rfm_segment, quantile_cont(clv, 0.5) AS median_clv FROM customers GROUP BY 1""", CUSTOMERS_CTE))
def l20_by_segment(spark: SparkSession, d: str) -> DataFrame:
    """q14: median CLV per RFM segment."""
    return exact_quantiles(build_customers(spark, d, ["clv", "rfm_segment"]), "clv", [0.5], ["rfm_segment"], "_m").withColumnRenamed(
        "_m0", "median_clv")


@register("L20_clv_by_acq_year", with_sales("""
SELECT acquisition_year, quantile_cont(clv, 0.5) AS median_clv FROM customers GROUP BY 1""", CUSTOMERS_CTE))
def l20_by_acq(spark: SparkSession, d: str) -> DataFrame:
    """q14: median CLV per acquisition year."""
    return exact_quantiles(build_customers(spark, d, ["clv", "acquisition_year"]), "clv", [0.5], ["acquisition_year"], "_m").withColumnRenamed(
        "_m0", "median_clv")


_SQL_COHORT = """
first AS (SELECT customer_id, CAST(year(min(order_date)) AS INTEGER) AS acq_year FROM sales GROUP BY 1),
cells AS (SELECT acq_year, p.order_year - acq_year AS period, count(DISTINCT p.customer_id) AS customers
          FROM (SELECT DISTINCT customer_id, order_year FROM sales) p JOIN first USING (customer_id)
          GROUP BY ALL)"""


@register("L20_cohort_retention", with_sales(_SQL_COHORT + """
SELECT c.acq_year, c.period, c.customers, c.customers / b.customers AS retention
FROM cells c LEFT JOIN (SELECT acq_year, customers FROM cells WHERE period = 0) b USING (acq_year)"""))
def l20_cohort(spark: SparkSession, d: str) -> DataFrame:
    """q14: retention by acquisition year and year offset (observed cells, J12)."""
    return cohort_retention(tx(spark, d, "customer_id", "order_date", "order_year"), "customer_id",
                            "order_date", "order_year")


# ------------------------------------------------------------------ L21 q15



def _disc_band():
    return band("discount_percent", config.DISCOUNT_BAND_EDGES, config.DISCOUNT_BAND_LABELS, open_end=True)


@register("L21_discount_bands", with_sales(f"""
SELECT {_SQL_DISC_BAND} AS disc_bin, count(*) AS orders, {MS} AS revenue, CAST(sum(quantity) AS BIGINT) AS units,
       {MA} AS aov
FROM sales WHERE {_SQL_DISC_BAND} IS NOT NULL GROUP BY 1"""))
def l21_bands(spark: SparkSession, d: str) -> DataFrame:
    """q15: orders, revenue, units, AOV by fixed discount band."""
    t = tx(spark, d, "discount_percent", "quantity", AMT).withColumn("disc_bin", _disc_band())
    return t.where(F.col("disc_bin").isNotNull()).groupBy("disc_bin").agg(
        F.count("*").alias("orders"), msum(AMT).alias("revenue"), F.sum("quantity").alias("units"),
        mavg(AMT).alias("aov"))


@register("L21_discount_corr", with_sales(f"""
p AS (SELECT discount_percent, CAST(quantity AS DOUBLE) AS quantity, final_amount_inr, original_price_inr FROM sales)
{_sql_corr_long("p", ["discount_percent", "quantity", "final_amount_inr", "original_price_inr"])}"""))
def l21_corr(spark: SparkSession, d: str) -> DataFrame:
    """q15: correlation of discount, quantity, final amount, list price."""
    t = tx(spark, d, "discount_percent", "quantity", AMT, "original_price_inr").withColumn(
        "quantity", F.col("quantity").cast("double"))
    return _corr_long(t, ["discount_percent", "quantity", AMT, "original_price_inr"])


@register("L21_discount_by_year", with_sales(f"""
SELECT order_year, {_SQL_DISC_BAND} AS disc_bin, {MS} AS revenue, avg(discount_percent) AS avg_discount
FROM sales WHERE {_SQL_DISC_BAND} IS NOT NULL GROUP BY 1, 2"""))
def l21_by_year(spark: SparkSession, d: str) -> DataFrame:
    """q15: revenue per year and discount band, with the mean discount."""
    t = tx(spark, d, "order_year", "discount_percent", AMT).withColumn("disc_bin", _disc_band())
    return t.where(F.col("disc_bin").isNotNull()).groupBy("order_year", "disc_bin").agg(
        msum(AMT).alias("revenue"), F.avg("discount_percent").alias("avg_discount"))


# ------------------------------------------------------------------ L22 q16
def _product_ratings(spark, d):
    """One scan of the fact, as in q10: sums by (product, price), stored, give totals and the median price."""
    keys = ["product_id", "subcategory"]
    t = tx(spark, d, *keys, "product_rating", "customer_rating", "quantity", "discounted_price_inr", AMT)
    prices = stored(t.groupBy(*keys, "discounted_price_inr").agg(
        F.sum("product_rating").alias("p"), F.count("product_rating").alias("pn"), F.sum("customer_rating").alias("c"), F.count("customer_rating").alias("cn"),
        F.sum(paise(AMT)).alias("paise"), F.sum("quantity").alias("units"), F.count("*").alias("rows")), "product-ratings")
    agg = prices.groupBy(*keys).agg(
        F.try_divide(F.sum("p"), F.sum("pn")).alias("_pr"), F.try_divide(F.sum("c"), F.sum("cn")).alias("customer_rating"),
        (F.sum("paise") / 100.0).alias("revenue"), F.sum("units").alias("units"))
    med = exact_quantiles(prices, "discounted_price_inr", [0.5], by=keys, name="_p", weight="rows")
    return agg.join(med, keys).withColumnRenamed("_p0", "price")


_SQL_PROD_RATINGS = f"""
pr AS (SELECT product_id, subcategory, avg(product_rating) AS _pr, avg(customer_rating) AS customer_rating,
              {MS} AS revenue, CAST(sum(quantity) AS BIGINT) AS units,
              quantile_cont(discounted_price_inr, 0.5) AS price FROM sales GROUP BY ALL)"""


@register("L22_product_ratings", with_sales(_SQL_PROD_RATINGS + """,
e AS (SELECT quantile_cont(price, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM pr)
SELECT product_id, subcategory, round(_pr, 6) AS product_rating, customer_rating, revenue, units, price,
       ['Low', 'Mid-Low', 'Mid-High', 'High'][1 + (price > q[2])::INT + (price > q[3])::INT + (price > q[4])::INT]
         AS price_band
FROM pr, e"""))
def l22_products(spark: SparkSession, d: str) -> DataFrame:
    """q16: per-product ratings, revenue, units, median price and price quartile band."""
    p = quantile_band(_product_ratings(spark, d), "price", 4, config.PRICE_QUARTILE_LABELS, "price_band")
    return p.select("product_id", "subcategory", ratio("_pr").alias("product_rating"), "customer_rating",
                    "revenue", "units", "price", "price_band")


@register("L22_rating_boxes", with_sales(_SQL_PROD_RATINGS + """,
e AS (SELECT quantile_cont(price, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM pr),
b AS (SELECT ['Low', 'Mid-Low', 'Mid-High', 'High'][1 + (price > q[2])::INT + (price > q[3])::INT + (price > q[4])::INT] AS price_band, round(_pr, 6) AS r FROM pr, e)
SELECT price_band, count(*) AS products, min(r) AS min, round(quantile_cont(r, 0.25), 4) AS q1, round(quantile_cont(r, 0.5), 4) AS median,
       round(quantile_cont(r, 0.75), 4) AS q3, max(r) AS max FROM b GROUP BY 1"""))
def l22_boxes(spark: SparkSession, d: str) -> DataFrame:
    """q16: box numbers of the products' rating by price quartile."""
    p = quantile_band(_product_ratings(spark, d), "price", 4, config.PRICE_QUARTILE_LABELS, "price_band")
    p = stored(p.select("price_band", ratio("_pr").alias("r")), "rated")
    boxes = five_number(p, "r", ["price_band"]).withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})
    return boxes.join(p.groupBy("price_band").agg(F.count("*").alias("products")), "price_band")


@register("L22_ratings_summary", with_sales(_SQL_PROD_RATINGS + """
SELECT round(corr(_pr, CAST(units AS DOUBLE)), 6) AS rating_vs_units_corr,
       round(corr(_pr, revenue), 6) AS rating_vs_revenue_corr,
       (SELECT round(avg(product_rating), 6) FROM sales) AS mean_product_rating,
       (SELECT avg(customer_rating) FROM sales) AS mean_customer_rating
FROM pr"""))
def l22_summary(spark: SparkSession, d: str) -> DataFrame:
    """q16: rating vs units / revenue correlation and mean ratings."""
    p = _product_ratings(spark, d)
    c = p.agg(
        F.round(F.try_divide(F.covar_pop("_pr", F.col("units").cast("double")),
                             F.stddev_pop("_pr") * F.stddev_pop(F.col("units").cast("double"))), 6)
        .alias("rating_vs_units_corr"),
        F.round(F.try_divide(F.covar_pop("_pr", "revenue"), F.stddev_pop("_pr") * F.stddev_pop("revenue")), 6)
        .alias("rating_vs_revenue_corr"))
    m = tx(spark, d, "product_rating", "customer_rating").agg(
        ratio(F.avg("product_rating")).alias("mean_product_rating"),
        F.avg("customer_rating").alias("mean_customer_rating"))
    return c.crossJoin(F.broadcast(m))


# ------------------------------------------------------------------ L23 q17
@register("L23_frequency_distribution", with_sales("""
o AS (SELECT customer_id, count(DISTINCT transaction_id) AS n FROM sales GROUP BY 1)
SELECT CAST(least(n, 10) AS BIGINT) AS orders_capped, count(*) AS customers FROM o GROUP BY 1"""))
def l23_freq(spark: SparkSession, d: str) -> DataFrame:
    """q17: customers by number of orders, capped at 10."""
    o = tx(spark, d, "customer_id", "transaction_id").groupBy("customer_id").agg(
        F.countDistinct("transaction_id").alias("n"))
    return o.groupBy(F.least("n", F.lit(10)).cast("long").alias("orders_capped")).agg(
        F.count("*").alias("customers"))


@register("L23_journey_summary", with_sales("""
o AS (SELECT customer_id, count(DISTINCT transaction_id) AS n FROM sales GROUP BY 1)
SELECT avg(CASE WHEN n = 1 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS one_time_customer_share,
       avg(CASE WHEN n >= 5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS loyal_5plus_share,
       avg(n) AS mean_orders_per_customer FROM o"""))
def l23_summary(spark: SparkSession, d: str) -> DataFrame:
    """q17: one-time share, 5+ share, mean orders per customer."""
    o = tx(spark, d, "customer_id", "transaction_id").groupBy("customer_id").agg(
        F.countDistinct("transaction_id").alias("n"))
    return o.agg(F.avg(flag(F.col("n") == 1)).alias("one_time_customer_share"),
                 F.avg(flag(F.col("n") >= 5)).alias("loyal_5plus_share"),
                 F.avg("n").alias("mean_orders_per_customer"))


@register("L23_transitions", with_sales("""
seq AS (SELECT subcategory AS to_state,
               lag(subcategory) OVER (PARTITION BY customer_id ORDER BY order_date, transaction_id) AS from_state
        FROM sales),
cnt AS (SELECT from_state, to_state, count(*) AS n FROM seq WHERE from_state IS NOT NULL GROUP BY ALL),
cats AS (SELECT DISTINCT subcategory AS s FROM sales),
grid AS (SELECT a.s AS from_state, b.s AS to_state FROM cats a, cats b),
dense AS (SELECT g.from_state, g.to_state, CAST(coalesce(cnt.n, 0) AS BIGINT) AS transitions
          FROM grid g LEFT JOIN cnt USING (from_state, to_state))
SELECT *, transitions / NULLIF(sum(transitions) OVER (PARTITION BY from_state), 0) AS row_share FROM dense"""))
def l23_transitions(spark: SparkSession, d: str) -> DataFrame:
    """q17: subcategory-to-next-subcategory transitions per customer (F2 lag by
    date then id), dense row-normalised matrix (H6); top pairs = order by
    ``transitions`` (G6)."""
    t = tx(spark, d, "customer_id", "order_date", "transaction_id", "subcategory")
    return transitions(t, "customer_id", ["order_date", "transaction_id"], "subcategory")


@register("L23_top_transitions", with_sales("""
seq AS (SELECT subcategory AS to_state,
               lag(subcategory) OVER (PARTITION BY customer_id ORDER BY order_date, transaction_id) AS from_state
        FROM sales)
SELECT from_state, to_state, count(*) AS transitions FROM seq WHERE from_state IS NOT NULL
GROUP BY 1, 2 ORDER BY transitions DESC, from_state, to_state LIMIT 8"""))
def l23_top(spark: SparkSession, d: str) -> DataFrame:
    """q17: the eight most frequent transitions."""
    return top_k(l23_transitions(spark, d).select("from_state", "to_state", "transitions"), 8, "transitions", ["from_state", "to_state"])


@register("L21_mean_discount", with_sales("SELECT avg(discount_percent) AS mean_discount, count(*) AS orders FROM sales"))
def l21_mean(spark: SparkSession, d: str) -> DataFrame:
    """q15: overall mean discount."""
    return tx(spark, d, "discount_percent").agg(F.avg("discount_percent").alias("mean_discount"), F.count("*").alias("orders"))


# ------------------------------------------------------------------ L24 q18
@register("L24_revenue_by_product_age", with_sales(f"""
SELECT s.order_year - p.launch_year AS age, {MA} AS avg_revenue
FROM sales s LEFT JOIN products p USING (product_id)
WHERE s.order_year - p.launch_year >= 0 GROUP BY 1""", CATALOG_CTE))
def l24_age(spark: SparkSession, d: str) -> DataFrame:
    """q18: mean line revenue by product age in years (D5 left join, B11 age >= 0)."""
    t = tx(spark, d, "product_id", "order_year", AMT)
    launch = catalog(spark, d).select("product_id", "launch_year")
    j = t.join(launch, "product_id", "left").withColumn("age", F.col("order_year") - F.col("launch_year"))
    return j.where(F.col("age") >= 0).groupBy("age").agg(mavg(AMT).alias("avg_revenue"))


@register("L24_subcategory_share_by_year", with_sales(f"""
b AS (SELECT order_year, subcategory, {MS} AS revenue FROM sales GROUP BY ALL)
SELECT order_year, subcategory, revenue,
       revenue / {sql_msum_over("revenue", "PARTITION BY order_year")} AS share FROM b"""))
def l24_share(spark: SparkSession, d: str) -> DataFrame:
    """q18: subcategory share of each year's revenue."""
    b = tx(spark, d, "order_year", "subcategory", AMT).groupBy("order_year", "subcategory").agg(
        msum(AMT).alias("revenue"))
    return share_of(b, "revenue", ["order_year"], "share", money=True)


# ------------------------------------------------------------------ L25 q19
def _top8_brand_lines(spark, d):
    t = tx(spark, d, "brand", "discounted_price_inr", "quantity", "product_rating", AMT)
    top = top_k(t.groupBy("brand").agg(msum(AMT).alias("r")), 8, "r", ["brand"]).select("brand")
    # semi-join with the 8 names (D10): the right side is 8 rows by construction
    return t.join(F.broadcast(top), "brand", "left_semi")


_SQL_TOP8 = f"""
top AS (SELECT brand FROM sales GROUP BY brand ORDER BY {MS} DESC, brand LIMIT 8),
part8 AS (SELECT * FROM sales WHERE brand IN (SELECT brand FROM top))"""


@register("L25_brand_positioning", with_sales(_SQL_TOP8 + """
SELECT brand, quantile_cont(discounted_price_inr, 0.5) AS median_price, CAST(sum(quantity) AS BIGINT) AS units,
       round(avg(product_rating), 6) AS rating
FROM part8 GROUP BY 1"""))
def l25_positioning(spark: SparkSession, d: str) -> DataFrame:
    """q19: median price, units and mean product rating of the top-8 brands."""
    p = _top8_brand_lines(spark, d)
    agg = p.groupBy("brand").agg(F.sum("quantity").alias("units"), ratio(F.avg("product_rating")).alias("rating"))
    med = exact_quantiles(p, "discounted_price_inr", [0.5], ["brand"], "_m")
    return agg.join(med, "brand").select("brand", F.col("_m0").alias("median_price"), "units", "rating")


@register("L25_brand_price_boxes", with_sales(_SQL_TOP8 + """
SELECT brand, min(discounted_price_inr) AS min, quantile_cont(discounted_price_inr, 0.25) AS q1,
       quantile_cont(discounted_price_inr, 0.5) AS median, quantile_cont(discounted_price_inr, 0.75) AS q3,
       max(discounted_price_inr) AS max
FROM part8 GROUP BY 1"""))
def l25_boxes(spark: SparkSession, d: str) -> DataFrame:
    """q19: price box-plot numbers for the top-8 brands."""
    return five_number(_top8_brand_lines(spark, d), "discounted_price_inr", ["brand"])


# ------------------------------------------------------------------ L26 q20
_SQL_HEALTH = f"""
y AS (SELECT order_year, {MS} AS revenue, count(*) AS orders, count(DISTINCT customer_id) AS customers,
             {MA} AS aov,
             avg(CASE WHEN is_prime_member THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS prime_share,
             avg({FLAG_RET}) AS return_rate, avg(delivery_days) AS avg_delivery
      FROM sales GROUP BY 1),
nc AS (SELECT acq_year AS order_year, count(*) AS new_customers
       FROM (SELECT customer_id, CAST(year(min(order_date)) AS INTEGER) AS acq_year FROM sales GROUP BY 1)
       GROUP BY 1),
h AS (SELECT y.*, nc.new_customers,
             revenue / NULLIF(lag(revenue) OVER (ORDER BY order_year), 0) - 1 AS yoy
      FROM y LEFT JOIN nc USING (order_year))"""


def _health(spark, d):
    t = tx(spark, d, "order_year", "order_date", "customer_id", "is_prime_member", "return_status",
           "delivery_days", AMT)
    y = t.groupBy("order_year").agg(
        msum(AMT).alias("revenue"), F.count("*").alias("orders"),
        F.countDistinct("customer_id").alias("customers"), mavg(AMT).alias("aov"),
        F.avg(flag("is_prime_member")).alias("prime_share"),
        F.avg(flag(F.col("return_status") == "Returned")).alias("return_rate"),
        F.avg("delivery_days").alias("avg_delivery"))
    nc = t.groupBy("customer_id").agg(F.year(F.min("order_date")).alias("order_year")).groupBy(
        "order_year").agg(F.count("*").alias("new_customers"))
    y = y.join(nc, "order_year", "left")
    return period_change(y, "revenue", "order_year", "yoy")


@register("L26_business_health", with_sales(_SQL_HEALTH + " SELECT * FROM h"))
def l26_health(spark: SparkSession, d: str) -> DataFrame:
    """q20: yearly revenue, orders, customers, AOV, prime share, return rate,
    delivery, new customers (D13 left align) and YoY."""
    return _health(spark, d)


@register("L26_health_trend", with_sales(_SQL_HEALTH + """
SELECT round(regr_slope(revenue, order_year), 2) AS linear_slope_inr_per_year,
       arg_max(customers, order_year) AS active_customers_latest,
       arg_max(return_rate, order_year) AS return_rate_latest FROM h"""))
def l26_trend(spark: SparkSession, d: str) -> DataFrame:
    """q20: linear revenue slope per year (J2) and latest-year KPIs."""
    h = _health(spark, d)
    return h.agg(F.round(F.regr_slope("revenue", F.col("order_year").cast("double")), 2)
                 .alias("linear_slope_inr_per_year"),
                 F.max_by("customers", "order_year").alias("active_customers_latest"),
                 F.max_by("return_rate", "order_year").alias("return_rate_latest"))
