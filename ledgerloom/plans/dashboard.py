"""The thirty dashboard questions.

Every page first applies the global slicer (B1) and then aggregates; each
function takes the slice, and those in ``SLICED`` are registered with one.  Dimensions stay
global (customers are scored on all history, not re-scored per slice);
"active in the slice" is a left-semi join (D11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom import config
from ledgerloom.functions.exprs import band, flag, lookup, mavg, msum, paise
from ledgerloom.operators.journey import association_rules, cohort_retention, top_k
from ledgerloom.operators.ranking import exact_quantiles
from ledgerloom.operators.series import linear_forecast, period_change
from ledgerloom.operators.shares import share_of
from ledgerloom.operators.slicer import ALL, Slice, apply_slice, filter_choices, needed_columns
from ledgerloom.plans.dims import build_customers
from ledgerloom.plans.oracle_sql import (CATALOG_CTE, CUSTOMERS_CTE, SQL_DISC_BAND as _SQL_DISC_BAND, sql_mavg, sql_msum, sql_msum_over,
                                         with_sales)
from ledgerloom.plans.registry import register
from ledgerloom.session import stored
from ledgerloom.sources.tables import catalog, sales

AMT = "final_amount_inr"
MS = sql_msum(AMT)
MA = sql_mavg(AMT)
ONE = "CAST(1 AS DOUBLE)"
ZERO = "CAST(0 AS DOUBLE)"


def _f(cond: str) -> str:
    return f"CASE WHEN {cond} THEN {ONE} ELSE {ZERO} END"


def view(spark: SparkSession, d: str, cols: list[str], s: Slice = ALL) -> DataFrame:
    """Sliced fact with ``cols`` (slicer columns read only when filtering);
    the years reach the scan of orders as a range of its own date column."""
    need = list(dict.fromkeys(cols + needed_columns(s)))
    return apply_slice(sales(spark, d, need, years=s.years), s).select(*cols)


def _active_customers(spark: SparkSession, d: str, columns: list[str], s: Slice = ALL) -> DataFrame:
    """``columns`` of the global customer dimension, of customers in the slice
    (D11).  Their distinct ids meet it, one row a customer; an empty slice
    holds every customer and needs no join."""
    c = build_customers(spark, d, columns)
    return c if s == ALL else c.join(view(spark, d, ["customer_id"], s).distinct(), "customer_id", "left_semi")


# ------------------------------------------------------------------ L27 home / L28 Q1
_SQL_YEARLY = f"""
y AS (SELECT order_year, {MS} AS revenue, count(*) AS orders, count(DISTINCT customer_id) AS customers,
             {MA} AS aov FROM sales GROUP BY 1),
yy AS (SELECT *, revenue / NULLIF(lag(revenue) OVER (ORDER BY order_year), 0) - 1 AS yoy FROM y),
lp AS (SELECT max(order_year) AS latest FROM sales),
cur AS (SELECT y.* FROM y, lp WHERE order_year = latest),
prev AS (SELECT y.* FROM y, lp WHERE order_year = latest - 1)"""


def _yearly(spark, d, s=ALL):
    t = view(spark, d, ["order_year", "customer_id", AMT], s)
    y = t.groupBy("order_year").agg(msum(AMT).alias("revenue"), F.count("*").alias("orders"),
                                    F.countDistinct("customer_id").alias("customers"), mavg(AMT).alias("aov"))
    return period_change(y, "revenue", "order_year", "yoy")


def _yoy(cur: str, prev: str):
    """YoY ratio latest vs previous year; null when previous is 0 / missing."""
    return F.try_divide(F.col(cur), F.when(F.col(prev) != 0, F.col(prev))) - 1


def _customer_years(t: DataFrame, **more) -> DataFrame:
    """The slice reduced to one row a customer and year: amounts in paise and
    counts, and what ``more`` names."""
    return t.groupBy("order_year", "customer_id").agg(
        F.sum(paise(AMT)).alias("m"), F.count(AMT).alias("mn"), F.count("*").alias("n"), *[c.alias(n) for n, c in more.items()])


def _latest_and_total(years: DataFrame, **more) -> DataFrame:
    """One row: the totals of ``_customer_years`` (revenue, orders, customers,
    aov, and ``more``), and revenue, customers and aov of the latest year
    (``cur_*``) and of the one before (``prev_*``).

    GROUPING SETS give the years and the total in one shuffle; the handful of
    rows they leave is folded into the one row without a join."""
    sets = years.groupingSets([[F.col("order_year")], []], "order_year").agg(
        F.grouping("order_year").alias("whole"), (F.sum("m") / 100.0).alias("revenue"), F.sum("n").alias("orders"),
        F.countDistinct("customer_id").alias("customers"), (F.try_divide(F.sum("m"), F.sum("mn")) / 100.0).alias("aov"),
        *[c.alias(n) for n, c in more.items()])
    totals = ["revenue", "orders", "customers", "aov", *more]
    year = F.struct("order_year", "revenue", "customers", "aov")
    folded = sets.agg(
        F.max(F.when(F.col("whole") == 1, F.struct(*totals))).alias("t"),
        F.reverse(F.array_sort(F.collect_list(F.when((F.col("whole") == 0) & F.col("order_year").isNotNull(), year)))).alias("y"))
    cur, before = F.get("y", F.lit(0)), F.get("y", F.lit(1))
    prev = F.when(before["order_year"] == cur["order_year"] - 1, before)
    return folded.select("t.*", *[x[c].alias(f"{n}_{c}") for n, x in (("cur", cur), ("prev", prev)) for c in ("revenue", "customers", "aov")])


def _kpi_row(spark, d, s=ALL):
    t = view(spark, d, ["order_year", "customer_id", "is_prime_member", AMT], s)
    years = _customer_years(t, prime=F.count_if("is_prime_member"), primes=F.count("is_prime_member"))
    j = _latest_and_total(years, prime_share=F.try_divide(F.sum("prime").cast("double"), F.sum("primes")))
    return j.select("revenue", "orders", F.col("customers").alias("active_customers"), "aov", "prime_share",
                    _yoy("cur_revenue", "prev_revenue").alias("revenue_yoy"),
                    _yoy("cur_customers", "prev_customers").alias("customers_yoy"),
                    _yoy("cur_aov", "prev_aov").alias("aov_yoy"))


_SQL_KPI = _SQL_YEARLY + f""",
tot AS (SELECT {MS} AS revenue, count(*) AS orders, count(DISTINCT customer_id) AS active_customers,
               {MA} AS aov, avg({_f("is_prime_member")}) AS prime_share FROM sales)
SELECT tot.*, cur.revenue / NULLIF(prev.revenue, 0) - 1 AS revenue_yoy,
       cur.customers / NULLIF(prev.customers, 0) - 1 AS customers_yoy,
       cur.aov / NULLIF(prev.aov, 0) - 1 AS aov_yoy
FROM tot LEFT JOIN cur ON TRUE LEFT JOIN prev ON TRUE"""


@register("L27_home_kpis", with_sales(_SQL_KPI))
def l27_home(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Home: revenue, orders, active customers, AOV, prime share, latest YoY deltas."""
    return _kpi_row(spark, d, s)


@register("L28_exec_yearly", with_sales(_SQL_YEARLY + " SELECT * FROM yy"))
def l28_yearly(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q1: yearly revenue, orders, customers, AOV and YoY."""
    return _yearly(spark, d, s)


@register("L28_exec_top_subcategory", with_sales(f"""
SELECT subcategory AS top_subcategory, {MS} AS revenue FROM sales GROUP BY 1
ORDER BY revenue DESC, subcategory LIMIT 1"""))
def l28_top_sub(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q1: top subcategory by revenue (E9 arg-max)."""
    by = view(spark, d, ["subcategory", AMT], s).groupBy("subcategory").agg(msum(AMT).alias("revenue"))
    return top_k(by, 1, "revenue", ["subcategory"]).withColumnRenamed("subcategory", "top_subcategory")


@register("L28_exec_subcategories", with_sales(f"""
SELECT subcategory, {MS} AS revenue, CAST(row_number() OVER (ORDER BY {MS} DESC, subcategory) AS INTEGER) AS rank
FROM sales GROUP BY 1"""))
def l28_subcategories(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q1: subcategories ranked by revenue."""
    by = view(spark, d, ["subcategory", AMT], s).groupBy("subcategory").agg(msum(AMT).alias("revenue"))
    return by.withColumn("rank", F.row_number().over(Window.orderBy(F.col("revenue").desc(), "subcategory")))


# ------------------------------------------------------------------ L29 Q2
@register("L29_month_monitor", with_sales(f"""
mx AS (SELECT max(order_date) AS d FROM sales),
m AS (SELECT date_trunc('month', d) AS m0, d FROM mx),
cur AS (SELECT {MS} AS actual, count(DISTINCT customer_id) AS active FROM sales, m
        WHERE date_trunc('month', order_date) = m0),
ly AS (SELECT coalesce({MS}, 0) AS last_year FROM sales, m
       WHERE date_trunc('month', order_date) = m0 - INTERVAL 12 MONTH),
k AS (SELECT CAST(m0 AS DATE) AS month_start, actual, last_year, last_year * 1.1 AS target,
             actual / greatest(day(d), 1) * day(last_day(d)) AS run_rate, active AS active_customers
      FROM m, cur, ly)
SELECT *, CASE WHEN target > 0 AND actual < 0.9 * target THEN 'alert'
               WHEN target > 0 AND actual >= target THEN 'on_target' ELSE 'watch' END AS status FROM k"""))
def l29_monitor(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q2: latest month actual vs same month last year x 1.10 target, run-rate,
    active customers, status (J14, F9)."""
    t = view(spark, d, ["order_date", "customer_id", AMT], s)
    mx = t.agg(F.max("order_date").alias("_d")).select("_d", F.trunc("_d", "month").alias("_m0"))
    tm = t.crossJoin(F.broadcast(mx)).withColumn("_m", F.trunc("order_date", "month"))
    cur = tm.where(F.col("_m") == F.col("_m0"))
    ly = tm.where(F.col("_m") == F.add_months("_m0", -12))
    k = mx.crossJoin(F.broadcast(cur.agg(msum(AMT).alias("actual"), F.countDistinct("customer_id").alias("active_customers"))))
    k = k.crossJoin(F.broadcast(ly.agg(F.coalesce(msum(AMT), F.lit(0.0)).alias("last_year"))))
    k = k.select(
        F.col("_m0").alias("month_start"), "actual", "last_year",
        (F.col("last_year") * config.TARGET_UPLIFT).alias("target"),
        (F.col("actual") / F.greatest(F.dayofmonth("_d"), F.lit(1)) * F.dayofmonth(F.last_day("_d"))).alias("run_rate"),
        "active_customers")
    status = (F.when((F.col("target") > 0) & (F.col("actual") < config.ALERT_BELOW * F.col("target")), "alert")
              .when((F.col("target") > 0) & (F.col("actual") >= F.col("target")), "on_target")
              .otherwise("watch"))
    return k.withColumn("status", status)


# ------------------------------------------------------------------ L30 Q3
@register("L30_tier_mix", with_sales(f"SELECT customer_tier, {MS} AS revenue FROM sales GROUP BY 1"))
def l30_tier(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q3: revenue by city tier."""
    return view(spark, d, ["customer_tier", AMT], s).groupBy("customer_tier").agg(msum(AMT).alias("revenue"))


@register("L30_top6_brands", with_sales(
    f"SELECT brand, {MS} AS revenue FROM sales GROUP BY 1 ORDER BY revenue DESC, brand LIMIT 6"))
def l30_brands(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q3: top 6 brands by revenue."""
    b = view(spark, d, ["brand", AMT], s).groupBy("brand").agg(msum(AMT).alias("revenue"))
    return top_k(b, 6, "revenue", ["brand"])


@register("L30_top10_states", with_sales(
    f"SELECT customer_state, {MS} AS revenue FROM sales GROUP BY 1 ORDER BY revenue DESC, customer_state LIMIT 10"))
def l30_states(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q3: top 10 states by revenue."""
    b = view(spark, d, ["customer_state", AMT], s).groupBy("customer_state").agg(msum(AMT).alias("revenue"))
    return top_k(b, 10, "revenue", ["customer_state"])


# ------------------------------------------------------------------ L31 Q4
@register("L31_financials", with_sales(f"""
f AS (SELECT subcategory, {MS} AS revenue,
             {sql_msum("discounted_price_inr * quantity")} AS _cogs_base, {sql_msum("delivery_charges")} AS delivery
      FROM sales GROUP BY 1)
SELECT subcategory, revenue, revenue - 0.72 * _cogs_base - delivery AS gross_profit, delivery,
       (revenue - 0.72 * _cogs_base - delivery) / revenue * 100 AS margin_pct FROM f"""))
def l31_financials(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q4: revenue, gross profit (COGS proxy 72% of discounted price x qty, B4),
    delivery and margin % by subcategory."""
    t = view(spark, d, ["subcategory", "discounted_price_inr", "quantity", "delivery_charges", AMT], s)
    f = t.groupBy("subcategory").agg(
        msum(AMT).alias("revenue"),
        msum(F.col("discounted_price_inr") * F.col("quantity")).alias("_cogs_base"),
        msum("delivery_charges").alias("delivery"))
    gp = F.col("revenue") - config.COGS_SHARE * F.col("_cogs_base") - F.col("delivery")
    return f.select("subcategory", "revenue", gp.alias("gross_profit"), "delivery",
                    (gp / F.col("revenue") * 100).alias("margin_pct"))


_SQL_FORECAST = f"""
mo AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_start, {MS} AS revenue FROM sales GROUP BY 1),
ix AS (SELECT *, row_number() OVER (ORDER BY month_start) - 1 AS idx FROM mo),
fit AS (SELECT regr_slope(revenue, CAST(idx AS DOUBLE)) AS b, regr_intercept(revenue, CAST(idx AS DOUBLE)) AS a,
               count(*) AS n, min(month_start) AS m0 FROM ix),
sp AS (SELECT CAST(unnest(range(0, n + 6)) AS INTEGER) AS idx, a, b, m0 FROM fit)
SELECT CAST(m0 + to_months(sp.idx) AS DATE) AS month_start, sp.idx, ix.revenue AS actual,
       round(a + b * sp.idx, 2) AS forecast
FROM sp LEFT JOIN ix ON ix.month_start = CAST(m0 + to_months(sp.idx) AS DATE)"""


def _forecast(spark, d, s=ALL):
    t = view(spark, d, ["order_date", AMT], s)
    mo = t.groupBy(F.trunc("order_date", "month").alias("month_start")).agg(msum(AMT).alias("revenue"))
    f = linear_forecast(mo, "month_start", "revenue", config.FORECAST_HORIZON)
    return f.select("month_start", "idx", "actual", F.round("forecast", 2).alias("forecast"))


@register("L31_forecast", with_sales(_SQL_FORECAST))
def l31_forecast(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q4: linear revenue forecast on the months present, next 6 months."""
    return _forecast(spark, d, s)


# ------------------------------------------------------------------ L32 Q5
@register("L32_growth", with_sales(f"""
acq AS (SELECT acquisition_year AS year, count(*) AS new_customers FROM customers GROUP BY 1),
act AS (SELECT order_year AS year, count(DISTINCT customer_id) AS active_customers,
               count(DISTINCT product_id) AS portfolio_skus,
               avg({_f("customer_tier = 'Metro'")}) AS metro_share FROM sales GROUP BY 1)
SELECT coalesce(acq.year, act.year) AS year, CAST(coalesce(acq.new_customers, 0) AS BIGINT) AS new_customers,
       CAST(coalesce(act.active_customers, 0) AS BIGINT) AS active_customers, act.portfolio_skus, act.metro_share
FROM acq FULL OUTER JOIN act ON acq.year = act.year""", CUSTOMERS_CTE))
def l32_growth(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q5: new vs active customers (full outer align, D12), active SKUs and metro
    order share by year."""
    acq = build_customers(spark, d, ["acquisition_year"]).groupBy(F.col("acquisition_year").alias("year")).agg(
        F.count("*").alias("new_customers"))
    t = view(spark, d, ["order_year", "customer_id", "product_id", "customer_tier"], s)
    act = t.groupBy(F.col("order_year").alias("year")).agg(
        F.countDistinct("customer_id").alias("active_customers"),
        F.countDistinct("product_id").alias("portfolio_skus"),
        F.avg(flag(F.col("customer_tier") == "Metro")).alias("metro_share"))
    j = acq.join(act, "year", "full")
    return j.select("year", F.coalesce("new_customers", F.lit(0)).cast("long").alias("new_customers"),
                    F.coalesce("active_customers", F.lit(0)).cast("long").alias("active_customers"),
                    "portfolio_skus", "metro_share")


# ------------------------------------------------------------------ L33 Q6
def _grain(spark, d, grain, s=ALL):
    t = view(spark, d, ["order_year", "order_quarter", "order_date", AMT], s)
    if grain == "Yearly":
        p = F.col("order_year").cast("string")
    elif grain == "Quarterly":
        p = F.concat(F.col("order_year").cast("string"), F.lit("-Q"), F.col("order_quarter").cast("string"))
    else:
        p = F.date_format("order_date", "yyyy-MM")
    ts = t.groupBy(p.alias("period")).agg(msum(AMT).alias("revenue"))
    return period_change(ts, "revenue", "period", "growth", 100.0)


def _sql_grain(expr: str) -> str:
    return with_sales(f"""
ts AS (SELECT {expr} AS period, {MS} AS revenue FROM sales GROUP BY 1)
SELECT *, (revenue / NULLIF(lag(revenue) OVER (ORDER BY period), 0) - 1) * 100 AS growth FROM ts""")


@register("L33_revenue_monthly", _sql_grain("strftime(order_date, '%Y-%m')"))
def l33_monthly(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q6: monthly revenue and growth %."""
    return _grain(spark, d, "Monthly", s)


@register("L33_revenue_quarterly", _sql_grain("CAST(order_year AS VARCHAR) || '-Q' || CAST(order_quarter AS VARCHAR)"))
def l33_quarterly(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q6: quarterly revenue and growth %."""
    return _grain(spark, d, "Quarterly", s)


@register("L33_revenue_yearly", _sql_grain("CAST(order_year AS VARCHAR)"))
def l33_yearly(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q6: yearly revenue and growth %."""
    return _grain(spark, d, "Yearly", s)


# ------------------------------------------------------------------ L34 Q7
@register("L34_year_subcategory", with_sales(f"""
c AS (SELECT order_year, subcategory, {MS} AS revenue FROM sales GROUP BY ALL)
SELECT *, CASE WHEN order_year = max(order_year) OVER () THEN
          revenue / {sql_msum_over("revenue", "PARTITION BY order_year")} END AS latest_share FROM c"""))
def l34_year_sub(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q7: revenue by year x subcategory with the latest year's market share."""
    c = view(spark, d, ["order_year", "subcategory", AMT], s).groupBy("order_year", "subcategory").agg(
        msum(AMT).alias("revenue"))
    c = share_of(c, "revenue", ["order_year"], "_share", money=True)
    latest = c.agg(F.max("order_year").alias("_ly"))
    return c.crossJoin(F.broadcast(latest)).select(
        "order_year", "subcategory", "revenue",
        F.when(F.col("order_year") == F.col("_ly"), F.col("_share")).alias("latest_share"))


@register("L34_brand_drilldown", with_sales(f"""
pick AS (SELECT min(subcategory) AS s FROM sales)
SELECT brand, {MS} AS revenue FROM sales, pick WHERE subcategory = s GROUP BY 1
ORDER BY revenue DESC, brand LIMIT 12"""))
def l34_drill(spark: SparkSession, d: str, subcategory: str | None = None, s: Slice = ALL) -> DataFrame:
    """Q7: top 12 brands inside one subcategory (default: first in sort order)."""
    t = view(spark, d, ["subcategory", "brand", AMT], s)
    if subcategory is None:
        pick = t.agg(F.min("subcategory").alias("_s"))
        t = t.join(F.broadcast(pick), F.col("subcategory") == F.col("_s"), "left_semi")
    else:
        t = t.where(F.col("subcategory") == subcategory)
    b = t.groupBy("brand").agg(msum(AMT).alias("revenue"))
    return top_k(b, 12, "revenue", ["brand"])


# ------------------------------------------------------------------ L35 Q8
@register("L35_state_tier", with_sales(f"""
SELECT customer_state, customer_tier, {MS} AS revenue, count(*) AS orders FROM sales GROUP BY 1, 2"""))
def l35_state_tier(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q8: revenue and orders by state x tier."""
    return view(spark, d, ["customer_state", "customer_tier", AMT], s).groupBy("customer_state", "customer_tier").agg(
        msum(AMT).alias("revenue"), F.count("*").alias("orders"))


_LAT_MAP = {c: v[0] for c, v in config.CITY_COORDS.items()}
_LON_MAP = {c: v[1] for c, v in config.CITY_COORDS.items()}
_LAT = "CASE customer_city " + " ".join(f"WHEN '{c}' THEN {v}" for c, v in _LAT_MAP.items()) + " END"
_LON = "CASE customer_city " + " ".join(f"WHEN '{c}' THEN {v}" for c, v in _LON_MAP.items()) + " END"


@register("L35_city_revenue", with_sales(f"""
SELECT customer_city, {MS} AS revenue, CAST({_LAT} AS DOUBLE) AS lat, CAST({_LON} AS DOUBLE) AS lon
FROM sales GROUP BY 1"""))
def l35_city(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q8: city revenue with coordinates (cities without coordinates keep null
    lat/lon here; a map layer drops them)."""
    c = view(spark, d, ["customer_city", AMT], s).groupBy("customer_city").agg(msum(AMT).alias("revenue"))
    return c.select("*", lookup(_LAT_MAP, "customer_city").alias("lat"), lookup(_LON_MAP, "customer_city").alias("lon"))


# ------------------------------------------------------------------ L36 Q9
@register("L36_festival_kpis", with_sales(f"""
SELECT festival_name, {MS} AS revenue, count(*) AS orders, {MA} AS aov, avg(discount_percent) AS avg_discount
FROM sales WHERE is_festival_sale GROUP BY 1"""))
def l36_festival(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q9: festival revenue, orders, AOV, mean discount."""
    t = view(spark, d, ["is_festival_sale", "festival_name", "discount_percent", AMT], s)
    return t.where("is_festival_sale").groupBy("festival_name").agg(
        msum(AMT).alias("revenue"), F.count("*").alias("orders"), mavg(AMT).alias("aov"),
        F.avg("discount_percent").alias("avg_discount"))


@register("L36_festival_month_flag", with_sales(f"""
SELECT strftime(order_date, '%Y-%m') AS year_month, is_festival_sale, {MS} AS revenue FROM sales GROUP BY 1, 2"""))
def l36_month_flag(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q9: festival vs non-festival revenue by month."""
    t = view(spark, d, ["order_date", "is_festival_sale", AMT], s)
    return t.groupBy(F.date_format("order_date", "yyyy-MM").alias("year_month"), "is_festival_sale").agg(
        msum(AMT).alias("revenue"))


# ------------------------------------------------------------------ L37 Q10



@register("L37_discount_elasticity", with_sales(f"""
SELECT subcategory, {_SQL_DISC_BAND} AS disc_bin, CAST(sum(quantity) AS BIGINT) AS units, {MS} AS revenue,
       {MA} AS aov FROM sales WHERE {_SQL_DISC_BAND} IS NOT NULL GROUP BY 1, 2"""))
def l37_elasticity(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q10: units, revenue, AOV by subcategory x discount band."""
    t = view(spark, d, ["subcategory", "discount_percent", "quantity", AMT], s).withColumn(
        "disc_bin", band("discount_percent", config.DISCOUNT_BAND_EDGES, config.DISCOUNT_BAND_LABELS, open_end=True))
    return t.where(F.col("disc_bin").isNotNull()).groupBy("subcategory", "disc_bin").agg(
        F.sum("quantity").alias("units"), msum(AMT).alias("revenue"), mavg(AMT).alias("aov"))


@register("L37_product_price_units", with_sales("""
SELECT product_id, quantile_cont(discounted_price_inr, 0.5) AS price, CAST(sum(quantity) AS BIGINT) AS units,
       avg(discount_percent) AS discount, arg_min(subcategory, (order_date, transaction_id)) AS subcategory
FROM sales GROUP BY 1"""))
def l37_products(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q10: per product median price, units, mean discount, first subcategory."""
    t = view(spark, d, ["product_id", "discounted_price_inr", "quantity", "discount_percent", "subcategory",
                        "order_date", "transaction_id"], s)
    agg = t.groupBy("product_id").agg(
        F.sum("quantity").alias("units"), F.avg("discount_percent").alias("discount"),
        F.min_by("subcategory", F.struct("order_date", "transaction_id")).alias("subcategory"))
    med = exact_quantiles(t, "discounted_price_inr", [0.5], ["product_id"], "_p")
    return agg.join(med, "product_id").withColumnRenamed("_p0", "price")


# ------------------------------------------------------------------ L38 Q11
@register("L38_segment_table", with_sales(f"""
SELECT rfm_segment, count(*) AS customers, {sql_msum("monetary")} AS revenue, {sql_mavg("clv")} AS avg_clv,
       avg(recency_days) AS recency
FROM customers WHERE customer_id IN (SELECT customer_id FROM sales) GROUP BY 1""", CUSTOMERS_CTE))
def l38_segments(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q11: customers, revenue, mean CLV and recency per segment (active customers)."""
    return _active_customers(spark, d, ["rfm_segment", "monetary", "clv", "recency_days"], s).groupBy("rfm_segment").agg(
        F.count("*").alias("customers"), msum("monetary").alias("revenue"), mavg("clv").alias("avg_clv"),
        F.avg("recency_days").alias("recency"))


@register("L38_segment_top15", with_sales("""
pick AS (SELECT min(rfm_segment) AS s FROM customers)
SELECT customer_id, customer_city, customer_tier, monetary, frequency, recency_days, clv, rfm_action
FROM customers, pick WHERE rfm_segment = s ORDER BY monetary DESC, customer_id LIMIT 15""", CUSTOMERS_CTE))
def l38_top15(spark: SparkSession, d: str, segment: str | None = None, s: Slice = ALL) -> DataFrame:
    """Q11: playbook action and the 15 highest-spend customers of a segment
    (default: first segment in sort order)."""
    c = _active_customers(spark, d, ["customer_city", "customer_tier", "monetary", "frequency", "recency_days", "clv",
                                     "rfm_segment", "rfm_action"], s)
    if segment is None:
        pick = c.agg(F.min("rfm_segment").alias("_s"))
        c = c.join(F.broadcast(pick), F.col("rfm_segment") == F.col("_s"), "left_semi")
    else:
        c = c.where(F.col("rfm_segment") == segment)
    return top_k(c, 15, "monetary", ["customer_id"]).select(
        "customer_id", "customer_city", "customer_tier", "monetary", "frequency", "recency_days", "clv",
        "rfm_action")


# ------------------------------------------------------------------ L39 Q12
@register("L39_frequency_bands", with_sales("""
o AS (SELECT customer_id, count(*) AS n FROM sales GROUP BY 1),
b AS (SELECT CASE WHEN n > 0 AND n <= 1 THEN '1 order' WHEN n > 1 AND n <= 2 THEN '2'
                  WHEN n > 2 AND n <= 4 THEN '3-4' WHEN n > 4 AND n <= 8 THEN '5-8'
                  WHEN n > 8 THEN '9+' END AS band FROM o)
SELECT band, count(*) AS customers FROM b WHERE band IS NOT NULL GROUP BY 1"""))
def l39_bands(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q12: customers by order-count band."""
    o = view(spark, d, ["customer_id"], s).groupBy("customer_id").agg(F.count("*").alias("n"))
    b = o.select(band("n", config.FREQUENCY_BAND_EDGES, config.FREQUENCY_BAND_LABELS, open_end=True).alias("band"))
    return b.where(F.col("band").isNotNull()).groupBy("band").agg(F.count("*").alias("customers"))


@register("L39_switchers", with_sales("""
fl AS (SELECT customer_id, arg_min(subcategory, (order_date, transaction_id)) AS first_category,
              arg_max(subcategory, (order_date, transaction_id)) AS latest_category FROM sales GROUP BY 1)
SELECT first_category, latest_category, count(*) AS customers FROM fl
WHERE first_category <> latest_category GROUP BY 1, 2"""))
def l39_switchers(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q12: customers whose first and latest subcategory differ (E7, B9), by pair."""
    t = view(spark, d, ["customer_id", "subcategory", "order_date", "transaction_id"], s)
    k = F.struct("order_date", "transaction_id")
    fl = t.groupBy("customer_id").agg(F.min_by("subcategory", k).alias("first_category"),
                                      F.max_by("subcategory", k).alias("latest_category"))
    return fl.where(F.col("first_category") != F.col("latest_category")).groupBy(
        "first_category", "latest_category").agg(F.count("*").alias("customers"))


@register("L39_switchers_top40", with_sales("""
fl AS (SELECT customer_id, arg_min(subcategory, (order_date, transaction_id)) AS first_category,
              arg_max(subcategory, (order_date, transaction_id)) AS latest_category FROM sales GROUP BY 1)
SELECT first_category, latest_category, count(*) AS customers FROM fl
WHERE first_category <> latest_category GROUP BY 1, 2 ORDER BY customers DESC, first_category, latest_category LIMIT 40"""))
def l39_top(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q12: the 40 most frequent switches."""
    return top_k(l39_switchers(spark, d, s), 40, "customers", ["first_category", "latest_category"])


# ------------------------------------------------------------------ L40 Q13
@register("L40_prime_kpis", with_sales(f"""
SELECT is_prime_member, count(*) AS orders, {MS} AS revenue, {MA} AS aov, avg(delivery_days) AS delivery,
       avg(customer_rating) AS rating FROM sales GROUP BY 1"""))
def l40_prime(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q13: orders, revenue, AOV, delivery days, rating by prime flag."""
    t = view(spark, d, ["is_prime_member", "delivery_days", "customer_rating", AMT], s)
    return t.groupBy("is_prime_member").agg(
        F.count("*").alias("orders"), msum(AMT).alias("revenue"), mavg(AMT).alias("aov"),
        F.avg("delivery_days").alias("delivery"), F.avg("customer_rating").alias("rating"))


@register("L40_prime_yearly", with_sales(f"""
SELECT order_year, is_prime_member, {MA} AS aov, count(*) AS orders FROM sales GROUP BY 1, 2"""))
def l40_yearly(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q13: AOV and orders by year x prime flag."""
    t = view(spark, d, ["order_year", "is_prime_member", AMT], s)
    return t.groupBy("order_year", "is_prime_member").agg(mavg(AMT).alias("aov"), F.count("*").alias("orders"))


@register("L40_prime_retention", with_sales("""
SELECT is_prime_member, avg(frequency) AS mean_frequency FROM customers
WHERE customer_id IN (SELECT customer_id FROM sales) GROUP BY 1""", CUSTOMERS_CTE))
def l40_retention(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q13: mean order frequency of active customers by (ever-)prime flag."""
    return _active_customers(spark, d, ["is_prime_member", "frequency"], s).groupBy("is_prime_member").agg(F.avg("frequency").alias("mean_frequency"))


# ------------------------------------------------------------------ L41 Q14
@register("L41_retention_matrix", with_sales("""
first AS (SELECT customer_id, CAST(year(min(order_date)) AS INTEGER) AS acq_year FROM sales GROUP BY 1),
cells AS (SELECT acq_year, p.order_year - acq_year AS period, count(DISTINCT p.customer_id) AS customers
          FROM (SELECT DISTINCT customer_id, order_year FROM sales) p JOIN first USING (customer_id) GROUP BY ALL),
grid AS (SELECT acq_year, CAST(unnest(range(0, max(period) + 1)) AS INTEGER) AS period FROM cells GROUP BY 1),
dense AS (SELECT g.acq_year, g.period, CAST(coalesce(c.customers, 0) AS BIGINT) AS customers
          FROM grid g LEFT JOIN cells c USING (acq_year, period))
SELECT d.*, d.customers / NULLIF(b.customers, 0) AS retention
FROM dense d LEFT JOIN (SELECT acq_year, customers FROM dense WHERE period = 0) b USING (acq_year)"""))
def l41_retention(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q14: cohort retention matrix with zero-filled holes (J12 dashboard form)."""
    t = view(spark, d, ["customer_id", "order_date", "order_year"], s)
    return cohort_retention(t, "customer_id", "order_date", "order_year", fill_zero=True)


@register("L41_inactive_share", with_sales(f"""
SELECT avg({_f("last_order_date < (SELECT max(order_date) FROM sales) - 365")}) AS inactive_365_share
FROM customers WHERE customer_id IN (SELECT customer_id FROM sales)""", CUSTOMERS_CTE))
def l41_inactive(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q14: share of in-view customers inactive 365+ days."""
    snap = view(spark, d, ["order_date"], s).agg(F.max("order_date").alias("_snap"))
    c = _active_customers(spark, d, ["last_order_date"], s).crossJoin(F.broadcast(snap))
    return c.agg(F.avg(flag(F.col("last_order_date") < F.date_sub("_snap", config.CHURN_DAYS)))
                 .alias("inactive_365_share"))


# ------------------------------------------------------------------ L42 Q15
@register("L42_age_subcategory", with_sales(f"""
SELECT customer_age_group, subcategory, {MS} AS revenue FROM sales GROUP BY 1, 2"""))
def l42_age_sub(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q15: revenue by age band x subcategory."""
    t = view(spark, d, ["customer_age_group", "subcategory", AMT], s)
    return t.groupBy("customer_age_group", "subcategory").agg(msum(AMT).alias("revenue"))


@register("L42_tier_age_aov", with_sales(f"""
SELECT customer_tier, customer_age_group, {MA} AS aov FROM sales GROUP BY 1, 2"""))
def l42_tier_age(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q15: AOV by tier x age band."""
    t = view(spark, d, ["customer_tier", "customer_age_group", AMT], s)
    return t.groupBy("customer_tier", "customer_age_group").agg(mavg(AMT).alias("aov"))


# ------------------------------------------------------------------ L43 Q16
_SQL_PROD = f"""
prod AS (SELECT product_id, product_name, subcategory, brand, {MS} AS revenue, CAST(sum(quantity) AS BIGINT) AS units,
                round(avg(product_rating), 6) AS rating, avg(customer_rating) AS customer_rating,
                avg({_f("return_status = 'Returned'")}) AS return_rate
         FROM sales GROUP BY ALL)"""


def _products(spark, d, s=ALL):
    t = view(spark, d, ["product_id", "product_name", "subcategory", "brand", "quantity", "product_rating",
                        "customer_rating", "return_status", AMT], s)
    return t.groupBy("product_id", "product_name", "subcategory", "brand").agg(
        msum(AMT).alias("revenue"), F.sum("quantity").alias("units"),
        F.round(F.avg("product_rating"), 6).alias("rating"), F.avg("customer_rating").alias("customer_rating"),
        F.avg(flag(F.col("return_status") == "Returned")).alias("return_rate"))


@register("L43_product_rank", with_sales(_SQL_PROD + " SELECT * FROM prod ORDER BY revenue DESC, product_id LIMIT 25"))
def l43_rank(spark: SparkSession, d: str, metric: str = "revenue", s: Slice = ALL) -> DataFrame:
    """Q16: product table ranked by a metric, top 25 (ascending only for return_rate, G4)."""
    return top_k(_products(spark, d, s), 25, metric, ["product_id"], ascending=(metric == "return_rate"))


@register("L43_product_rank_by_return_rate", with_sales(_SQL_PROD + " SELECT * FROM prod ORDER BY return_rate ASC NULLS LAST, product_id LIMIT 25"))
def l43_returns(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q16: the 25 products with the least returns."""
    return l43_rank(spark, d, "return_rate", s)


@register("L43_product_rank_by_units", with_sales(_SQL_PROD + " SELECT * FROM prod ORDER BY units DESC, product_id LIMIT 25"))
def l43_units(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q16: the 25 products with the most units."""
    return l43_rank(spark, d, "units", s)


@register("L43_product_rank_by_rating", with_sales(_SQL_PROD + " SELECT * FROM prod ORDER BY rating DESC NULLS LAST, product_id LIMIT 25"))
def l43_rating(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q16: the 25 products with the best rating."""
    return l43_rank(spark, d, "rating", s)


@register("L43_top15_products", with_sales(_SQL_PROD + " SELECT product_name, subcategory, revenue FROM prod ORDER BY revenue DESC, product_id LIMIT 15"))
def l43_top15(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q16: the 15 products with the most revenue."""
    return top_k(_products(spark, d, s), 15, "revenue", ["product_id"]).select("product_name", "subcategory", "revenue")


# ------------------------------------------------------------------ L44 Q17
@register("L44_top8_brand_share", with_sales(f"""
top AS (SELECT brand FROM sales GROUP BY brand ORDER BY {MS} DESC, brand LIMIT 8),
yb AS (SELECT order_year, brand, {MS} AS revenue FROM sales WHERE brand IN (SELECT brand FROM top) GROUP BY ALL)
SELECT *, revenue / {sql_msum_over("revenue", "PARTITION BY order_year")} AS share FROM yb"""))
def l44_top8(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q17: top-8 brand revenue by year and share *within the eight*."""
    by = stored(view(spark, d, ["order_year", "brand", AMT], s).groupBy("order_year", "brand").agg(msum(AMT).alias("revenue")), "brand-years")
    top = top_k(by.groupBy("brand").agg(msum("revenue").alias("r")), 8, "r", ["brand"]).select("brand")
    of_top = by.join(F.broadcast(top), "brand", "left_semi").select("order_year", "brand", "revenue")
    return share_of(of_top, "revenue", ["order_year"], "share", money=True)


# ------------------------------------------------------------------ L45 Q18
@register("L45_monthly_demand", with_sales(f"""
SELECT strftime(order_date, '%Y-%m') AS year_month, subcategory, CAST(sum(quantity) AS BIGINT) AS units,
       {MS} AS revenue FROM sales GROUP BY 1, 2"""))
def l45_monthly(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q18: units and revenue by month x subcategory."""
    t = view(spark, d, ["order_date", "subcategory", "quantity", AMT], s)
    return t.groupBy(F.date_format("order_date", "yyyy-MM").alias("year_month"), "subcategory").agg(
        F.sum("quantity").alias("units"), msum(AMT).alias("revenue"))


@register("L45_velocity", with_sales("""
v AS (SELECT product_id, sum(quantity) AS units, max(order_date) - min(order_date) + 1 AS active_days
      FROM sales GROUP BY 1)
SELECT quantile_cont(units / greatest(active_days, 1), 0.5) AS median_units_per_day,
       count(*) AS products FROM v"""))
def l45_velocity(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q18: median units per active day across products."""
    t = view(spark, d, ["product_id", "quantity", "order_date"], s)
    v = t.groupBy("product_id").agg(
        F.sum("quantity").alias("units"),
        (F.datediff(F.max("order_date"), F.min("order_date")) + 1).alias("active_days"))
    v = v.withColumn("upd", F.col("units") / F.greatest("active_days", F.lit(1)))
    med = exact_quantiles(v, "upd", [0.5], name="_m")
    return med.crossJoin(F.broadcast(v.agg(F.count("*").alias("products")))).select(
        F.col("_m0").alias("median_units_per_day"), "products")


@register("L45_month_of_year_units", with_sales(
    "SELECT order_month, CAST(sum(quantity) AS BIGINT) AS units FROM sales GROUP BY 1"))
def l45_moy(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q18: units by calendar month (seasonal demand)."""
    return view(spark, d, ["order_month", "quantity"], s).groupBy("order_month").agg(F.sum("quantity").alias("units"))


# ------------------------------------------------------------------ L46 Q19
@register("L46_rated_products", with_sales(_SQL_PROD + """
SELECT product_id, rating, customer_rating, revenue FROM prod WHERE customer_rating IS NOT NULL"""))
def l46_rated(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q19: products with a customer rating vs revenue (rating histogram input)."""
    return _products(spark, d, s).where(F.col("customer_rating").isNotNull()).select(
        "product_id", "rating", "customer_rating", "revenue")


# ------------------------------------------------------------------ L47 Q20
_SQL_LAUNCH = """
fy AS (SELECT s.*, p.launch_year FROM sales s LEFT JOIN (SELECT DISTINCT product_id, launch_year FROM products) p
       USING (product_id) WHERE s.order_year = p.launch_year)"""


def _first_year(spark, d, s=ALL):
    t = view(spark, d, ["product_id", "product_name", "order_year", "subcategory", "quantity", "product_rating",
                        "order_date", "transaction_id", AMT], s)
    launch = catalog(spark, d).select("product_id", "launch_year").dropDuplicates()
    return t.join(launch, "product_id", "left").where(F.col("order_year") == F.col("launch_year"))


@register("L47_launch_performance", with_sales(_SQL_LAUNCH + f"""
SELECT launch_year, subcategory, {MS} AS first_year_revenue, CAST(sum(quantity) AS BIGINT) AS units,
       count(DISTINCT product_id) AS skus FROM fy GROUP BY 1, 2""", CATALOG_CTE))
def l47_launch(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q20: first-year revenue, units, SKUs by launch year x subcategory."""
    return _first_year(spark, d, s).groupBy("launch_year", "subcategory").agg(
        msum(AMT).alias("first_year_revenue"), F.sum("quantity").alias("units"),
        F.countDistinct("product_id").alias("skus"))


@register("L47_top_launches", with_sales(_SQL_LAUNCH + f"""
SELECT product_id, {MS} AS revenue, CAST(sum(quantity) AS BIGINT) AS units, round(avg(product_rating), 6) AS rating,
       arg_min(product_name, (order_date, transaction_id)) AS name
FROM fy GROUP BY 1 ORDER BY revenue DESC, product_id LIMIT 15""", CATALOG_CTE))
def l47_top(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q20: the 15 strongest launches by first-year revenue."""
    s = _first_year(spark, d, s).groupBy("product_id").agg(
        msum(AMT).alias("revenue"), F.sum("quantity").alias("units"),
        F.round(F.avg("product_rating"), 6).alias("rating"),
        F.min_by("product_name", F.struct("order_date", "transaction_id")).alias("name"))
    return top_k(s, 15, "revenue", ["product_id"])


# ------------------------------------------------------------------ L48 Q21
_SLA5 = "CASE delivery_type WHEN 'Same Day' THEN 1 WHEN 'Express' THEN 2 WHEN 'Standard' THEN 5 END"


def _ops(spark, d, cols, s=ALL):
    t = view(spark, d, list(dict.fromkeys(cols + ["delivery_days", "delivery_type"])), s)
    on_time = F.coalesce(F.col("delivery_days") <= lookup(config.SLA_OPERATIONS, "delivery_type"), F.lit(False))
    return t.withColumn("on_time", on_time)


@register("L48_delivery_kpis", with_sales(f"""
SELECT avg(delivery_days) AS avg_delivery_days, avg({_f(f"coalesce(delivery_days <= {_SLA5}, false)")}) AS on_time_share,
       avg({_f("delivery_type = 'Same Day'")}) AS same_day_share FROM sales"""))
def l48_kpis(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q21: mean delivery days, on-time share vs the operations SLA (Standard 5), same-day share."""
    t = _ops(spark, d, [], s)
    return t.agg(F.avg("delivery_days").alias("avg_delivery_days"), F.avg(flag("on_time")).alias("on_time_share"),
                 F.avg(flag(F.col("delivery_type") == "Same Day")).alias("same_day_share"))


@register("L48_delivery_geo", with_sales(f"""
SELECT customer_state, customer_tier, avg(delivery_days) AS avg_days,
       avg({_f(f"coalesce(delivery_days <= {_SLA5}, false)")}) AS on_time, count(*) AS orders
FROM sales GROUP BY 1, 2"""))
def l48_geo(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q21: delivery days and on-time share by state x tier."""
    t = _ops(spark, d, ["customer_state", "customer_tier"], s)
    return t.groupBy("customer_state", "customer_tier").agg(
        F.avg("delivery_days").alias("avg_days"), F.avg(flag("on_time")).alias("on_time"),
        F.count("*").alias("orders"))


@register("L48_days_by_type", with_sales(
    "SELECT delivery_type, delivery_days, count(*) AS orders FROM sales GROUP BY 1, 2"))
def l48_hist(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q21: delivery-days histogram by delivery type (I8)."""
    return view(spark, d, ["delivery_type", "delivery_days"], s).groupBy("delivery_type", "delivery_days").agg(
        F.count("*").alias("orders"))


# ------------------------------------------------------------------ L49 Q22
@register("L49_payment_mix", with_sales(
    "SELECT order_year, payment_method, count(*) AS orders FROM sales GROUP BY 1, 2"))
def l49_mix(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q22: orders by year x payment method."""
    return view(spark, d, ["order_year", "payment_method"], s).groupBy("order_year", "payment_method").agg(
        F.count("*").alias("orders"))


@register("L49_payment_groups", with_sales(f"""
SELECT payment_method_group, count(*) AS orders, {MS} AS revenue, {MA} AS aov FROM sales GROUP BY 1"""))
def l49_groups(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q22: orders, revenue, AOV by payment group."""
    t = view(spark, d, ["payment_method_group", AMT], s)
    return t.groupBy("payment_method_group").agg(F.count("*").alias("orders"), msum(AMT).alias("revenue"),
                                                 mavg(AMT).alias("aov"))


# ------------------------------------------------------------------ L50 Q23
@register("L50_returns_kpis", with_sales(f"""
SELECT avg({_f("return_status = 'Returned'")}) AS return_rate, avg({_f("return_status = 'Cancelled'")}) AS cancel_rate,
       coalesce((SUM(CASE WHEN return_status = 'Returned' THEN CAST(round(final_amount_inr * 100) AS BIGINT) END)
                 / 100), 0) AS returned_gmv
FROM sales"""))
def l50_kpis(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q23: return rate, cancel rate, returned GMV."""
    t = view(spark, d, ["return_status", AMT], s)
    ret = F.col("return_status") == "Returned"
    return t.agg(F.avg(flag(ret)).alias("return_rate"),
                 F.avg(flag(F.col("return_status") == "Cancelled")).alias("cancel_rate"),
                 F.coalesce(F.sum(F.when(ret, paise(AMT))) / 100.0, F.lit(0.0)).alias("returned_gmv"))


@register("L50_returns_by_subcategory", with_sales(f"""
SELECT subcategory, avg({_f("return_status = 'Returned'")}) AS return_rate,
       avg({_f("return_status = 'Cancelled'")}) AS cancel_rate,
       coalesce(SUM(CASE WHEN return_status = 'Returned' THEN CAST(round(final_amount_inr * 100) AS BIGINT) END)
                / 100, 0) AS returned_gmv
FROM sales GROUP BY 1"""))
def l50_by_sub(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q23: return / cancel rate and returned GMV (null -> 0, D13) by subcategory."""
    t = view(spark, d, ["subcategory", "return_status", AMT], s)
    ret = F.col("return_status") == "Returned"
    rates = t.groupBy("subcategory").agg(F.avg(flag(ret)).alias("return_rate"),
                                         F.avg(flag(F.col("return_status") == "Cancelled")).alias("cancel_rate"))
    gmv = t.where(ret).groupBy("subcategory").agg(msum(AMT).alias("_gmv"))
    return rates.join(gmv, "subcategory", "left").select(
        "subcategory", "return_rate", "cancel_rate", F.coalesce("_gmv", F.lit(0.0)).alias("returned_gmv"))


# ------------------------------------------------------------------ L51 Q24
@register("L51_csat_subcategory", with_sales(
    "SELECT subcategory, avg(customer_rating) AS mean_csat FROM sales WHERE customer_rating IS NOT NULL GROUP BY 1"))
def l51_sub(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q24: mean customer rating by subcategory over rated orders."""
    t = view(spark, d, ["subcategory", "customer_rating"], s).na.drop(subset=["customer_rating"])
    return t.groupBy("subcategory").agg(F.avg("customer_rating").alias("mean_csat"))


@register("L51_csat_tier", with_sales(
    "SELECT customer_tier, avg(customer_rating) AS mean_csat FROM sales WHERE customer_rating IS NOT NULL GROUP BY 1"))
def l51_tier(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q24: mean customer rating by tier."""
    t = view(spark, d, ["customer_tier", "customer_rating"], s).na.drop(subset=["customer_rating"])
    return t.groupBy("customer_tier").agg(F.avg("customer_rating").alias("mean_csat"))


@register("L51_csat_overall", with_sales(f"""
SELECT avg(customer_rating) AS overall_csat, avg({_f("customer_rating IS NOT NULL")}) AS rated_share FROM sales"""))
def l51_overall(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q24: overall CSAT and share of orders with a rating."""
    t = view(spark, d, ["customer_rating"], s)
    return t.agg(F.avg("customer_rating").alias("overall_csat"),
                 F.avg(flag(F.col("customer_rating").isNotNull())).alias("rated_share"))


# ------------------------------------------------------------------ L52 Q25
@register("L52_vendor_top15", with_sales(f"""
SELECT brand, count(*) AS orders, avg({_f(f"coalesce(delivery_days <= {_SLA5}, false)")}) AS on_time,
       avg(delivery_days) AS avg_days, avg({_f("return_status = 'Returned'")}) AS return_rate, {MS} AS revenue
FROM sales GROUP BY 1 ORDER BY revenue DESC, brand LIMIT 15"""))
def l52_vendor(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q25: brand as vendor proxy: orders, on-time, delivery, return rate, revenue (top 15)."""
    t = _ops(spark, d, ["brand", "return_status", AMT], s)
    v = t.groupBy("brand").agg(F.count("*").alias("orders"), F.avg(flag("on_time")).alias("on_time"),
                               F.avg("delivery_days").alias("avg_days"),
                               F.avg(flag(F.col("return_status") == "Returned")).alias("return_rate"),
                               msum(AMT).alias("revenue"))
    return top_k(v, 15, "revenue", ["brand"])


@register("L52_state_reliability", with_sales(f"""
SELECT customer_state, avg(delivery_days) AS avg_days,
       avg({_f(f"coalesce(delivery_days <= {_SLA5}, false)")}) AS on_time FROM sales GROUP BY 1"""))
def l52_state(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q25: delivery days and on-time share by state."""
    t = _ops(spark, d, ["customer_state"], s)
    return t.groupBy("customer_state").agg(F.avg("delivery_days").alias("avg_days"),
                                           F.avg(flag("on_time")).alias("on_time"))


# ------------------------------------------------------------------ L53 Q26
@register("L53_forecast", with_sales(_SQL_FORECAST))
def l53_forecast(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q26: linear monthly revenue forecast, 6-month horizon."""
    return _forecast(spark, d, s)


def _sql_newton(steps: int = 14) -> str:
    """SQL of the churn model: a recursion whose step sums the objective's
    gradient and curvature over the standardised customers and solves the six
    equations by elimination, one nested select a pivot."""
    k = 6
    z = "w[6]" + "".join(f" + w[{i + 1}] * x[{i + 1}]" for i in range(k - 1))
    sums = ", ".join([f"sum((p - y) * x[{i + 1}]) + {'' if i < k - 1 else '0 * '}any_value(w[{i + 1}]) AS a{i}_{k}" for i in range(k)]
                     + [f"sum(p * (1 - p) * x[{i + 1}] * x[{j + 1}]){' + 1' if i == j < k - 1 else ''} AS a{i}_{j}" for i in range(k) for j in range(k)])
    frame = f"SELECT it, any_value(w) AS w, {sums} FROM (SELECT it, w, x, y, 1 / (1 + exp(-({z}))) AS p FROM newton, churn_x WHERE it < {steps}) GROUP BY it"
    for q in range(k):  # the q-th unknown leaves the equations below
        done = [f"a{i}_{j}" for i in range(q + 1) for j in range(i, k + 1)]
        left = [f"a{i}_{j} - a{i}_{q} / a{q}_{q} * a{q}_{j} AS a{i}_{j}" for i in range(q + 1, k) for j in range(q + 1, k + 1)]
        frame = f"SELECT it, w, {', '.join(done + left)} FROM ({frame})"
    for q in reversed(range(k)):
        known = "".join(f" - a{q}_{j} * s{j}" for j in range(q + 1, k))
        frame = f"SELECT *, (a{q}_{k}{known}) / a{q}_{q} AS s{q} FROM ({frame})"
    step = ", ".join(f"w[{i + 1}] - s{i}" for i in range(k))
    cols = ["recency_days", "frequency", "monetary", "avg_order_value", "CAST(is_prime_member AS INTEGER)"]
    scaled = ", ".join(f"coalesce((v[{i + 1}] - avg(v[{i + 1}]) OVER ()) / nullif(stddev_pop(v[{i + 1}]) OVER (), 0), 0)" for i in range(k - 1))
    return f"""
churn_raw AS MATERIALIZED (SELECT customer_id, rfm_segment, CAST(last_order_date < (SELECT max(order_date) FROM sales) - 365 AS INTEGER) AS churned,
  [{", ".join(f"coalesce(CAST({c} AS DOUBLE), 0)" for c in cols)}] AS v FROM customers),
churn_ok AS MATERIALIZED (SELECT count(DISTINCT churned) = 2 AND count(*) > 200 AS ok, CASE WHEN count(*) > 200 THEN 'one class' ELSE 'too few customers' END AS why FROM churn_raw),
churn_x AS MATERIALIZED (SELECT customer_id, rfm_segment, churned, churned AS y, [{scaled}, 1] AS x FROM churn_raw),
newton AS (
  SELECT 0 AS it, [CAST(0 AS DOUBLE), 0, 0, 0, 0, 0] AS w
  UNION ALL SELECT it + 1, [{step}] FROM ({frame})),
churn_fit AS (SELECT w FROM newton ORDER BY it DESC LIMIT 1),
churn_p AS (SELECT customer_id, rfm_segment, churned, CASE WHEN ok THEN 1 / (1 + exp(-({z}))) END AS p, CASE WHEN ok THEN 'fitted' ELSE why END AS status
            FROM churn_x, churn_fit, churn_ok)"""


def _churned(spark, d, s, keep=()):
    from ledgerloom.operators.churn import FEATURES, churn_model

    snap = view(spark, d, ["order_date"], s).agg(F.max("order_date").alias("_snap"))
    return churn_model(_active_customers(spark, d, [*FEATURES, "last_order_date", *keep], s), snap, keep=keep)


@register("L53_churn_model", with_sales(_sql_newton() + """
SELECT customer_id, churned, round(p, 6) AS churn_prob, avg(CASE WHEN (p > 0.5) = (churned = 1) THEN CAST(1 AS DOUBLE)
       WHEN p IS NOT NULL THEN CAST(0 AS DOUBLE) END) OVER () AS accuracy, status FROM churn_p""", CUSTOMERS_CTE).replace("WITH ", "WITH RECURSIVE ", 1))
def l53_churn(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q26: churn probability per in-view customer."""
    return _churned(spark, d, s).withColumn("churn_prob", F.round("churn_prob", 6))


@register("L53_churn_histogram", with_sales(_sql_newton() + """
SELECT rfm_segment, CAST(least(floor(round(p, 6) * 20), 19) AS INTEGER) AS bin, count(*) AS customers FROM churn_p WHERE p IS NOT NULL GROUP BY 1, 2""",
                                            CUSTOMERS_CTE).replace("WITH ", "WITH RECURSIVE ", 1))
def l53_histogram(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q26: customers by RFM segment and bin of churn probability (20 equal bins of 0 to 1)."""
    p = _churned(spark, d, s, ("rfm_segment",)).where(F.col("churn_prob").isNotNull())
    return p.groupBy("rfm_segment", F.least(F.floor(F.round("churn_prob", 6) * 20), F.lit(19)).cast("int").alias("bin")).agg(F.count("*").alias("customers"))


# ------------------------------------------------------------------ L54 Q27
@register("L54_top6_brand_trend", with_sales(f"""
top AS (SELECT brand FROM sales GROUP BY brand ORDER BY {MS} DESC, brand LIMIT 6)
SELECT order_year, brand, {MS} AS revenue FROM sales WHERE brand IN (SELECT brand FROM top) GROUP BY 1, 2"""))
def l54_trend(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q27: yearly revenue of the top-6 brands."""
    t = view(spark, d, ["order_year", "brand", AMT], s)
    top = top_k(t.groupBy("brand").agg(msum(AMT).alias("r")), 6, "r", ["brand"]).select("brand")
    return t.join(F.broadcast(top), "brand", "left_semi").groupBy("order_year", "brand").agg(
        msum(AMT).alias("revenue"))


@register("L54_price_median_sub_brand", with_sales("""
SELECT subcategory, brand, quantile_cont(discounted_price_inr, 0.5) AS median_price FROM sales GROUP BY 1, 2"""))
def l54_price(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q27: median discounted price by subcategory x brand."""
    t = view(spark, d, ["subcategory", "brand", "discounted_price_inr"], s)
    return exact_quantiles(t, "discounted_price_inr", [0.5], ["subcategory", "brand"], "_m").withColumnRenamed(
        "_m0", "median_price")


# ------------------------------------------------------------------ L55 Q28
@register("L55_association_rules", with_sales("""
ei AS (SELECT DISTINCT customer_id, subcategory FROM sales),
n AS (SELECT count(DISTINCT customer_id) AS n FROM ei),
buyers AS (SELECT subcategory, count(*) AS b FROM ei GROUP BY 1),
both_ AS (SELECT a.subcategory AS "from", b.subcategory AS "to", count(*) AS both_n
          FROM ei a JOIN ei b ON a.customer_id = b.customer_id AND a.subcategory <> b.subcategory GROUP BY 1, 2),
grid AS (SELECT x.subcategory AS "from", y.subcategory AS "to" FROM buyers x, buyers y WHERE x.subcategory <> y.subcategory)
SELECT g."from", g."to", coalesce(both_n, 0) / n AS support,
       coalesce(both_n, 0) / buyers.b AS confidence
FROM grid g LEFT JOIN both_ USING ("from", "to") JOIN buyers ON buyers.subcategory = g."from", n
ORDER BY confidence DESC, g."from", g."to" LIMIT 12"""))
def l55_rules(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q28: subcategory association rules, top 12 by confidence."""
    r = association_rules(view(spark, d, ["customer_id", "subcategory"], s), "customer_id", "subcategory")
    return r.orderBy(F.col("confidence").desc(), "from", "to").limit(12)


# ------------------------------------------------------------------ L56 Q29
@register("L56_month_subcategory_units", with_sales(
    "SELECT order_month, subcategory, CAST(sum(quantity) AS BIGINT) AS units FROM sales GROUP BY 1, 2"))
def l56_units(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q29: units by calendar month x subcategory (demand calendar)."""
    return view(spark, d, ["order_month", "subcategory", "quantity"], s).groupBy("order_month", "subcategory").agg(
        F.sum("quantity").alias("units"))


@register("L56_month_festival_revenue", with_sales(f"""
SELECT order_month, festival_name, {MS} AS revenue FROM sales WHERE festival_name IS NOT NULL GROUP BY 1, 2"""))
def l56_festival(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q29: revenue by calendar month x festival (null festival dropped)."""
    t = view(spark, d, ["order_month", "festival_name", AMT], s).where(F.col("festival_name").isNotNull())
    return t.groupBy("order_month", "festival_name").agg(msum(AMT).alias("revenue"))


# ------------------------------------------------------------------ L57 Q30
_SQL_CC = _SQL_YEARLY + f""",
cc AS (SELECT {MS} AS revenue, count(DISTINCT customer_id) AS customers, {MA} AS aov,
              avg({_f("return_status = 'Returned'")}) AS return_rate, avg(delivery_days) AS avg_delivery_days
       FROM sales),
churn AS (SELECT avg({_f("last_order_date < (SELECT max(order_date) FROM sales) - 365")}) AS churn_share
          FROM customers WHERE customer_id IN (SELECT customer_id FROM sales))"""


def _command_centre(spark, d, s=ALL):
    """One scan of the slice, reduced to customers and years and stored, and
    one of the customers' last orders."""
    t = view(spark, d, ["order_year", "order_date", "customer_id", "return_status", "delivery_days", AMT], s)
    years = stored(_customer_years(
        t, returned=F.count_if(F.col("return_status") == "Returned"), statuses=F.count("return_status"), days=F.sum("delivery_days"),
        delivered=F.count("delivery_days"), last=F.max("order_date")), "customer-years")
    cc = _latest_and_total(
        years, return_rate=F.try_divide(F.sum("returned").cast("double"), F.sum("statuses")),
        avg_delivery_days=F.try_divide(F.sum("days").cast("double"), F.sum("delivered")))
    snap = years.agg(F.max("last").alias("_snap"))
    customers = build_customers(spark, d, ["last_order_date"])
    if s != ALL:
        customers = customers.join(years.select("customer_id").distinct(), "customer_id", "left_semi")
    churn = customers.crossJoin(F.broadcast(snap)).agg(
        F.avg(flag(F.col("last_order_date") < F.date_sub("_snap", config.CHURN_DAYS))).alias("churn_share"))
    return cc.crossJoin(F.broadcast(churn))


@register("L57_kpis", with_sales(_SQL_CC + """
SELECT cc.*, cur.revenue / NULLIF(prev.revenue, 0) - 1 AS revenue_yoy,
       cur.customers / NULLIF(prev.customers, 0) - 1 AS customers_yoy, cur.aov / NULLIF(prev.aov, 0) - 1 AS aov_yoy,
       churn.churn_share
FROM cc LEFT JOIN cur ON TRUE LEFT JOIN prev ON TRUE, churn""", CUSTOMERS_CTE))
def l57_kpis(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q30: command-centre KPIs with revenue YoY and churn share."""
    c = _command_centre(spark, d, s)
    return c.select("revenue", "customers", "aov", "return_rate", "avg_delivery_days",
                    _yoy("cur_revenue", "prev_revenue").alias("revenue_yoy"), _yoy("cur_customers", "prev_customers").alias("customers_yoy"),
                    _yoy("cur_aov", "prev_aov").alias("aov_yoy"), "churn_share")


@register("L57_alerts", with_sales(_SQL_CC + f"""
SELECT alert FROM (
  SELECT '{config.ALERT_TEXTS[0]}' AS alert
    FROM cur LEFT JOIN prev ON TRUE WHERE cur.revenue < coalesce(prev.revenue, 0)
  UNION ALL SELECT '{config.ALERT_TEXTS[1]}' FROM cc WHERE return_rate > 0.08
  UNION ALL SELECT '{config.ALERT_TEXTS[2]}' FROM cc WHERE avg_delivery_days > 4
  UNION ALL SELECT '{config.ALERT_TEXTS[3]}' FROM churn
    WHERE churn_share > 0.35)""", CUSTOMERS_CTE))
def l57_alerts(spark: SparkSession, d: str, s: Slice = ALL) -> DataFrame:
    """Q30: threshold alerts, one row per firing alert."""
    c = _command_centre(spark, d, s)
    checks = F.array(
        F.when(F.col("cur_revenue") < F.coalesce("prev_revenue", F.lit(0.0)),
               F.lit(config.ALERT_TEXTS[0])),
        F.when(F.col("return_rate") > config.ALERT_RETURN_RATE, F.lit(config.ALERT_TEXTS[1])),
        F.when(F.col("avg_delivery_days") > config.ALERT_DELIVERY_DAYS, F.lit(config.ALERT_TEXTS[2])),
        F.when(F.col("churn_share") > config.ALERT_CHURN_RATE,
               F.lit(config.ALERT_TEXTS[3])),
    )
    return c.select(F.explode(F.filter(checks, lambda x: x.isNotNull())).alias("alert"))


# ------------------------------------------------------------------ questions under a slice
_PICKS = {
    "years": (Slice(years=(1996, 1998)), "order_year BETWEEN 1996 AND 1998"),
    "prime_in_states": (Slice(states=("ASIA", "EUROPE"), prime="Prime"),
                        "customer_state IN ('ASIA', 'EUROPE') AND is_prime_member"),
    "festival": (Slice(festival="Festival only", prime="Non-Prime"), "is_festival_sale AND NOT is_prime_member"),
    "one_subcategory": (Slice(years=(1997, 1997), subcategories=("PROMO",), festival="Non-festival"),
                        "order_year = 1997 AND subcategory IN ('PROMO') AND NOT is_festival_sale"),
    "empty_lists": (Slice(years=(1995, 1996), subcategories=(), states=()), "order_year BETWEEN 1995 AND 1996"),
}
SLICED = {
    "L27_home_kpis": ("years", "prime_in_states"), "L28_exec_yearly": ("prime_in_states",),
    "L31_financials": ("festival",), "L38_segment_table": ("one_subcategory",), "L40_prime_kpis": ("empty_lists",),
    "L40_prime_retention": ("one_subcategory",), "L41_inactive_share": ("years",), "L43_product_rank": ("festival",),
    "L48_delivery_kpis": ("one_subcategory",), "L49_payment_mix": ("years",), "L51_csat_subcategory": ("prime_in_states",),
    "L57_kpis": ("years",),
}


def _sliced_sql(sql: str, where: str) -> str:
    """The same statement over a slice; the customer dimension stays global."""
    from ledgerloom.plans.oracle_sql import SALES_CTE

    whole = SALES_CTE.strip()
    everything = whole.replace("sales AS (", "all_sales AS (", 1)
    sql = sql.replace("FROM sales GROUP BY customer_id\n),\ncust_base", "FROM all_sales GROUP BY customer_id\n),\ncust_base")
    return sql.replace(whole, f"{everything},\nsales AS (SELECT * FROM all_sales WHERE {where})", 1)


def _register_sliced() -> None:
    from functools import partial

    from ledgerloom.plans.registry import ORACLES, QUERIES

    for name, picks in SLICED.items():
        for pick in picks:
            s, where = _PICKS[pick]
            register(f"{name}__{pick}", _sliced_sql(ORACLES[name], where))(partial(QUERIES[name], s=s))


_register_sliced()


@register("B2_filter_choices", with_sales("""
SELECT 'subcategory' AS filter, subcategory AS choice FROM (SELECT DISTINCT subcategory FROM sales)
UNION ALL SELECT 'state', customer_state FROM (SELECT DISTINCT customer_state FROM sales)
UNION ALL SELECT 'year', CAST(order_year AS VARCHAR) FROM (SELECT DISTINCT order_year FROM sales)"""))
def b2_choices(spark: SparkSession, d: str) -> DataFrame:
    """B2: what the slicer offers: subcategories, states and years in the data."""
    parts = [filter_choices(sales(spark, d, [c]).withColumn(c, F.col(c).cast("string")), c).select(
        F.lit(label).alias("filter"), F.col(c).alias("choice"))
        for label, c in (("subcategory", "subcategory"), ("state", "customer_state"), ("year", "order_year"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
