"""Raw-data profiles (K9-K12), integrity, descriptions, histograms and cleaning metrics.

Profiles of raw text run over the dirty fixture (``dirty_sales``), whose
forms are chosen by each line's day and month, so SQL over the clean view
states the same counts.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.exprs import inr_label, inr_scale, is_null_token, msum, pct_label
from ledgerloom.operators import cleaning as C
from ledgerloom.operators.histogram import histogram
from ledgerloom.operators.ranking import five_number
from ledgerloom.operators.shares import pivot_sum
from ledgerloom.plans.dirty import COPIES_SQL, DATE_CLASS_SQL, dirty_files, dirty_sales
from ledgerloom.plans.dims import build_customers
from ledgerloom.plans.oracle_sql import CUSTOMERS_CTE, sql_msum, with_sales
from ledgerloom.plans.registry import register
from ledgerloom.sources.tables import read_table, sales
from ledgerloom.session import stored
from ledgerloom.sources.warehouse import StoredWarehouse, register_views, run_sql, table_counts


def stacked(df: DataFrame, rows: list[tuple[str, Column]], names: tuple[str, str]) -> DataFrame:
    """One row of aggregates as (name, value) rows."""
    return df.select(F.inline(F.array(*[F.struct(F.lit(n).alias(names[0]), c.alias(names[1])) for n, c in rows])))


def _n(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _to_hundredths_of_paise(boxes: DataFrame) -> DataFrame:
    """Interpolated quantiles without the last binary digit, which engines round differently."""
    return boxes.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


# ------------------------------------------------------------------ D14
@register("D14_fk_integrity", """
SELECT 'lineitem_orders' AS "check", count(*) AS rows, count(*) FILTER (WHERE o_orderkey IS NULL) AS orphans
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'lineitem_part', count(*), count(*) FILTER (WHERE p_partkey IS NULL) FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
UNION ALL SELECT 'orders_customer', count(*), count(*) FILTER (WHERE c_custkey IS NULL) FROM orders LEFT JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'customer_nation', count(*), count(*) FILTER (WHERE n_nationkey IS NULL) FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def d14(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose foreign key has no partner.  Keys are counted first
    (map-side), so a hot key joins as one row."""
    parts = []
    for child, fk, parent, pk in (("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
                                  ("orders", "o_custkey", "customer", "c_custkey"), ("customer", "c_nationkey", "nation", "n_nationkey")):
        keys = read_table(spark, d, child).groupBy(fk).agg(F.count("*").alias("n"))
        have = read_table(spark, d, parent).select(pk).distinct().withColumn("there", F.lit(True))
        parts.append(keys.join(have, F.col(fk) == F.col(pk), "left").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("there").isNull(), F.col("n"))), F.lit(0)).alias("orphans"),
        ).select(F.lit(f"{child}_{parent}").alias("check"), "rows", "orphans"))
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ E14
_DESCRIBED = ["discounted_price_inr", "final_amount_inr", "quantity", "delivery_days", "discount_percent", "customer_rating"]


@register("E14_describe", with_sales(" UNION ALL ".join(f"""
SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q1, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS median,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q3, CAST(max({c}) AS DOUBLE) AS max FROM sales""" for c in _DESCRIBED)))
def e14(spark: SparkSession, d: str) -> DataFrame:
    """Count, mean, deviation and the five numbers of each numeric column."""
    long = sales(spark, d, _DESCRIBED).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in _DESCRIBED])))
    moments = long.groupBy("column").agg(F.count("v").alias("count"), F.round(F.avg("v"), 6).alias("mean"),
                                         F.round(F.stddev_samp("v"), 4).alias("std"))
    return moments.join(_to_hundredths_of_paise(five_number(long, "v", ["column"])), "column")


# ------------------------------------------------------------------ E16
@register("E16_varying_columns", with_sales("""
g AS (SELECT count(*) AS n FROM sales WHERE customer_id % 50 = 0)
SELECT unnest(['transaction_id', 'source_file', 'order_month', 'customer_city', 'payment_method', 'customer_rating']) AS column,
       unnest([n, n, 0, 0, 0, 0]) AS groups FROM g"""))
def e16(spark: SparkSession, d: str) -> DataFrame:
    """Duplicate-key groups in which a column takes more than one value.
    A group's texts are compared by their 64-bit hashes: least and greatest are
    numbers then, so groups are hashed, not sorted, and no text travels but the key."""
    cols = ["transaction_id", "source_file", "order_month", "customer_city", "payment_method", "customer_rating"]
    rows = dirty_sales(spark, d).select(*C.DUP_KEY, *[F.xxhash64(F.coalesce(c, F.lit(""))).alias(f"h_{c}") for c in cols])
    groups = rows.groupBy(*C.DUP_KEY).agg(F.count("*").alias("n"), *[(F.min(f"h_{c}") != F.max(f"h_{c}")).alias(c) for c in cols])
    return stacked(groups.where("n > 1").agg(*[_n(F.col(c)).alias(c) for c in cols]), [(c, F.col(c)) for c in cols], ("column", "groups"))


@register("K08_group_sizes", with_sales("""
SELECT CAST(size AS BIGINT) AS size, count(*) AS groups FROM (
  SELECT CASE WHEN customer_id % 50 = 0 THEN 3 ELSE 1 END AS size FROM sales) GROUP BY 1"""))
def k08_sizes(spark: SparkSession, d: str) -> DataFrame:
    """K8: business-key groups of the dirty rows by their size."""
    return dirty_sales(spark, d).groupBy(*C.DUP_KEY).agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("groups"))


# ------------------------------------------------------------------ K9
@register("K09_numeric_profile", with_sales(f"""
r AS (SELECT *, {COPIES_SQL} AS w FROM sales)
SELECT 'quantity' AS column, CAST(sum(CASE WHEN quantity = 1 THEN w ELSE 0 END) AS BIGINT) AS blank,
       CAST(sum(CASE WHEN quantity <> 1 THEN w ELSE 0 END) AS BIGINT) AS numeric_rows, CAST(0 AS BIGINT) AS other,
       CAST(min(quantity) FILTER (WHERE quantity <> 1) AS DOUBLE) AS min, CAST(max(quantity) FILTER (WHERE quantity <> 1) AS DOUBLE) AS max FROM r
UNION ALL SELECT 'delivery_charges', CAST(sum(CASE WHEN order_day % 9 = 0 THEN w ELSE 0 END) AS BIGINT),
       CAST(sum(CASE WHEN order_day % 9 <> 0 THEN w ELSE 0 END) AS BIGINT), 0,
       min(delivery_charges) FILTER (WHERE order_day % 9 <> 0), max(delivery_charges) FILTER (WHERE order_day % 9 <> 0) FROM r
UNION ALL SELECT 'final_amount_inr', 0, CAST(sum(w) AS BIGINT), 0, min(final_amount_inr), max(final_amount_inr) FROM r
UNION ALL SELECT 'original_price_inr', 0, CAST(sum(CASE WHEN order_day % 7 IN (0, 3, 4, 5) THEN w ELSE 0 END) AS BIGINT),
       CAST(sum(CASE WHEN order_day % 7 IN (1, 2, 6) THEN w ELSE 0 END) AS BIGINT),
       round(min(CASE order_day % 7 WHEN 0 THEN 1 WHEN 3 THEN -1 WHEN 4 THEN 10 WHEN 5 THEN 100 END * original_price_inr), 2),
       round(max(CASE order_day % 7 WHEN 0 THEN 1 WHEN 3 THEN -1 WHEN 4 THEN 10 WHEN 5 THEN 100 END * original_price_inr), 2) FROM r"""))
def k09(spark: SparkSession, d: str) -> DataFrame:
    """K9: blank, numeric and other texts of the numeric columns, with the range."""
    cols = ["quantity", "delivery_charges", "final_amount_inr", "original_price_inr"]
    long = dirty_sales(spark, d).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("t")) for c in cols])))
    blank, number = is_null_token("t"), C._num(F.col("t"))
    return long.select("column", blank.alias("blank"), number.alias("v")).groupBy("column").agg(
        _n(F.col("blank")).alias("blank"), F.count("v").alias("numeric_rows"), _n(~F.col("blank") & F.col("v").isNull()).alias("other"),
        F.round(F.min("v"), 2).alias("min"), F.round(F.max("v"), 2).alias("max"))


# ------------------------------------------------------------------ K10
@register("K10_date_ambiguity", with_sales(f"""
r AS (SELECT *, {COPIES_SQL} AS w, (order_day + order_month) % 7 AS f FROM sales)
SELECT CASE WHEN order_day > 12 THEN CASE f WHEN 2 THEN 'day_first' ELSE 'month_first' END
            WHEN order_day = order_month THEN 'either' ELSE 'ambiguous' END AS reading,
       CAST(sum(w) AS BIGINT) AS rows,
       CAST(sum(CASE WHEN order_day > 12 OR order_day = order_month THEN 0 ELSE w END) AS BIGINT) AS with_hint
FROM r WHERE f IN (2, 3) GROUP BY 1"""))
def k10(spark: SparkSession, d: str) -> DataFrame:
    """Slash dates by what their numbers allow, and those that a month hint comes with."""
    raw = dirty_sales(spark, d).where(F.trim("order_date").rlike(C.SLASH_RE))
    a, b = (F.get(F.split(F.trim("order_date"), "/"), i).cast("int") for i in (0, 1))
    reading = F.when(a > 12, "day_first").when(b > 12, "month_first").when(a == b, "either").otherwise("ambiguous")
    return raw.groupBy(reading.alias("reading")).agg(F.count("*").alias("rows"), _n(C._num(F.col("order_month")).isNotNull()).alias("with_hint"))


# ------------------------------------------------------------------ K11
@register("K11_price_evidence", with_sales(f"""
r AS (SELECT CASE order_day % 7 WHEN 4 THEN 'times_10' WHEN 5 THEN 'times_100' WHEN 6 THEN 'no_number' ELSE 'fits' END AS evidence,
             order_day % 7 = 3 AS negative, {COPIES_SQL} AS w FROM sales)
SELECT evidence, CAST(sum(w) AS BIGINT) AS rows, CAST(sum(CASE WHEN negative THEN w ELSE 0 END) AS BIGINT) AS negative FROM r GROUP BY 1"""))
def k11(spark: SparkSession, d: str) -> DataFrame:
    """List prices against the discount identity: their ratio's band, and negatives."""
    # the numbers are columns of their own, so each text is parsed once however often its number is used
    raw = dirty_sales(spark, d).select(C.parse_price("original_price_inr").alias("price"), C.parse_price("discounted_price_inr").alias("sold"),
                                       C._num(F.col("discount_percent")).alias("pct"))
    price, sold, pct = F.col("price"), F.col("sold"), F.col("pct")
    ratio = F.abs(price) / (sold / (1 - pct / 100))
    band = F.when(price.isNull(), "no_number").when(ratio.between(50, 500), "times_100").when(ratio.between(5, 20), "times_10").otherwise("fits")
    return raw.select(band.alias("evidence"), (price < 0).alias("neg")).groupBy("evidence").agg(
        F.count("*").alias("rows"), _n(F.col("neg")).alias("negative"))


# ------------------------------------------------------------------ K12
@register("K12_delivery_crosstab", with_sales(f"""
r AS (SELECT *, {COPIES_SQL} AS w, CASE order_day % 6 WHEN 0 THEN CAST(delivery_days AS VARCHAR)
        WHEN 1 THEN CASE WHEN delivery_type = 'Same Day' THEN 'Same Day' ELSE CAST(delivery_days AS VARCHAR) END
        WHEN 2 THEN CASE WHEN delivery_type = 'Express' THEN 'express' ELSE CAST(delivery_days AS VARCHAR) END
        WHEN 3 THEN '1-2 days' WHEN 4 THEN '-1' ELSE '0' END AS delivery_text FROM sales)
SELECT delivery_text, delivery_type, CAST(sum(w) AS BIGINT) AS rows FROM r GROUP BY 1, 2"""))
def k12_crosstab(spark: SparkSession, d: str) -> DataFrame:
    """Raw delivery text x type."""
    return dirty_sales(spark, d).groupBy(F.col("delivery_days").alias("delivery_text"), "delivery_type").agg(F.count("*").alias("rows"))


@register("K12_charges_by_prime", with_sales(f"""
r AS (SELECT *, {COPIES_SQL} AS w FROM sales)
SELECT is_prime_member, CAST(sum(w) AS BIGINT) AS rows, CAST(sum(CASE WHEN order_day % 9 = 0 THEN w ELSE 0 END) AS BIGINT) AS blank,
       CAST(sum(CASE WHEN order_day % 9 <> 0 THEN w * CAST(round(delivery_charges * 100) AS BIGINT) ELSE 0 END) AS BIGINT) / 100 AS charged,
       min(delivery_charges) FILTER (WHERE order_day % 9 <> 0) AS least, max(delivery_charges) FILTER (WHERE order_day % 9 <> 0) AS most
FROM r GROUP BY 1"""))
def k12_charges(spark: SparkSession, d: str) -> DataFrame:
    """Delivery charges by prime flag: blanks, sum and range."""
    raw = dirty_sales(spark, d).select(C.parse_bool("is_prime_member").alias("is_prime_member"), C.parse_price("delivery_charges").alias("v"))
    return raw.groupBy("is_prime_member").agg(
        F.count("*").alias("rows"), _n(F.col("v").isNull()).alias("blank"),
        (F.sum(F.round(F.col("v") * 100).cast("long")) / 100).alias("charged"), F.min("v").alias("least"), F.max("v").alias("most"))


# ------------------------------------------------------------------ C13 metrics
def cleaning_metrics(raw: DataFrame) -> DataFrame:
    """What each cleaning rule finds, as (metric, value) rows.

    Row-wise rules are one aggregate over the raw rows, by the texts whose
    distinct values are counted; duplicates are a second one by key.  The
    values are what a report of the run holds."""
    # what several counts are taken from: columns of their own, worked out once a row
    parsed = C.with_order_date(raw, "_date").withColumns({
        "_form": F.coalesce(C._date_class(F.trim("order_date")), F.lit("other")),
        "_price": C.parse_price("original_price_inr"), "_sold": C.parse_price("discounted_price_inr"),
        "_off": F.least(F.greatest(C._num(F.col("discount_percent")), F.lit(0.0)), F.lit(99.99))})
    price, text = F.col("_price"), F.trim("original_price_inr")
    ratio = F.abs(price) / (F.col("_sold") / (1 - F.col("_off") / 100))
    rows = [("rows_before", F.count("*")), ("dates_unparsed", _n(F.col("_date").isNull()))]
    rows += [(f"dates_{k}", _n(F.col("_form") == k)) for k in ("iso", "slash", "dash", "dash_yy", "other")]
    rows += [("prices_currency", _n(text.rlike("(?i)₹|rs|inr"))), ("prices_negative", _n(price < 0)), ("prices_missing", _n(price.isNull())),
             ("prices_divided_by_100", _n(ratio.between(50, 500))), ("prices_divided_by_10", _n(ratio.between(5, 20))),
             ("ratings_missing", _n(C.parse_rating("customer_rating").isNull())),
             ("ratings_not_plain", _n(~is_null_token("customer_rating") & C._num(F.col("customer_rating")).isNull())),
             ("flags_blank", _n(is_null_token("is_prime_member"))),
             ("ids_marked_dup", _n(F.col("transaction_id").endswith("_DUP"))), ("ages_missing", _n(is_null_token("customer_age_group")))]
    groups = parsed.groupBy("category", "payment_method").agg(*[c.cast("long").alias(n) for n, c in rows])
    distinct = [("categories_before", F.count_distinct("category")), ("categories_after", F.count_distinct(C.standardise_category("category"))),
                ("payments_after", F.count_distinct(C.standardise_payment("payment_method")))]
    one = groups.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n, _ in rows], *[c.cast("long").alias(n) for n, c in distinct])
    rows += distinct
    keys = raw.where(~F.coalesce(F.col("transaction_id").endswith("_DUP"), F.lit(False))).groupBy(*C.DUP_KEY).agg(F.count("*").alias("n"))
    two = keys.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("key_duplicates_removed"), F.count("*").alias("rows_after"))
    return stacked(one.crossJoin(F.broadcast(two)), [(n, F.col(n)) for n in [*(n for n, _ in rows), "key_duplicates_removed", "rows_after"]], ("metric", "value"))


#: What ``cleaning_metrics`` reads.
_METRIC_COLUMNS = ["transaction_id", *C.DUP_KEY, "order_month", "order_year", "original_price_inr", "discounted_price_inr", "discount_percent", "customer_rating",
                   "is_prime_member", "category", "payment_method", "customer_age_group"]


@register("C13_metrics", with_sales(f"""
r AS (SELECT *, {COPIES_SQL} AS w, {DATE_CLASS_SQL} AS dc FROM sales),
m AS (SELECT sum(w) AS rows_before, 0 AS dates_unparsed, sum(w) FILTER (WHERE dc = 'iso') AS dates_iso, sum(w) FILTER (WHERE dc = 'slash') AS dates_slash,
  sum(w) FILTER (WHERE dc = 'dash') AS dates_dash, sum(w) FILTER (WHERE dc = 'dash_yy') AS dates_dash_yy, sum(w) FILTER (WHERE dc = 'other') AS dates_other,
  sum(w) FILTER (WHERE order_day % 7 IN (1, 2)) AS prices_currency, sum(w) FILTER (WHERE order_day % 7 = 3) AS prices_negative,
  sum(w) FILTER (WHERE order_day % 7 = 6) AS prices_missing, sum(w) FILTER (WHERE order_day % 7 = 5) AS prices_divided_by_100,
  sum(w) FILTER (WHERE order_day % 7 = 4) AS prices_divided_by_10, sum(w) FILTER (WHERE customer_rating IS NULL) AS ratings_missing,
  sum(w) FILTER (WHERE customer_rating IS NOT NULL AND order_day % 4 <> 0) AS ratings_not_plain,
  sum(w) FILTER (WHERE NOT is_prime_member AND order_day % 7 = 6) AS flags_blank, count(DISTINCT order_day % 5) AS categories_before, 1 AS categories_after,
  count(DISTINCT payment_method) AS payments_after, sum(CASE WHEN w = 3 THEN 1 ELSE 0 END) AS ids_marked_dup,
  sum(w) FILTER (WHERE order_day % 4 = 0) AS ages_missing, sum(CASE WHEN w = 3 THEN 1 ELSE 0 END) AS key_duplicates_removed, count(*) AS rows_after FROM r)
SELECT metric, CAST(coalesce(value, 0) AS BIGINT) AS value FROM (SELECT COLUMNS(*)::BIGINT FROM m) UNPIVOT INCLUDE NULLS (value FOR metric IN (*))"""))
def c13_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The metrics of a cleaning run over the dirty rows."""
    return cleaning_metrics(dirty_files(spark, d, _METRIC_COLUMNS))


# ------------------------------------------------------------------ I8
def _sql_hist(source: str, value: str, bins: int) -> str:
    return f"""
h AS (SELECT CAST({value} AS DOUBLE) AS v FROM {source}), e AS (SELECT min(v) AS lo, max(v) AS hi FROM h),
b AS (SELECT CAST(least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INTEGER) AS bin, lo, hi FROM h, e WHERE v IS NOT NULL)
SELECT bin, round(lo + bin * ((hi - lo) / {bins}), 6) AS low, round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) AS high, count(*) AS rows
FROM b GROUP BY bin, lo, hi"""


def _rounded(h: DataFrame) -> DataFrame:
    return h.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@register("L20_clv_histogram", with_sales(_sql_hist("customers", "round(log10(greatest(clv, 1)), 9)", 40), CUSTOMERS_CTE))
def l20_histogram(spark: SparkSession, d: str) -> DataFrame:
    """q14: customers in 40 equal bins of log10 CLV."""
    c = build_customers(spark, d, ["clv"]).select(F.round(F.log10(F.greatest("clv", F.lit(1.0))), 9).alias("v"))
    return _rounded(histogram(c, "v", 40))


@register("L22_rating_histogram", with_sales("""
p AS (SELECT product_id, round(avg(product_rating), 6) AS rating FROM sales GROUP BY 1),""" + _sql_hist("p", "rating", 20)))
def l22_histogram(spark: SparkSession, d: str) -> DataFrame:
    """q16 / Q19: products in 20 equal bins of their rating."""
    p = sales(spark, d, ["product_id", "product_rating"]).groupBy("product_id").agg(F.round(F.avg("product_rating"), 6).alias("rating"))
    return _rounded(histogram(p, "rating", 20))


@register("L54_price_boxes", with_sales("""
SELECT brand, min(discounted_price_inr) AS min, round(quantile_cont(discounted_price_inr, 0.25), 4) AS q1,
       round(quantile_cont(discounted_price_inr, 0.5), 4) AS median, round(quantile_cont(discounted_price_inr, 0.75), 4) AS q3,
       max(discounted_price_inr) AS max FROM sales GROUP BY 1"""))
def l54_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Q27: box numbers of the discounted price by brand."""
    return _to_hundredths_of_paise(five_number(sales(spark, d, ["brand", "discounted_price_inr"]), "discounted_price_inr", ["brand"]))


# ------------------------------------------------------------------ L53 labels and features
@register("L53_churn_features", with_sales("""
SELECT customer_id, CAST(last_order_date < (SELECT max(order_date) FROM sales) - 365 AS INTEGER) AS churned, recency_days,
       frequency, monetary, avg_order_value, is_prime_member FROM customers""", CUSTOMERS_CTE))
def l53_features(spark: SparkSession, d: str) -> DataFrame:
    """Q26: the churn label (J10) and the model's features, per customer."""
    from ledgerloom import config
    from ledgerloom.operators.churn import FEATURES

    snap = sales(spark, d, ["order_date"]).agg(F.max("order_date").alias("_snap"))
    c = build_customers(spark, d, [*FEATURES, "last_order_date"]).crossJoin(F.broadcast(snap))
    return c.select("customer_id", (F.col("last_order_date") < F.date_sub("_snap", config.CHURN_DAYS)).cast("int").alias("churned"), *FEATURES)


# ------------------------------------------------------------------ A7, A8, G1, H3, I10
@register("A7_warehouse_counts", with_sales("""
SELECT 'products' AS table_name, (SELECT count(*) FROM part) AS row_count
UNION ALL SELECT 'time_dimension', max(order_date) - min(order_date) + 1 FROM sales
UNION ALL SELECT 'transactions', count(*) FROM sales"""))
def a7(spark: SparkSession, d: str) -> DataFrame:
    """Row counts of the warehouse views."""
    register_views(spark, d, transactions=["transaction_id"], products=True, time_dimension=True)
    return table_counts(spark, ["transactions", "products", "time_dimension"])


def _stored(spark: SparkSession, d: str, columns: list[str]) -> StoredWarehouse:
    return StoredWarehouse(spark, f"w{uuid.uuid4().hex}_").store(d, columns)


@register("A7_stored_counts", with_sales("""
SELECT 'products' AS table_name, (SELECT count(*) FROM part) AS row_count
UNION ALL SELECT 'time_dimension', max(order_date) - min(order_date) + 1 FROM sales
UNION ALL SELECT 'transactions', count(*) FROM sales
UNION ALL SELECT 'customers', count(DISTINCT customer_id) FROM sales"""))
def a7_stored(spark: SparkSession, d: str) -> DataFrame:
    """The star schema written as bucketed, partitioned tables, and their rows counted."""
    house = _stored(spark, d, ["transaction_id"])
    out = stored(house.counts(), "counts")
    house.forget()
    return out


@register("A7_stored_segment_years", with_sales(f"""
SELECT rfm_segment, order_year, {sql_msum("final_amount_inr")} AS revenue, count(DISTINCT customer_id) AS buyers
FROM sales JOIN customers USING (customer_id) GROUP BY 1, 2""", CUSTOMERS_CTE))
def a7_segments(spark: SparkSession, d: str) -> DataFrame:
    """Stored transactions and customers joined bucket by bucket, by SQL."""
    house = _stored(spark, d, ["final_amount_inr"])
    out = stored(run_sql(spark, f"""
        SELECT rfm_segment, order_year, SUM(CAST(ROUND(final_amount_inr * 100) AS BIGINT)) / 100 AS revenue, COUNT(DISTINCT customer_id) AS buyers
        FROM {house.name("transactions")} JOIN {house.name("customers")} USING (customer_id) GROUP BY rfm_segment, order_year"""), "segments")
    house.forget()
    return out


@register("A7_replaced_year", with_sales("""
SELECT order_year, count(*) AS rows FROM sales WHERE order_year <> 1997 OR is_prime_member GROUP BY 1"""))
def a7_replaced(spark: SparkSession, d: str) -> DataFrame:
    """One year of the stored transactions replaced by its prime orders; the other years' files stay."""
    house = _stored(spark, d, ["is_prime_member"])
    prime = stored(house.table("transactions").where("order_year = 1997 AND is_prime_member"), "year")
    house.replace_years(prime)
    out = stored(house.table("transactions").groupBy("order_year").agg(F.count("*").alias("rows")), "years")
    house.forget()
    return out


@register("A8_parameterised_sql", with_sales(f"""
SELECT subcategory, {sql_msum("final_amount_inr")} AS revenue, count(*) AS orders FROM sales
WHERE order_year = 1997 AND customer_state = 'ASIA' GROUP BY 1"""))
def a8(spark: SparkSession, d: str, year: int = 1997, state: str = "ASIA") -> DataFrame:
    """A statement with named parameters, bound when it runs."""
    register_views(spark, d, transactions=["subcategory", "final_amount_inr", "order_year", "customer_state"])
    return run_sql(spark, """
        SELECT subcategory, SUM(CAST(ROUND(final_amount_inr * 100) AS BIGINT)) / 100 AS revenue, COUNT(*) AS orders
        FROM transactions WHERE order_year = :year AND customer_state = :state GROUP BY subcategory""", {"year": year, "state": state})


@register("G1_ordered_transactions", with_sales(
    "SELECT order_date, transaction_id, final_amount_inr FROM sales ORDER BY order_date, transaction_id"))
def g1(spark: SparkSession, d: str) -> DataFrame:
    """G1: all transactions by (date, id): a range-partitioned global sort."""
    return sales(spark, d, ["order_date", "transaction_id", "final_amount_inr"]).orderBy("order_date", "transaction_id")


_SUBCATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@register("H3_pivot_year_subcategory", with_sales("SELECT order_year, " + ", ".join(
    f"coalesce(CAST(sum(CASE WHEN subcategory = '{c}' THEN quantity END) AS BIGINT), 0) AS \"{c}\"" for c in _SUBCATEGORIES) + " FROM sales GROUP BY 1"))
def h3(spark: SparkSession, d: str) -> DataFrame:
    """H3: units by year and subcategory, wide."""
    return pivot_sum(sales(spark, d, ["order_year", "subcategory", "quantity"]), "order_year", "subcategory", "quantity", _SUBCATEGORIES, 0)


@register("I10_money_labels", with_sales(f"""
y AS (SELECT order_year, {sql_msum("final_amount_inr")} AS r FROM sales GROUP BY 1),
c AS (SELECT *, lag(r) OVER (ORDER BY order_year) AS p FROM y)
SELECT order_year, CASE WHEN abs(r) >= 1e7 THEN 'Cr' WHEN abs(r) >= 1e5 THEN 'L' ELSE '' END AS unit,
       CASE WHEN abs(r) >= 1e7 THEN '₹' || format('{{:,.1f}}', r / 1e7) || ' Cr' WHEN abs(r) >= 1e5 THEN '₹' || format('{{:,.1f}}', r / 1e5) || ' L'
            ELSE '₹' || format('{{:,.0f}}', r) END AS label,
       CASE WHEN p <> 0 THEN format('{{:+.1f}}', (r / p - 1) * 100) || '%' END AS change
FROM c"""))
def i10(spark: SparkSession, d: str) -> DataFrame:
    """Yearly revenue as display labels with the change on the year before."""
    y = sales(spark, d, ["order_year", "final_amount_inr"]).groupBy("order_year").agg(msum("final_amount_inr").alias("r"))
    y = y.withColumn("p", F.lag("r").over(Window.orderBy("order_year")))  # one row a year
    return y.select("order_year", inr_scale("r").alias("unit"), inr_label("r").alias("label"), pct_label("r", "p").alias("change"))
