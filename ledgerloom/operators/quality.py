"""Data-quality profiles and checks (K5-K14) as single-pass aggregates.

Every profile is one ``agg`` (or one ``groupBy``) over the whole table --
partial aggregation map-side, one small result -- then reshaped with
``stack`` / ``inline`` into long form.  Nothing is collected per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.exprs import flag, is_blank_text, is_null_token
from ledgerloom.operators import cleaning as C
from ledgerloom.operators.ranking import exact_quantiles
from ledgerloom.session import freed_shuffles, stored_lean


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """K5: per column, null-or-empty count and percent (long form)."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count("*").alias("_n"), *[
        F.sum(F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), 1).otherwise(0))
        .alias(f"_m{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").cast("long").alias("missing"))
                     for i, c in enumerate(cols)])
    return agg.select("_n", F.inline(rows)).select(
        "column", "missing", (F.col("missing") / F.col("_n") * 100).alias("missing_pct"))


def date_format_profile(df: DataFrame, col: str = "order_date") -> DataFrame:
    """K6: count per date text class (iso, slash, dash, dash_yy, null-like, other)."""
    raw = F.trim(F.col(col))
    cls = (F.when(is_null_token(col), "null_like").when(raw.rlike(C.ISO_RE), "iso")
           .when(raw.rlike(C.SLASH_RE), "slash").when(raw.rlike(C.DASH_RE), "dash")
           .when(raw.rlike(C.DASH_YY_RE), "dash_yy").otherwise("other"))
    return df.groupBy(cls.alias("format_class")).agg(F.count("*").alias("rows"))


def price_class(col: str) -> Column:
    """Class of a price text: plain, comma, currency, text or null-like."""
    raw = F.trim(F.col(col))
    return (F.when(is_null_token(col), "null_like").when(raw.rlike("(?i)₹|rs|inr"), "currency")
            .when(raw.contains(","), "comma").when(raw.rlike(C.NUMERIC_RE), "plain").otherwise("text"))


def price_profile(df: DataFrame, col: str = "original_price_inr") -> DataFrame:
    """K6: count per price text class."""
    return df.groupBy(price_class(col).alias("price_class")).agg(F.count("*").alias("rows"))


def text_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, rows): the distinct texts of each column, from one pass.

    Columns are unpivoted inside the scan's stage and counts combine
    map-side, so a text that fills a column is one row a task.  Who reads the
    counts twice stores them."""
    each = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    return each.groupBy("column", "value").agg(F.count("*").alias("rows"))


def null_like(df: DataFrame) -> DataFrame:
    """K5: null-like texts of each column, as (column, missing, missing_pct):
    one aggregate of counts.  Each text is named once, in a projection, so
    Spark makes it there and copies its blank mark alone."""
    cols = df.columns
    marks = df.select(*[F.coalesce(is_blank_text(F.col(c)), F.lit(True)).cast("long").alias(f"b{i}") for i, c in enumerate(cols)])
    one = marks.agg(F.count("*").alias("n"), *[F.sum(f"b{i}").alias(f"m{i}") for i in range(len(cols))]).where("n > 0")
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(cols)])
    return one.select("n", F.inline(each)).select("column", "missing", (F.col("missing") / F.col("n") * 100).alias("missing_pct"))


def top_values(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent texts of each column, ties by text.  The row
    number's limit is applied before the shuffle as well, so a column of
    unique texts sends ``n`` a task."""
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.col("rows").desc(), "value"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= n).select("column", "rank", "value", "rows")


def numeric_texts(counts: DataFrame) -> DataFrame:
    """K9: of each column's texts (commas and rupee signs aside) the rows that
    are numbers, the others that aren't blank, the range and the exact median."""
    v = C._num(F.regexp_replace("value", "[,₹]", ""))
    rows = counts.withColumn("v", v)
    one = rows.groupBy("column").agg(
        F.sum(F.when(F.col("v").isNotNull(), F.col("rows")).otherwise(0)).alias("numeric_rows"),
        F.sum(F.when(F.col("v").isNull() & (F.trim("value") != ""), F.col("rows")).otherwise(0)).alias("other"), F.min("v").alias("min"), F.max("v").alias("max"))
    median = exact_quantiles(rows, "v", [0.5], ["column"], "m", weight="rows").select(F.col("column").alias("c"), F.round("m0", 4).alias("median"))
    return one.join(median, F.col("column") == F.col("c"), "left").drop("c")


def repeated_rows(df: DataFrame, key: Sequence[str], id_col: str = "transaction_id") -> DataFrame:
    """K8: rows, and those beyond the first of each whole row, id and business
    key.  One aggregate over three 128-bit keys a row; ``ids`` counts distinct ids."""
    def name(*cols: str) -> Column:
        row = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
        return F.struct(F.xxhash64(row).alias("a"), F.xxhash64(F.lit(1), row).alias("b"))

    kinds = {"exact_dups": df.columns, "id_dups": [id_col], "key_dup_rows": list(key)}
    each = df.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), name(*c).alias("key")) for k, c in kinds.items()])))
    groups = each.groupBy("kind", "key").agg(F.count("*").alias("n")).groupBy("kind").agg(F.sum("n").alias("rows"), F.count("*").alias("distinct"))
    pick = lambda k, c: F.coalesce(F.max(F.when(F.col("kind") == k, c)), F.lit(0))
    more = F.col("rows") - F.col("distinct")
    return groups.agg(pick("id_dups", F.col("rows")).alias("rows"), *[pick(k, more).alias(k) for k in kinds], pick("id_dups", F.col("distinct")).alias("ids"))


def date_evidence(df: DataFrame) -> DataFrame:
    """Two-two-four digit dates by their mark (slash, dash): which parts
    rule a reading out, failures of both readings, and how often their month
    and year agree with the columns that state them."""
    raw = F.trim("order_date")
    form = F.when(raw.rlike(r"^\d{2}/\d{2}/\d{4}$"), "slash").when(raw.rlike(r"^\d{2}-\d{2}-\d{4}$"), "dash")
    s = F.regexp_replace(raw, "/", "-")
    a, b = (F.get(F.split(s, "-"), i).cast("int") for i in (0, 1))
    rows = df.where(form.isNotNull()).select(
        form.alias("form"), a.alias("a"), b.alias("b"), F.try_to_date(s, "dd-MM-yyyy").alias("dmy"), F.try_to_date(s, "MM-dd-yyyy").alias("mdy"),
        C._num(F.col("order_month")).alias("om"), C._num(F.col("order_year")).alias("oy"))
    n = lambda cond: F.count_if(F.coalesce(cond, F.lit(False)))
    a, b, dmy, mdy = (F.col(c) for c in ("a", "b", "dmy", "mdy"))
    return rows.groupBy("form").agg(
        F.count("*").alias("rows"), n(a > 12).alias("first_above_12"), n(b > 12).alias("second_above_12"), n((a <= 12) & (b <= 12)).alias("both_up_to_12"),
        n(dmy.isNull()).alias("dmy_fails"), n(mdy.isNull()).alias("mdy_fails"), n(F.month(dmy) == F.col("om")).alias("dmy_month_matches"),
        n(F.month(mdy) == F.col("om")).alias("mdy_month_matches"), n(F.year(dmy) == F.col("oy")).alias("dmy_year_matches"))


def value_profile(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """K7: top-n values with counts (ties by value), plus the distinct count."""
    counts = df.groupBy(col).agg(F.count("*").alias("rows"))
    distinct = counts.agg(F.count("*").alias("distinct_values"))
    top = counts.orderBy(F.col("rows").desc(), F.col(col).asc_nulls_first()).limit(n)
    return top.crossJoin(F.broadcast(distinct))


def duplicate_profile(df: DataFrame, key: Sequence[str], id_col: str = "transaction_id") -> DataFrame:
    """K8: exact-row, id and business-key duplicate counts (rows beyond the first)."""
    n = df.agg(F.count("*").alias("rows"))
    exact = df.groupBy(*df.columns).agg(F.count("*").alias("c")).agg(F.sum(F.col("c") - 1).alias("exact_dups"))
    ids = df.groupBy(id_col).agg(F.count("*").alias("c")).agg(F.sum(F.col("c") - 1).alias("id_dups"))
    keys = df.groupBy(*key).agg(F.count("*").alias("c")).agg(
        F.sum(F.col("c") - 1).alias("key_dup_rows"), F.sum(F.when(F.col("c") > 1, 1).otherwise(0)).alias("dup_keys"),
        F.max("c").alias("max_group_size"))
    return n.crossJoin(F.broadcast(exact)).crossJoin(F.broadcast(ids)).crossJoin(F.broadcast(keys))


def discount_identity(df: DataFrame) -> DataFrame:
    """Relative error of discounted = list x (1 - pct/100); counts above
    0.05 and 0.5 (one aggregate)."""
    rel = F.abs(F.col("original_price_inr") * (1 - F.col("discount_percent") / 100.0) - F.col("discounted_price_inr")) \
        / F.col("discounted_price_inr")
    return df.select(rel.alias("rel")).agg(
        F.count("rel").alias("rows"), F.sum(flag(F.col("rel") > 0.05)).cast("long").alias("above_5pct"),
        F.sum(flag(F.col("rel") > 0.5)).cast("long").alias("above_50pct"))


def post_clean_checks(clean: DataFrame, raw_rows: DataFrame) -> DataFrame:
    """Invariants of a cleaned table as (check, value, passed) rows."""
    key = ["customer_id", "product_id", "order_date", "final_amount_inr"]
    a = clean.agg(
        F.count("*").alias("rows"),
        F.sum(flag(F.col("order_date").isNull())).alias("null_dates"),
        F.sum(flag(F.year("order_date") != F.col("order_year"))).alias("year_mismatch"),
        F.sum(flag(F.month("order_date") != F.col("order_month"))).alias("month_mismatch"),
        F.sum(flag(F.col("original_price_inr") < 0)).alias("negative_prices"),
        F.sum(flag(~F.col("customer_rating").between(1, 5))).alias("ratings_out_of_domain"),
        F.sum(flag(F.col("transaction_id").endswith("_DUP"))).alias("dup_ids_left"),
    )
    k = clean.groupBy(*key).agg(F.count("*").alias("c")).agg(F.sum(F.col("c") - 1).alias("key_dups_left"))
    r = raw_rows.agg(F.count("*").alias("raw_rows"))
    j = a.crossJoin(F.broadcast(k)).crossJoin(F.broadcast(r))
    checks = [
        ("rows_not_above_raw", F.col("rows"), F.col("rows") <= F.col("raw_rows")),
        ("null_dates", F.col("null_dates"), F.col("null_dates") == 0),
        ("year_mismatch", F.col("year_mismatch"), F.col("year_mismatch") == 0),
        ("month_mismatch", F.col("month_mismatch"), F.col("month_mismatch") == 0),
        ("negative_prices", F.col("negative_prices"), F.col("negative_prices") == 0),
        ("ratings_out_of_domain", F.col("ratings_out_of_domain"), F.col("ratings_out_of_domain") == 0),
        ("dup_ids_left", F.col("dup_ids_left"), F.col("dup_ids_left") == 0),
        ("key_dups_left", F.col("key_dups_left"), F.coalesce(F.col("key_dups_left"), F.lit(0)) == 0),
    ]
    rows = F.array(*[F.struct(F.lit(n).alias("check"), v.cast("double").alias("value"),
                              F.coalesce(p, F.lit(True)).alias("passed")) for n, v, p in checks])
    return j.select(F.inline(rows))


#: Columns of the cleaned table whose values the verification counts, by the name of the check.
_VERIFIED_VALUES = {"city": "customer_city", **{c: c for c in ("is_prime_member", "is_prime_eligible", "is_festival_sale", "category", "subcategory",
                                                              "payment_method", "payment_method_group", "customer_age_group")}}


def verification(clean: DataFrame) -> DataFrame:
    """K14 in full: (check, key, value) rows of a cleaned table: totals, null
    counts, date and price checks with quantiles, the discount identity, ids,
    keys, and the counts of each categorical value (``key``).  Dates are their digits.

    Row-wise figures are one aggregate, values one unpivot, distinct ids and
    keys one aggregate over their hashes; prices go through the range-wise quantiles."""
    flagged = lambda cond: F.count_if(F.coalesce(cond, F.lit(False)))
    price, rating = F.col("original_price_inr"), F.col("customer_rating")
    expected = F.col("discounted_price_inr") / (1 - F.col("discount_percent") / 100)
    rel = F.round(F.try_divide(F.abs(price - expected), expected), 6)
    digits = lambda c: F.date_format(c, "yyyyMMdd").cast("double")
    some = [(c, n) for c, n in ((c, flagged(F.col(c).isNull())) for c in clean.columns)]
    figures = {
        "rows": F.count("*"), "date.null": flagged(F.col("order_date").isNull()), "date.year_mismatch": flagged(F.year("order_date") != F.col("order_year")),
        "date.month_mismatch": flagged(F.month("order_date") != F.col("order_month")), "date.first": digits(F.min("order_date")), "date.last": digits(F.max("order_date")),
        "price.negative": flagged(price < 0), "price.null": flagged(price.isNull()), "price.mean": F.round(F.avg(price), 4), "price.std": F.round(F.stddev_samp(price), 3),
        "price.min": F.min(price), "price.max": F.max(price), "price.identity_above_1pct": flagged(rel > 0.01), "price.identity_worst": F.max(rel),
        "rating.min": F.min(rating), "rating.max": F.max(rating), "rating.null_share": F.round(flagged(rating.isNull()) / F.count("*"), 9),
        "ids.dup_left": flagged(F.col("transaction_id").endswith("_DUP")), "revenue": F.sum(F.round(F.col("final_amount_inr") * 100).cast("long")) / 100.0,
    }
    names = list(figures)
    one = clean.agg(*[v.cast("double").alias(f"f{i}") for i, v in enumerate(figures.values())], *[n.cast("double").alias(f"n{i}") for i, (_, n) in enumerate(some)])
    flat = F.array(*[F.struct(F.lit(n).alias("check"), F.lit(None).cast("string").alias("key"), F.col(f"f{i}").alias("value")) for i, n in enumerate(names)],
                   *[F.when(F.col(f"n{i}") > 0, F.struct(F.lit(f"nulls.{c}").alias("check"), F.lit(None).cast("string").alias("key"), F.col(f"n{i}").alias("value")))
                     for i, (c, _) in enumerate(some)])
    out = one.select(F.explode(F.filter(flat, lambda x: x.isNotNull())).alias("x")).select("x.*")
    counts = stored_lean(text_counts(clean, list(_VERIFIED_VALUES.values())), "texts")
    label = F.create_map(*[x for n, c in _VERIFIED_VALUES.items() for x in (F.lit(c), F.lit(f"{n}.values"))])
    out = out.unionByName(counts.select(F.element_at(label, F.col("column")).alias("check"), F.col("value").alias("key"), F.col("rows").cast("double").alias("value")))
    rows = lambda df, check, value: df.select(F.lit(check).alias("check"), F.lit(None).cast("string").alias("key"), value.cast("double").alias("value"))
    out = out.unionByName(rows(counts.where("column = 'customer_city'").agg(F.count("*").alias("n")), "city.distinct", F.col("n")))
    # one row, three times read: stored, so that the keys of all rows are gone from the disk
    repeated = stored_lean(repeated_rows(clean, ["customer_id", "product_id", "order_date", "final_amount_inr"]), "repeated")
    for check, value in (("ids.distinct", F.col("ids")), ("ids.repeated", F.col("id_dups")), ("key.repeated", F.col("key_dup_rows"))):
        out = out.unionByName(rows(repeated, check, value))
    for check, c in (("customers", "customer_id"), ("products", "product_id"), ("rating.distinct", "customer_rating")):
        out = out.unionByName(rows(clean.agg(F.countDistinct(c).alias("n")), check, F.col("n")))
    with freed_shuffles(clean.sparkSession):
        q = exact_quantiles(clean, "original_price_inr", [0.25, 0.5, 0.75, 0.99], name="q")
    for i, check in enumerate(("price.q25", "price.q50", "price.q75", "price.p99")):
        out = out.unionByName(rows(q, check, F.round(f"q{i}", 4)))
    return out
