"""The dirty fixture of the cleaning rules: the clean ``sales`` view as an
all-string raw frame in the messy forms the rules exist for.

The form of each row is chosen deterministically from its date, so SQL over
the clean view can state what a rule should find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import config
from ledgerloom.session import stored_lean
from ledgerloom.sources.tables import sales

RAW_INPUT = [
    "transaction_id", "order_date", "order_year", "order_month", "order_quarter", "order_day", "customer_id",
    "product_id", "product_name", "category", "subcategory", "brand", "original_price_inr", "discount_percent",
    "discounted_price_inr", "quantity", "subtotal_inr", "delivery_charges", "final_amount_inr", "customer_city",
    "customer_state", "customer_tier", "customer_spending_tier", "customer_age_group", "payment_method",
    "delivery_days", "delivery_type", "is_prime_member", "is_festival_sale", "festival_name", "customer_rating",
    "return_status", "product_weight_kg", "is_prime_eligible", "product_rating",
]

CITY_KEYS = list(config.CITY_ALIASES)
TRUE_SPELLINGS = ["True", "TRUE", "Yes", "1", "y", "t"]
FALSE_SPELLINGS = ["False", "FALSE", "No", "0", "n", "f", ""]
CATEGORY_SPELLINGS = ["electronics", "ELECTRONICS", "Electronicss", "Electronics & Accessories", "  electronic "]
PAYMENT_KEYS = {m: [k for k, v in config.PAYMENT_ALIASES.items() if v == m] for m in config.PAYMENT_HIERARCHY}


def dirty_files(spark: SparkSession, d: str, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of the dirty rows as files, as raw data comes: the rules'
    plans start at a scan, not at the expressions that make the fixture."""
    raw = dirty_sales(spark, d)
    return stored_lean(raw if columns is None else raw.select(*columns), "raw")


def _pick(options: list, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (idx % len(options) + 1).cast("int"))


def _money_text(c: Column) -> Column:
    return _fixed(c, 2)


def _fixed(c: Column, places: int) -> Column:
    """As ``%.<places>f`` writes it, but by decimals, which cost a third of a formatter."""
    return F.coalesce(c.try_cast(f"decimal(38,{places})").cast("string"), F.format_string(f"%.{places}f", c))


def _bool_text(c: str) -> Column:
    day = F.col("order_day")
    return F.when(F.col(c), _pick(TRUE_SPELLINGS, day)).otherwise(_pick(FALSE_SPELLINGS, day))


def _pay_text(form) -> Column:
    """A spelling of the payment method, each in its ``form``; without a date the last one."""
    out, at = None, F.col("order_day")
    for method, keys in PAYMENT_KEYS.items():
        spelling = F.element_at(F.array(*[F.lit(form(k)) for k in keys]), F.coalesce((at % len(keys) + 1).cast("int"), F.lit(-1)))
        out = (F if out is None else out).when(F.col("payment_method") == method, spelling)
    return out


def dirty_sales(spark: SparkSession, d: str, dup_every: int = 50, day_parity: int | None = None) -> DataFrame:
    """All-string raw transactions with every messy form, plus _DUP clones;
    ``day_parity`` takes the orders of even (0) or odd (1) days of a month."""
    s = sales(spark, d, RAW_INPUT, lines_last=True)
    if day_parity is not None:
        s = s.where(F.col("order_day") % 2 == day_parity)
    # a clone under the id's _DUP form (1), and the same order again in a later file, under an id that sorts before its own (2);
    # rows are repeated as numbers: texts are made last, so that they are copied through no further step
    cloned = (F.col("customer_id").cast("long") % dup_every) == 0
    s = s.withColumn("_form", F.explode(F.when(cloned, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))))
    form, own = F.col("_form"), F.col("transaction_id")
    sel = F.col("order_day") + F.col("order_month")
    od = F.col("order_date")
    # the class of each form is in DATE_CLASS_SQL; forms 5 and 6 need the fallback
    late = F.col("order_day") > 12
    date_txt = (F.when(sel % 7 == 0, F.date_format(od, "yyyy-MM-dd"))
                .when(sel % 7 == 1, F.date_format(od, "dd-MM-yyyy"))
                .when(sel % 7 == 2, F.date_format(od, "dd/MM/yyyy"))
                .when(sel % 7 == 3, F.date_format(od, "MM/dd/yyyy"))
                .when(sel % 7 == 4, F.date_format(od, "dd-MM-yy"))
                .when(sel % 7 == 5, F.date_format(od, "dd MMM yyyy"))
                .otherwise(F.when(late, F.date_format(od, "MM-dd-yyyy")).otherwise(F.date_format(od, "dd.MM.yyyy"))))
    # dates that read the same either way, or whose day is above 12, need no hint
    hinted = ~((sel % 7).isin(2, 3) & (late | (F.col("order_day") == F.col("order_month"))))
    p = F.col("original_price_inr")
    k7 = F.col("order_day") % 7
    price_txt = (F.when(k7 == 0, _money_text(p))
                 .when(k7 == 1, F.concat(F.lit("₹"), F.format_number(p, 2)))
                 .when(k7 == 2, F.concat(F.lit("Rs "), _money_text(p)))
                 .when(k7 == 3, F.concat(F.lit("-"), _money_text(p)))
                 .when(k7 == 4, _money_text(p * 10))
                 .when(k7 == 5, _money_text(p * 100))
                 .otherwise(F.lit("Price on Request")))
    r = F.col("customer_rating")
    k4 = F.col("order_day") % 4
    rating_txt = (F.when(r.isNull(), F.lit(""))
                  .when(k4 == 0, _fixed(r, 1))
                  .when(k4 == 1, F.concat(_fixed(r, 1), F.lit(" stars")))
                  .when(k4 == 2, F.concat(_fixed(r, 1), F.lit("/5")))
                  .otherwise(F.concat(_fixed(r * 2, 1), F.lit("/10"))))
    cid = F.col("customer_id")
    k3 = F.col("order_day") % 3
    city_txt = (F.when(k3 == 0, _pick(CITY_KEYS, cid)).when(k3 == 1, _pick([f"  {k.upper()} " for k in CITY_KEYS], cid))
                .otherwise(_pick(["  ".join(w.capitalize() for w in k.split(" ")) for k in CITY_KEYS], cid)))
    t = F.col("delivery_type")
    dd = F.col("delivery_days").cast("string")
    k6 = F.col("order_day") % 6
    delivery_txt = (F.when(k6 == 0, dd)
                    .when(k6 == 1, F.when(t == "Same Day", F.lit("Same Day")).otherwise(dd))
                    .when(k6 == 2, F.when(t == "Express", F.lit("express")).otherwise(dd))
                    .when(k6 == 3, F.lit("1-2 days"))
                    .when(k6 == 4, F.lit("-1"))
                    .otherwise(F.lit("0")))
    km = F.col("order_month") % 3
    pay_txt = (F.when(km == 0, _pay_text(str)).when(km == 1, _pay_text(str.upper))
               .otherwise(_pay_text(lambda k: k.replace(" ", "_"))))
    return s.select(
        F.when(form == 1, F.concat(own, F.lit("_DUP"))).when(form == 2, F.concat(F.lit("!"), own)).otherwise(own).alias("transaction_id"),
        date_txt.alias("order_date"),
        F.col("order_year").cast("string").alias("order_year"),
        F.when(hinted, F.col("order_month").cast("string")).otherwise("").alias("order_month"),
        F.col("order_quarter").cast("string").alias("order_quarter"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("product_id").cast("string").alias("product_id"),
        F.concat(F.lit(" "), F.col("product_name")).alias("product_name"),
        _pick(CATEGORY_SPELLINGS, F.col("order_day")).alias("category"),
        F.concat(F.lit(" "), F.col("subcategory"), F.lit(" ")).alias("subcategory"),
        F.concat(F.col("brand"), F.lit("  ")).alias("brand"),
        price_txt.alias("original_price_inr"),
        _fixed(F.col("discount_percent"), 0).alias("discount_percent"),
        _money_text(F.col("discounted_price_inr")).alias("discounted_price_inr"),
        F.when(F.col("quantity") == 1, F.lit("")).otherwise(F.col("quantity").cast("string")).alias("quantity"),
        _money_text(F.col("subtotal_inr")).alias("subtotal_inr"),
        F.when(F.col("order_day") % 9 == 0, F.lit("")).otherwise(_money_text(F.col("delivery_charges")))
        .alias("delivery_charges"),
        _money_text(F.col("final_amount_inr")).alias("final_amount_inr"),
        city_txt.alias("customer_city"),
        F.concat(F.col("customer_state"), F.lit(" ")).alias("customer_state"),
        F.concat(F.lit(" "), F.col("customer_tier")).alias("customer_tier"),
        F.col("customer_spending_tier"),
        F.when(F.col("order_day") % 4 == 0, F.lit("")).otherwise(F.col("customer_age_group"))
        .alias("customer_age_group"),
        pay_txt.alias("payment_method"),
        delivery_txt.alias("delivery_days"),
        t.alias("delivery_type"),
        _bool_text("is_prime_member").alias("is_prime_member"),
        _bool_text("is_festival_sale").alias("is_festival_sale"),
        F.coalesce(F.col("festival_name"), F.lit("nan")).alias("festival_name"),
        rating_txt.alias("customer_rating"),
        F.col("return_status"),
        F.col("product_weight_kg").cast("string").alias("product_weight_kg"),
        _bool_text("is_prime_eligible").alias("is_prime_eligible"),
        _fixed(F.col("product_rating"), 1).alias("product_rating"),
        F.when(form == 2, F.lit("late.csv")).otherwise(
            F.concat(F.lit("fixture_"), (F.col("order_day") % 2).cast("string"), F.lit(".csv"))).alias("source_file"),
    )


DATE_CLASS_SQL = """CASE (order_day + order_month) % 7 WHEN 0 THEN 'iso' WHEN 1 THEN 'dash' WHEN 2 THEN 'slash'
  WHEN 3 THEN 'slash' WHEN 4 THEN 'dash_yy' WHEN 5 THEN 'other' ELSE CASE WHEN order_day > 12 THEN 'dash' ELSE 'other' END END"""
#: Rows of the dirty fixture: each line, and two more for every customer that is cloned.
COPIES_SQL = "(CASE WHEN customer_id % 50 = 0 THEN 3 ELSE 1 END)"
