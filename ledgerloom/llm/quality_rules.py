"""Quality rules by cross-document line frequency (operator 9).

Every text is measured by column expressions (words, symbols, repeated
lines, repeated five-word windows).  Then each line, normalised (lower
case, one space between words, digits as 0) and hashed, is counted by the
documents of its host that hold it; lines in more documents than the limits
allow are removed, and a document that is depleted by that is rejected.

All of it is DataFrame functions.  Lines shuffle as (host, document, hash):
the document's part of the key spreads a line that stands in a third of all
documents, and counts are combined before the second shuffle.  Texts don't
shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
#: A line goes if over this many documents of its host hold it, and over this share (percent) of them.
#: Hosts of up to 2,000 documents are ruled by the count (1 % of them is 20 or fewer, which a group of copies
#: or a chance repeat reaches easily), larger ones by the share: a line of 336 in 10,000 documents of 20 hosts
#: (about 17 a host) stays, and goes once the same share of a host is more than 20 documents.
MOST_DOCS, MOST_PERCENT = 20, 1
#: A document goes if fewer words than this, or a lesser share (percent), are left.
LEAST_WORDS, LEAST_PERCENT = 10, 30
WINDOW = 5


def lines(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))


def line_hash(line: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "), "[0-9]", "0")
    return F.xxhash64(F.lower(F.trim(plain)))


def measures(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with __n_words, __word_chars, __n_symbols, __n_dup_lines and __n_repeat_words."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    with_words = docs.withColumns({"__words": F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), "__lines": lines(t)})
    counted = with_words.withColumns({
        "__n_words": F.size("__words").cast("long"),
        "__word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "__n_symbols": F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"),
        "__n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__windows": F.when(F.size("__words") >= WINDOW,
                            F.transform(F.sequence(F.lit(1), F.size("__words") - (WINDOW - 1)),
                                        lambda i: F.xxhash64(F.slice("__words", i, WINDOW)))).otherwise(F.array().cast("array<bigint>")),
    })
    # most texts have no window twice; only the others sort theirs
    placed = counted.withColumn("__sorted", F.when(
        F.size(F.array_distinct("__windows")) < F.size("__windows"),
        F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    def twice(e: Column, k: Column) -> Column:
        return F.coalesce(F.get("__sorted", k - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get("__sorted", k + 1)["h"] == e["h"], F.lit(False))

    again = F.sort_array(F.transform(F.filter("__sorted", twice), lambda e: e["i"]))
    covered = F.aggregate(
        again, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")), lambda a: a["n"])
    return placed.withColumn("__n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__words", "__lines", "__windows", "__sorted")


def document_name(key: str, text: str) -> Column:
    """Names a document by its key and text; rows that agree in both are one document repeated."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("binary"))


def frequent_lines(docs: DataFrame, key: str, host: str, text: str, most_docs: int = MOST_DOCS,
                   most_percent: float = MOST_PERCENT) -> DataFrame:
    """(host, doc, hash, words): the lines to remove from each document, with
    the number of words that go with them from one copy of it."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{host}`").cast("string").alias("host"), document_name(key, text).alias("doc"), lines(t).alias("lines"))
    each = rows.select("host", "doc", F.posexplode(F.transform("lines", lambda x: F.struct(
        line_hash(x).alias("hash"), F.regexp_count(x, F.lit(WORD)).cast("long").alias("words")))).alias("pos", "x"))
    own = written(each.groupBy("host", "doc", F.col("x.hash").alias("hash"))
                  .agg(F.sum("x.words").alias("words"), F.count_if(F.col("pos") == 0).alias("rows")), "lines")
    copies = own.groupBy("host", "doc").agg(F.sum("rows").alias("rows"))
    docs_of = copies.groupBy(F.col("host").alias("h")).agg(F.count("*").alias("docs"))
    common = (own.groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") > most_docs)
              .join(docs_of, F.col("host").eqNullSafe(F.col("h")))
              .where(F.col("n") * 100 > F.col("docs") * most_percent)
              .select(F.col("h").alias("c_host"), F.col("hash").alias("c_hash")))
    found = own.drop("rows").join(common, (F.col("hash") == F.col("c_hash")) & F.col("host").eqNullSafe(F.col("c_host")))
    times = copies.select(F.col("host").alias("t_host"), F.col("doc").alias("t_doc"), F.col("rows").alias("times"))
    return (found.join(times, (F.col("doc") == F.col("t_doc")) & F.col("host").eqNullSafe(F.col("t_host")))
            .select("host", "doc", "hash", (F.col("words") / F.col("times")).cast("long").alias("words")))


def verdicts(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text", keep: list[str] | None = None,
             most_docs: int = MOST_DOCS, most_percent: float = MOST_PERCENT) -> DataFrame:
    """The columns ``keep`` of ``docs`` (the key by default), the five
    measures, ``removed_words``, ``base_failed`` and ``kept``, for each row.

    A null text has no words and fails.  A null host is a host of its own; a
    null key is a key like others.  Rows repeated with key and text count as
    one document and all get its verdict.  Only lines that have a word count.
    An empty table gives an empty result."""
    keep = [key] if keep is None else keep
    row = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("t"),
                      F.col(f"`{host}`").cast("string").alias("__host"), document_name(key, text).alias("__doc"))
    measured = measures(row, "t").drop("t")
    removed = (frequent_lines(docs, key, host, text, most_docs, most_percent).groupBy("host", "doc")
               .agg(F.sum("words").alias("words")))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return (measured.join(removed, (F.col("__doc") == F.col("doc")) & F.col("__host").eqNullSafe(F.col("host")), "left")
            .select(*[F.col(f"k{i}") for i in range(len(keep))], *[F.col(f"__{n}").alias(n) for n in names],
                    F.coalesce("words", F.lit(0)).alias("removed_words"))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (left >= LEAST_WORDS) & (100 * left >= LEAST_PERCENT * F.col("n_words")))
            .withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)}))


def cleaned(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text",
            most_docs: int = MOST_DOCS, most_percent: float = MOST_PERCENT) -> DataFrame:
    """``docs`` without the rejected documents, and their texts without the
    lines above the limits.  Other columns come back as they were."""
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    k, h, t = (f"c{names.index(c)}" for c in (key, host, text))
    found = (frequent_lines(rows, k, h, t, most_docs, most_percent).groupBy("host", "doc")
             .agg(F.sum("words").alias("words"), F.collect_set("hash").alias("hashes")))
    joined = measures(rows.withColumn("__doc", document_name(k, t)), t).join(
        found, (F.col("__doc") == F.col("doc")) & F.col(h).cast("string").eqNullSafe(F.col("host")), "left")
    left = F.col("__n_words") - F.coalesce("words", F.lit(0))
    good = ((F.col("__n_words") >= LEAST_WORDS) & (100 * F.col("__n_repeat_words") <= 20 * F.col("__n_words"))
            & (left >= LEAST_WORDS) & (100 * left >= LEAST_PERCENT * F.col("__n_words")))
    gone = F.coalesce("hashes", F.array().cast("array<bigint>"))
    shorter = F.array_join(F.filter(F.split(t, "\n", -1), lambda x: ~(x.rlike(WORD) & F.array_contains(gone, line_hash(x)))), "\n")
    return joined.where(good).withColumn(t, F.when(F.size(gone) > 0, shorter).otherwise(F.col(t))).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
