"""The registered queries of this package: one ``opN_<name>`` for each operator.

Each applies its operator, with production parameters, to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import audit, chunks, embeddings, mixing, pieces, pii, quality_mil, quality_rules, sharding, simhash, suffixes, toxicity, whitening
from ledgerloom.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


@register("op1_quality_mil")
def op1_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a net of the labels outside the held-out fifth."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    net = quality_mil.fit(docs, labels.where(toxicity.remainder("doc_id", 5) != 0))
    return quality_mil.score(docs, net, ["doc_id"]).select(
        "doc_id", (toxicity.remainder("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


_OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM s0),
s2 AS (SELECT *,
         sum(source_size) OVER ()
           - 3 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remain,
         sum(weight) OVER ()
           - coalesce(sum(weight) OVER (ORDER BY source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS load
       FROM s1),
s3 AS (SELECT *, weight * remain > 3 * source_size * load AS stops FROM s2),
one AS (SELECT remain, load FROM s3 WHERE NOT stops ORDER BY source_size / weight, source ASC NULLS LAST LIMIT 1),
t AS (SELECT source, source_size,
        CASE WHEN stops THEN (3 * source_size)::DOUBLE
             ELSE (weight * (SELECT remain FROM one))::DOUBLE / (SELECT load FROM one)::DOUBLE END AS target FROM s3),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM t),
g AS (SELECT d.source, d.h, sum(d.size)::BIGINT AS n FROM d GROUP BY d.source, d.h),
c AS (SELECT g.*, sum(n) OVER (PARTITION BY source ORDER BY h) AS upto FROM g),
e AS (SELECT c.source, c.h, c.n, c.upto, p.target - p.passes * p.source_size AS budget
      FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source),
b AS (SELECT source, min(h) AS cut FROM e WHERE upto > budget GROUP BY source),
f AS (SELECT e.source, e.h + CASE WHEN 2 * (e.budget - (e.upto - e.n)) >= e.n THEN 1 ELSE 0 END AS below
      FROM e JOIN b ON e.source IS NOT DISTINCT FROM b.source AND e.h = b.cut)
SELECT d.doc_id, d.size, p.source_size, p.target,
       (d.size * (p.passes + CASE WHEN d.h < coalesce(f.below, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN f ON d.source IS NOT DISTINCT FROM f.source
"""


@register("op2_mixing", _OP2_SQL)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, with its source's size and target."""
    out = mixing.mixed(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                      F.col("__target").alias("target"), (F.col("__size") * F.col("__copies")).alias("taken"))


SHARDS, SLOTS = [f"shard-{i:04d}" for i in range(16)], 2039

_OP3_SQL = r"""
WITH RECURSIVE shard AS (
  SELECT i, ('0x' || substr(md5(format('shard-{:04d}:offset', i)), 1, 15))::BIGINT % 2039 AS first,
         ('0x' || substr(md5(format('shard-{:04d}:step', i)), 1, 15))::BIGINT % 2038 + 1 AS step
  FROM range(16) r(i)),
prefers AS MATERIALIZED (
  SELECT i, list((first + j * step) % 2039 ORDER BY j) AS slots FROM shard, range(2039) k(j) GROUP BY i),
claims(turn, slot, free) AS (
  SELECT 0, NULL::BIGINT, list_transform(range(2039), lambda x: true)
  UNION ALL
  SELECT turn + 1, s, free[:s] || [false] || free[s + 2:]
  FROM (SELECT turn, free, list_filter(slots, lambda x: free[x + 1])[1] AS s
        FROM claims JOIN prefers ON prefers.i = turn % 16 WHERE turn < 2039) z)
SELECT doc_id, slot::INTEGER AS slot, ((turn - 1) % 16)::INTEGER AS shard
FROM documents JOIN (SELECT turn, slot FROM claims WHERE turn > 0) c
  ON ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % 2039 = c.slot
"""


@register("op3_sharding", _OP3_SQL)
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document, among 16 shards and 2039 slots."""
    return sharding.place(read(spark, sf_dir, "documents"), SHARDS, SLOTS).select("doc_id", "slot", "shard")


@register("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model of the labels outside the held-out third."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(toxicity.remainder("doc_id", 3) != 1))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", (toxicity.remainder("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def piece_model() -> str:
    """The public merge-type vocabulary of 32,000 pieces."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@register("op5_pieces")
def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's ids, with an end id, and the digest of their text."""
    out = pieces.encode_texts(read(spark, sf_dir, "documents"), piece_model(), ["doc_id"])
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@register("op6_embeddings")
def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector, at a cosine of 0.95 or more."""
    return embeddings.embedding_groups(read(spark, sf_dir, "embeddings"))


@register("op7_chunks")
def op7_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that shares a passage with others: its spans, and the documents that hold the passage first."""
    return chunks.repeated_documents(read(spark, sf_dir, "documents"))


@register("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of every document by kind, and all spans with those that the classifier adds."""
    found, _ = pii.find(read(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda x: x["base"])
    return found.select(
        "doc_id", *[F.size(F.filter(base, lambda x: x["kind"] == F.lit(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS[:pii.BASE]],
        F.sha2(pii.digest_form(base).cast("binary"), 256).alias("base_sha256"), pii.digest_form(F.col("spans")).alias("spans"))


_OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS doc,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT r, source, doc, x, lower(trim(regexp_replace(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]', '0', 'g'))) AS line,
             len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words
      FROM (SELECT r, source, doc, unnest(string_split(t, chr(10))) AS x FROM d) q WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT x) AS n FROM l GROUP BY r),
hosts AS (SELECT source, count(DISTINCT doc) AS docs FROM l GROUP BY source),
f AS (SELECT source, line, count(DISTINCT doc) AS n FROM l GROUP BY source, line),
hot AS (SELECT f.source, f.line FROM f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source WHERE f.n > 20 AND f.n * 100 > h.docs),
gone AS (SELECT r, sum(words) AS n FROM l JOIN hot ON l.source IS NOT DISTINCT FROM hot.source AND l.line = hot.line GROUP BY r),
win AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS x FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5) q),
two AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM win) q WHERE n > 1),
rep AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + k AS p FROM two, range(5) s(k)) q GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS removed_words
      FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND n_words - removed_words >= 10 AND 100 * (n_words - removed_words) >= 30 * n_words AS kept
FROM m
"""


@register("op9_quality_rules", _OP9_SQL)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document, a source being its host."""
    return quality_rules.verdicts(read(spark, sf_dir, "documents"))


@register("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; links at four or fewer differing bits."""
    out = simhash.simhash_groups(read(spark, sf_dir, "documents"), width=4, distance=4)
    return out.select("doc_id", simhash.hex16("fp").alias("fingerprint"), F.col("component").alias("component_id"))


@register("op11_suffixes")
def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that strings of 400 bytes cover which start elsewhere too."""
    return suffixes.removed(read(spark, sf_dir, "documents"), least=400)


_OP13_SQL = r"""
WITH m AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS low FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
             || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN m.doc_id > low THEN 'E' ELSE '' END AS fails,
             coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
      FROM m LEFT JOIN l ON m.doc_id = l.doc_id),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM f GROUP BY part, fails),
v(z) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.z || b.z || c.z || d.z || e.z AS filter_order FROM v a, v b, v c, v d, v e
      WHERE len(list_distinct([a.z, b.z, c.z, d.z, e.z])) = 5),
s AS (SELECT filter_order, i AS step, substr(filter_order, i, 1) AS own, substr(filter_order, 1, i - 1) AS before FROM o, range(1, 6) r(i)),
j AS (SELECT part, filter_order, step, own, n, g, x, contains(fails, own) AS hit, fails = own AS alone,
             length(translate(fails, before, '')) < length(fails) AS gone FROM c, s),
k AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails, coalesce(sum(g) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost,
             coalesce(sum(x) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
      FROM j GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM k
"""


@register("op13_audit", _OP13_SQL)
def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each step of each order of five filters removes and loses, by language."""
    failed = audit.failures(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return audit.audit(failed, "ABCDE")


@register("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 16 whitened components of every embedding."""
    vectors = read(spark, sf_dir, "embeddings")
    return whitening.component_rows(vectors, whitening.fit(vectors, limit=16))
