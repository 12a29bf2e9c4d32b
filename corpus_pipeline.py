"""The pipeline over documents: five stages, each written before the next.

Every stage takes what its predecessor kept and gives back the columns of
documents (the last one: the encoded texts).  A null text passes through as
an empty one does; an empty table stays empty in every stage.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import mixing, pieces, pii, simhash, toxicity
from ledgerloom.llm.common import bound_batches, read, written
from ledgerloom.llm.queries import piece_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.7 or more; the model is fitted on
    labels of the documents that came in."""
    labels = read(spark, sf_dir, "labels").where(toxicity.remainder("doc_id", 3) != 1)
    return toxicity.score(docs, toxicity.fit(docs, labels), out="toxicity").where("toxicity < 0.7").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of four-word shingles link at four bits or fewer."""
    return simhash.drop_near_copies(docs, width=4, distance=4).select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data replaced by their kind; ``n_chars`` follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it, up to three times."""
    return mixing.mix(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with an end id, and the text that they decode to."""
    out = pieces.encode_texts(docs, piece_model(), ["doc_id", "source"])
    return out.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


def _bounded(stage):
    """``stage`` with texts handed to Python in batches of a few MB."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [(name, _bounded(stage)) for name, stage in (
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
)]

#: SQL has no form for these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
