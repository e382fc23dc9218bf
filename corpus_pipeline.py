"""From documents to packed training windows, a stage after the other.

Each stage works on all that the one before it kept. Language identification drops texts
without letters and those far from every language; near-duplicate removal keeps one
document of each group that fingerprints link; personal data is replaced by its kind;
packing returns the pieces of what is left. Rows that share an id, or have none, are
documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from murmur.llm import bpe, langid, packing, pii, simhash
from murmur.llm.frames import table
from murmur.session import materialize


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known from their text."""
    return langid.keep_accepted(docs, langid.learn(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of 3-word shingles are within 3 bits,
    directly or through others: the one with the least id."""
    return simhash.drop_near_duplicates(docs, words=3, radius=3)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    masked = pii.mask_pii(docs, pii.learn(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in windows of 2048."""
    return packing.pack(docs, bpe.public_path())


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("packing", pack_windows),
]
#: Neither fingerprints nor trained models can be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
