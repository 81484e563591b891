"""Training documents from raw ones: quality classifier, quality rules, near duplicates, repeated passages, packing.

Each stage is one operator of ``caseloom.llm`` on all documents its predecessor kept.  Filtering stages return the surviving
rows of ``documents``; rows with a NULL doc_id cannot be named in a verdict and stay.  The passage stage rewrites texts (bytes of
a character that a removal cut in two go too) and their ``n_chars``.  The last stage returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import hyperminhash, packing, quality_rules, resampling, suffix_dedup
from caseloom.llm.common import stored, table
from caseloom.llm.queries import vocabulary_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
PASSAGE_BYTES = suffix_dedup.LENGTH


def _without_rejected(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    rejected = verdicts.where(~F.col("kept")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(rejected, "doc_id", "left_anti").select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without_rejected(docs, resampling.resample(docs, table(spark, sf_dir, "labels")))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without_rejected(docs, quality_rules.judged(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without_rejected(docs, hyperminhash.near_duplicates(docs, width=5, percent=80))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(docs, PASSAGE_BYTES, carry=("lang", "source"))
    return cut.withColumnRenamed("kept_text", "text").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_filter),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("packing", pack),
]

# Byte spans, components over hashed sets and token ids are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
