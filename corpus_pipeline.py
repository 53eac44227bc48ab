"""A training corpus out of raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it
kept. ``run`` writes every result as Parquet in the shared folder and reads it
back, so a lost executor costs no more than a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavilion.llm import byte_pairs, decontamination, near_dedup, personal_data, quality_rules
from pavilion.llm.queries import tokenizer_path
from pavilion.llm.storage import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules keep."""
    return quality_rules.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return near_dedup.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark to speak of."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    clean = personal_data.masked(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents (little-endian unsigned 32-bit), and whether decoding gives the text."""
    back, ids, text = byte_pairs.round_trip(docs, tokenizer_path())
    same = F.coalesce("text", F.lit("")) == F.col(text)
    return back.select(
        "doc_id", "lang", "source", byte_pairs.id_count(ids).alias("n_tokens"), F.col(ids).alias("ids"),
        F.sha2(ids, 256).alias("ids_sha256"), same.alias("lossless"),
    )


STAGES = [
    ("quality rules", quality),
    ("near-dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("personal data", mask),
    ("byte-pair encoding", encode),
]

# Expectation-maximisation, components and merges have no SQL form; the stages are
# tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
