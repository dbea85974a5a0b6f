"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

The first four return the columns of ``documents``; the last returns the pieces of the packed
sequences (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset). Every stage works on all
rows its predecessor kept. An empty table passes through every stage as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import exact_dedup, packing, pii, quality, simhash
from kestrel.llm.common import materialize, prepare, read_table
from kestrel.llm.encoders import default_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject."""
    prepare(spark)
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every text."""
    prepare(spark)
    return exact_dedup.keep_first(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies: 3-word shingles, at most 3 differing bits."""
    prepare(spark)
    return simhash.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and the terms that tell it replaced."""
    prepare(spark)
    return pii.sanitise(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every id of every document in one piece of one sequence."""
    prepare(spark)
    pieces = packing.token_pieces(docs, default_path("word_bpe_49k.json"))
    digests = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(digests, ["doc_id", "start", "ids_crc32"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: A learnt model, XXH64 and tokenizers cannot be written in SQL; tests compare each stage with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
