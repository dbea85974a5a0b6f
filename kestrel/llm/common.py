"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import materialize, shared_dir

#: Rows and bytes handed to a Python task at a time: long texts make large batches, so keep them short. The executor holds
#: several copies of a batch outside its heap.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on: UTC, short Arrow batches, package on the workers' path."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    shared_dir(spark)
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, env.get("PYTHONPATH", "")) if x)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, so that extra columns cannot clash with its own."""
    return df.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))


def id_bucket(n: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(n)


__all__ = ["BATCH_BYTES", "BATCH_ROWS", "prepare", "read_table", "text_or_empty", "id_text", "id_bucket", "materialize", "shared_dir"]
