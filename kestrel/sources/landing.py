"""Landed raw records and payloads -> frames with a declared schema (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kestrel.session import path_exists


def read_records(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """Records landed as JSON lines (or another format) read with the entity schema.

    A missing landing folder is an empty batch (a no-op downstream), not an error.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)


def read_payloads(spark: SparkSession, path: str, context: T.StructType) -> DataFrame:
    """Raw API responses landed as JSON lines ``{<context fields>, "payload": "<response text>"}``."""
    schema = T.StructType(list(context.fields) + [T.StructField("payload", T.StringType())])
    return read_records(spark, path, schema)
