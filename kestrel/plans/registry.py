"""Query registry: one Spark job per operator family, each paired with DuckDB SQL.

Every query reads whole test tables (or frames Spark derives from them); nothing is
sampled, capped or filtered to a subset of ids. Limits appear only where the limit is
the feature (newest-N reports). Timestamps leave as TIMESTAMP_NTZ (UTC wall clock)
so they compare with DuckDB's TIMESTAMP.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed snapshot time for every "now" in the registered queries (the data ends 2024-01-30).
AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)
AS_OF_SQL = "TIMESTAMP '2024-02-01 00:00:00'"

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register ``fn`` as query ``name``; it always runs with the session time zone at UTC."""

    def deco(fn: QueryFn) -> QueryFn:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        _QUERIES[name] = run
        if oracle is not None:
            _ORACLES[name] = oracle.strip()
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def ntz(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP column to TIMESTAMP_NTZ (session time zone is UTC)."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _load_all() -> None:
    # Query modules register themselves on import.
    from kestrel.plans import queries_core, queries_dq, queries_ingest, queries_io, queries_more, queries_signals  # noqa: F401


__all__ = ["AS_OF", "AS_OF_SQL", "register", "queries", "oracle_sql", "ntz"]
