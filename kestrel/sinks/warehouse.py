"""Optional sinks: analytics warehouse and operational store (JDBC).

Both are skipped, with a log line, when they cannot run: no project configured, an
empty frame, or the connector missing from the classpath. A missing optional sink never
fails the job (the lake tables stay the source of truth).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def write_warehouse(df: DataFrame, table: str, mode: str = "append", project: str | None = None,
                    dataset: str | None = None, fmt: str = "bigquery", options: dict[str, str] | None = None) -> bool:
    """Load ``df`` into ``project.dataset.table``. ``mode='append'`` appends, anything else truncates."""
    if not project:
        print(f"[warehouse] skipping {table}: no project configured")
        return False
    if df.isEmpty():
        print(f"[warehouse] skipping {table}: empty frame")
        return False
    target = f"{project}.{dataset}.{table}" if dataset else f"{project}.{table}"
    w = df.write.format(fmt).mode("append" if mode == "append" else "overwrite")
    for k, v in (options or {}).items():
        w = w.option(k, v)
    try:
        w.save(target)
    except Exception as exc:  # noqa: BLE001
        if "DATA_SOURCE_NOT_FOUND" in str(exc) or "Failed to find data source" in str(exc):
            print(f"[warehouse] skipping {table}: connector '{fmt}' unavailable")
            return False
        raise
    return True


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict[str, str] | None = None,
               num_partitions: int | None = None) -> int:
    """Write rows to a JDBC table (one connection per partition, batched inserts). Returns rows written."""
    if df.isEmpty():
        return 0
    out = df.coalesce(num_partitions) if num_partitions else df
    props = dict(properties or {})
    if mode == "overwrite":
        props.setdefault("truncate", "true")
    out.write.jdbc(url, table, mode=mode, properties=props)
    return df.count()


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> DataFrame:
    return spark.read.jdbc(url, table, properties=dict(properties or {}))


def upsert_jdbc(spark: SparkSession, url: str, table: str, batch: DataFrame, rule, seq: str | None = None,
                as_of=None, properties: dict[str, str] | None = None) -> int:
    """Apply the keyed-upsert ``rule`` to a table in an operational database.

    The merged state is computed in Spark from the current table and the batch, written once
    under the shared folder (so the read of the table is finished before it is replaced), then
    loaded back with ``truncate`` (schema, grants and indexes stay). Returns the batch rows applied.
    """
    from kestrel.operators import upsert as up
    from kestrel.session import materialize

    n = up.written_count(batch)
    if n == 0:
        return 0
    current = read_jdbc(spark, url, table, properties)
    state = materialize(up.upsert(current, batch, rule, seq=seq, as_of=as_of), f"jdbc-{table.lower()}")
    props = dict(properties or {})
    props["truncate"] = "true"
    state.select(*current.columns).write.jdbc(url, table, mode="overwrite", properties=props)
    return n
