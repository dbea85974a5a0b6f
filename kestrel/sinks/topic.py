"""Topic envelopes and keyed publication.

A record becomes one message: ``key`` = the key field as UTF-8 text (null when no key
field), ``value`` = the record as JSON (null fields written as ``null``). The write is one
distributed job; with the Kafka connector it is ``write.format("kafka")`` with ``acks=all``
and 3 retries, otherwise the envelope lands as parquet under ``<path>/<topic>``. The
published count comes from an ``Observation`` on the same write, not a second pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kestrel.functions.scalars import json_bytes
from kestrel.streaming.specs import DQ_ALERTS_TOPIC, TOPICS


def _key(key_field: str | None):
    return F.col(key_field).cast("string").cast("binary") if key_field else F.lit(None).cast("binary")


def envelope(df: DataFrame, key_field: str | None = None, topic: str | None = None) -> DataFrame:
    """``(key, value[, topic])`` messages for every record of ``df``."""
    cols = [_key(key_field).alias("key"), json_bytes(*df.columns).alias("value")]
    if topic is not None:
        cols.append(F.lit(topic).alias("topic"))
    return df.select(*cols)


def routed(df: DataFrame, source_col: str, key_field: str | None = None) -> DataFrame:
    """Multi-topic envelope: ``topic`` looked up from the fixed source -> topic map (one write for all)."""
    mapping = F.create_map(*[F.lit(x) for kv in TOPICS.items() for x in kv])
    return df.select(
        _key(key_field).alias("key"),
        json_bytes(*[c for c in df.columns if c != source_col]).alias("value"),
        mapping[F.col(source_col)].alias("topic"),
    )


def publish(df: DataFrame, topic: str, key_field: str | None = None, fmt: str = "kafka",
            path: str | None = None, options: dict[str, str] | None = None) -> int:
    """Publish every record of ``df`` to ``topic``; returns the number of messages written."""
    obs = Observation("published")
    env = envelope(df, key_field).observe(obs, F.count(F.lit(1)).alias("n"))
    if fmt == "kafka":
        w = env.write.format("kafka").option("topic", topic).option("kafka.acks", "all").option("kafka.retries", "3")
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.save()
    else:
        if path is None:
            raise ValueError("file-backed topics need a path")
        env.write.format(fmt).mode("append").save(f"{path.rstrip('/')}/{topic}")
    return int(obs.get.get("n", 0))


def publish_alerts(results: DataFrame, fmt: str = "kafka", path: str | None = None,
                   options: dict[str, str] | None = None) -> int:
    """Failing data-quality results -> JSON events on the alert topic."""
    return publish(results.where(~F.col("passed")), DQ_ALERTS_TOPIC, None, fmt, path, options)
