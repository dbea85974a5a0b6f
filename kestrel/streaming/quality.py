"""Topic -> bronze ingest with data quality on every micro-batch.

The figures that the checks need (rows, missing values per field, newest event time) are observed while a batch is
written, so its rows are read once. Results are kept per batch and failing ones are published under the key
(table, batch, check); a batch that is repeated replaces its rows, its results and its messages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kestrel.functions.scalars import json_bytes
from kestrel.operators import dq
from kestrel.streaming.ingest import batches_path, launch, parse_stream, read_topic, write_batch
from kestrel.streaming.specs import DQ_ALERTS_TOPIC, StreamSpec


def quality_paths(spec: StreamSpec, root: str) -> dict[str, str]:
    base = root.rstrip("/")
    return {
        "bronze": f"{batches_path(spec, base)}_checked",
        "alerts": f"{base}/alerts/{spec.name}",
        "checkpoint": f"{spec.checkpoint_path(base)}-quality",
        "topics": f"{base}/topics-out",
    }


def alert_messages(failing: DataFrame, batch_id: int) -> DataFrame:
    """Messages keyed by (table, batch, check), so that a repeat carries the same keys."""
    key = F.concat_ws("/", "table", F.lit(str(batch_id)), "check_name").cast("binary")
    return failing.select(key.alias("key"), json_bytes(*failing.columns).alias("value"))


def start_ingest_with_quality(spark: SparkSession, spec: StreamSpec, root: str, *, source_format: str = "kafka",
                              source_path: str | None = None, sink_format: str = "parquet",
                              max_null_rate: float = dq.DEFAULT_MAX_NULL_RATE, alert_format: str = "parquet",
                              available_now: bool = False, as_of=None, max_age=dq.DAG_FRESHNESS_SLA,
                              on_written: Callable[[int], None] | None = None) -> StreamingQuery:
    """Land, check and publish every batch. ``on_written`` is called before a batch is checkpointed."""
    paths = quality_paths(spec, root)
    fields = list(spec.schema.fields)

    def each(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        write_batch(batch.observe(seen, *dq.batch_metrics(fields, spec.watermark_col)), paths["bronze"], batch_id, sink_format)
        results = dq.metric_results(batch.sparkSession, seen.get, fields, spec.name, max_null_rate, spec.watermark_col, max_age, as_of)
        write_batch(results, paths["alerts"], batch_id)
        messages = alert_messages(results.where(~F.col("passed")), batch_id)
        if alert_format == "kafka":
            messages.write.format("kafka").option("topic", DQ_ALERTS_TOPIC).save()
        else:
            write_batch(messages, f"{paths['topics']}/{DQ_ALERTS_TOPIC}", batch_id, alert_format)
        if on_written:
            on_written(batch_id)

    raw = read_topic(spark, spec, source_format, source_path)
    return launch(parse_stream(raw, spec), paths["checkpoint"], each=each, drain=available_now)
