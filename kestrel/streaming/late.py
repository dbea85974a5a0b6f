"""Repeated and late rows of a stream, every one accounted for.

The watermark of a batch is the newest event time of the batches before it, less a delay; it is kept with the checkpoint,
one row a batch. Rows older than the watermark go to a side table. The others are written once per key: a row
repeats an earlier one if that was written with an event time no older than the watermark less the delay, so
only the end of the table is looked at. All tables are partitioned by batch id and depend on earlier batches alone,
so a repeated batch replaces what it wrote.

Rows without an event time cannot be placed and go to the side table; of a key's rows in one batch the
earliest stays, ties by the rows' values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kestrel.session import path_exists
from kestrel.streaming.ingest import BATCH, launch, write_batch


def late_paths(root: str) -> dict[str, str]:
    base = root.rstrip("/")
    return {"rows": f"{base}/rows", "late": f"{base}/late", "checkpoint": f"{base}/checkpoint", "times": f"{base}/checkpoint-times"}


def _before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    return spark.read.parquet(path).where(F.col(BATCH) < batch_id) if path_exists(spark, path) else None


def split_batch(batch: DataFrame, batch_id: int, root: str, keys: Sequence[str], ts: str, delay: str) -> None:
    """Write the first rows of new keys, and the late rows, of one batch."""
    spark, paths, columns = batch.sparkSession, late_paths(root), batch.columns
    times = _before(spark, paths["times"], batch_id)
    newest = times.agg(F.max("newest").alias("newest")).first()["newest"] if times is not None else None
    watermark = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
    on_time = F.col(ts).isNotNull() & F.coalesce(F.col(ts) >= watermark, F.lit(True))
    rest = [c for c in columns if c not in (ts, *keys)]
    first = batch.where(on_time).groupBy(*keys).agg(F.min(F.struct(ts, *rest)).alias("__row"))
    fresh = first.select(*keys, "__row.*").select(*columns)
    written = _before(spark, paths["rows"], batch_id)
    if written is not None:
        recent = written.where(F.col(ts) >= watermark - F.expr(f"INTERVAL {delay}")).select(*[F.col(k).alias(f"__{k}") for k in keys])
        same = [fresh[k].eqNullSafe(recent[f"__{k}"]) for k in keys]
        fresh = fresh.join(recent, same, "left_anti")
    write_batch(fresh, paths["rows"], batch_id)
    write_batch(batch.where(~on_time), paths["late"], batch_id)
    write_batch(batch.agg(F.max(ts).alias("newest")).where(F.col("newest").isNotNull()), paths["times"], batch_id)


def start_dedup_with_late_rows(stream: DataFrame, root: str, keys: Sequence[str], ts: str, delay: str = "10 minutes", *,
                               drain: bool = False, name: str | None = None, on_written: Callable[[int], None] | None = None) -> StreamingQuery:
    """Rows once per key in ``rows``, late ones in ``late`` (see ``late_paths``)."""

    def each(batch: DataFrame, batch_id: int) -> None:
        split_batch(batch, batch_id, root, keys, ts, delay)
        if on_written:
            on_written(batch_id)

    return launch(stream, late_paths(root)["checkpoint"], each=each, drain=drain, name=name)
