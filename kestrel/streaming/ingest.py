"""Topic -> bronze ingest. ``parse_stream`` is pure and works on batch and streaming frames.

Sources and sinks are format parameters: ``kafka`` / ``delta`` where the connectors are
installed, a directory of envelope files (``key``, ``value`` binary) and parquet otherwise.
Each spec gets its own checkpoint, so a restarted query resumes exactly where it stopped. Streams that write more than
one table do it batch by batch, into tables partitioned by batch id: a batch that is repeated after a failure between its
writes and its checkpoint replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kestrel.streaming.specs import STREAM_SPECS, StreamSpec

ENVELOPE_SCHEMA = "key binary, value binary"


def parse_stream(raw: DataFrame, spec: StreamSpec, stamp: bool = True, corrupt_col: str | None = None) -> DataFrame:
    """Envelope rows as typed records of ``spec``, stamped with the ingest time and watermarked.

    A message that does not parse becomes a row of nulls and still lands; with ``corrupt_col``
    its text is kept in that column, for a quarantine split downstream.
    """
    fields = list(spec.schema.fields)
    if corrupt_col:
        fields.append(T.StructField(corrupt_col, T.StringType()))
    options = {"columnNameOfCorruptRecord": corrupt_col} if corrupt_col else {}
    record = F.from_json(F.decode("value", "UTF-8"), T.StructType(fields), options)
    columns = [F.col("message").getField(f.name).alias(f.name) for f in fields]
    if stamp:
        columns.append(F.current_timestamp().alias("ingested_at"))
    rows = raw.select(record.alias("message")).select(*columns)
    return rows.withWatermark(spec.watermark_col, spec.watermark_delay) if spec.watermark_col else rows


def read_topic(spark: SparkSession, spec: StreamSpec, fmt: str = "kafka", path: str | None = None,
               options: dict[str, str] | None = None) -> DataFrame:
    """Unbounded envelope stream of one topic, from the earliest offset."""
    if fmt == "kafka":
        reader = (spark.readStream.format("kafka").option("subscribe", spec.topic)
                  .option("startingOffsets", "earliest"))
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return reader.load()
    if path is None:
        raise ValueError("file-backed topics need a path")
    reader = spark.readStream.schema(ENVELOPE_SCHEMA).format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(f"{path.rstrip('/')}/{spec.topic}")


CORRUPT = "_corrupt_record"
#: Partition column of tables that a stream writes batch by batch.
BATCH = "batch"


def batches_path(spec: StreamSpec, root: str) -> str:
    """Bronze rows of a stream that is written batch by batch (apart from what the file sink writes)."""
    return f"{root.rstrip('/')}/bronze_batches/{spec.name}"


def quarantine_path(spec: StreamSpec, root: str) -> str:
    return f"{batches_path(spec, root)}_quarantine"


def write_batch(rows: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """One batch's rows as a partition of the table at ``path``, in place of what an earlier try of the batch wrote."""
    numbered = rows.withColumn(BATCH, F.lit(batch_id).cast("long"))
    numbered.write.save(path, format=fmt, mode="overwrite", partitionBy=BATCH, partitionOverwriteMode="dynamic")


def launch(rows: DataFrame, checkpoint: str, *, to: str | None = None, fmt: str | None = None,
           each: Callable[[DataFrame, int], None] | None = None, name: str | None = None, drain: bool = False) -> StreamingQuery:
    """The one place where streams are started: files of ``fmt`` under ``to``, or ``each`` on every (persisted) batch.

    ``drain`` takes what is there and ends; otherwise the stream runs on.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            each(kept, batch_id)
        finally:
            kept.unpersist()

    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    writer = writer.trigger(availableNow=True) if drain else writer
    return writer.foreachBatch(on_batch).start() if each else writer.start(to, format=fmt, outputMode="append")


def start_query(spark: SparkSession, spec: StreamSpec, root: str, source_format: str = "kafka",
                source_path: str | None = None, sink_format: str = "delta",
                source_options: dict[str, str] | None = None, available_now: bool = False,
                query_name: str | None = None, quarantine: bool = False,
                required: list[str] | None = None, on_written: Callable[[int], None] | None = None) -> StreamingQuery:
    """Land the topic of ``spec``: every message as a row, or, with ``quarantine``, only those that are records.

    A message that is no record of the schema or lacks a ``required`` field then goes to the quarantine table, with
    its text and why. ``on_written`` is called with the id of a batch whose rows are written, before it is checkpointed.
    """
    raw = read_topic(spark, spec, source_format, source_path, source_options)
    started = {"name": query_name, "drain": available_now}
    if not quarantine:
        return launch(parse_stream(raw, spec), spec.checkpoint_path(root), to=spec.bronze_path(root), fmt=sink_format, **started)

    from kestrel.sources.payloads import quarantine_split

    needed = list(required) if required is not None else spec.schema.names[:1]

    def both(batch: DataFrame, batch_id: int) -> None:
        good, bad = quarantine_split(batch, needed, F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed record")))
        write_batch(good.drop(CORRUPT), batches_path(spec, root), batch_id, sink_format)
        write_batch(bad, quarantine_path(spec, root), batch_id, sink_format)
        if on_written:
            on_written(batch_id)

    return launch(parse_stream(raw, spec, corrupt_col=CORRUPT), f"{spec.checkpoint_path(root)}-batches", each=both, **started)


def run(spark: SparkSession, root: str, specs: Sequence[StreamSpec] | None = None, *,
        available_now: bool = False, **kw) -> list[StreamingQuery]:
    """Start one query per spec. Unbounded: block until any ends. ``available_now``: drain and wait for all."""
    queries = [start_query(spark, s, root, available_now=available_now, **kw) for s in (specs or STREAM_SPECS)]
    if available_now:
        for q in queries:
            q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(f"stream {q.name} failed: {q.exception()}")
    else:
        spark.streams.awaitAnyTermination()
    return queries
