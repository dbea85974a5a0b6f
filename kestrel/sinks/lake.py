"""Bronze / silver / gold tables on any file format.

Every write is conformed to a declared schema first, because appends with different integer widths cannot be
merged on read. Logs and gold are partitioned by run: a run replaces its own partition and no other, so a
repeat is idempotent, no table is overwritten while it is read, and the runs together are the history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.schemas import conform
from kestrel.session import path_exists


def write_bronze(df: DataFrame, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> None:
    """Append raw records; new columns are merged into the table schema."""
    out = conform(df, schema) if schema is not None else df
    out.write.format(fmt).mode("append").option("mergeSchema", "true").save(path)


def read_bronze(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


#: Partition column of logs that are written run by run.
RUN = "run"


def write_run(df: DataFrame, path: str, run: str, fmt: str = "parquet") -> None:
    """Write one run's rows into a log; a repeat of the run takes the place of what it wrote before."""
    (df.withColumn(RUN, F.lit(run)).write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(RUN).save(path))


def _replace(df: DataFrame, path: str, partition_by: Sequence[str] | None, fmt: str, **options: str) -> None:
    """Write ``df`` in place of what is at ``path``. Rows of one partition are gathered first, so
    that a task does not write a file into every partition; large partitions are split again."""
    by = list(partition_by or ())
    gathered = df.hint("rebalance", *by) if by else df
    gathered.write.save(path, format=fmt, mode="overwrite", partitionBy=by or None, **options)


def write_silver(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, fmt: str = "parquet") -> None:
    """Overwrite with cleaned, deduplicated records (optionally partitioned)."""
    _replace(df, path, partition_by, fmt)


def run_name(at: dt.datetime) -> str:
    """Runs sort by time."""
    return f"at-{at:%Y%m%dT%H%M%S%f}"


def newest_run(spark: SparkSession, path: str, fmt: str = "parquet") -> str | None:
    """The last run that was written to ``path`` (only the partition column is read)."""
    return spark.read.format(fmt).load(path).agg(F.max(RUN).alias("run")).first()["run"] if path_exists(spark, path) else None


def write_gold(df: DataFrame, path: str, at: dt.datetime | None = None, fmt: str = "parquet") -> str:
    """Publish a snapshot as the run of time ``at`` (default: now); a repeat of the run replaces it."""
    run = run_name(at or dt.datetime.now(dt.timezone.utc))
    write_run(df, path, run, fmt)
    return run


def read_gold(spark: SparkSession, path: str, fmt: str = "parquet", run: str | None = None) -> DataFrame:
    """The snapshot of ``run`` (default: the newest), in the columns it was published with."""
    run = run or newest_run(spark, path, fmt)
    if run is None:
        raise FileNotFoundError(f"nothing published under {path}")
    if fmt == "delta":
        return spark.read.format(fmt).load(path).where(F.col(RUN) == run).drop(RUN)
    return spark.read.format(fmt).load(f"{path}/{RUN}={run}")


def read_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All snapshots, with their ``run``, from one read of one table."""
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


def intervals(history: DataFrame, key: Sequence[str], values: Sequence[str], at: str) -> DataFrame:
    """Snapshots as periods of unchanged values: key, values, valid_from and valid_to (the next snapshot time with other values, or none
    of the key; null: still valid). A key that is absent from a snapshot and comes back starts a new period.

    ``at`` is the snapshots' time column. The windows run per key over its snapshots (one row a run).
    """
    runs = history.select(at).distinct()
    following = runs.withColumn("__next", F.lead(at).over(Window.orderBy(at)))  # one row a run
    rows = history.select(*key, *values, at).join(following, at)
    per_key = Window.partitionBy(*key).orderBy(at)
    same = F.struct(*values).eqNullSafe(F.lag(F.struct(*values)).over(per_key)) & (F.lag("__next").over(per_key) == F.col(at))
    starts = rows.withColumn("__new", F.coalesce(~same, F.lit(True)).cast("int"))
    numbered = starts.withColumn("__period", F.sum("__new").over(per_key))
    ends = F.max_by("__next", at)
    return numbered.groupBy(*key, "__period").agg(*[F.first(v).alias(v) for v in values], F.min(at).alias("valid_from"), ends.alias("valid_to")).drop("__period")


def append_results(results: DataFrame, path: str, only_failures: bool = False, fmt: str = "parquet", run: str | None = None) -> int:
    """Append data-quality results to the alert log (all of them, or only the failing ones), under ``run`` if the log has runs."""
    from pyspark.sql import Observation

    from kestrel.schemas import DQ_RESULT

    rows = results.where(~F.col("passed")) if only_failures else results
    obs = Observation("alerts")
    out = conform(rows, DQ_RESULT).observe(obs, F.count(F.lit(1)).alias("n"))
    if run is not None:
        out = out.withColumn(RUN, F.lit(run))
    out.write.save(path, format=fmt, mode="append", partitionBy=[RUN] if run is not None else None)
    return int(obs.get.get("n", 0))
