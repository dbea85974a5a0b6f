"""Silver tables built from bronze, run by run.

A build reads the bronze runs it has not taken in yet (partition pruning), puts rows that are no valid records into the
quarantine table under their run, and merges the valid ones into the silver table: of the rows of a key the newest by event
time, then by ingest time, stays. Only the buckets of the new rows' keys are rewritten. Runs are marked as taken in last,
so a build that is broken off is simply repeated: taking a run in twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from kestrel.session import materialize, path_exists
from kestrel.sinks import lake
from kestrel.sinks.keyed import KeyedTable
from kestrel.sources.payloads import BAD, tag_bad

INGESTED_AT = "ingested_at"


@dataclass(frozen=True)
class SilverJob:
    """``bronze``: rows of the silver table's columns, partitioned by run; ``root``: where quarantine and the list of runs go."""

    bronze: str
    table: KeyedTable
    event_time: str
    required: tuple[str, ...]
    root: str
    fmt: str = "parquet"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def taken(self) -> str:
        return f"{self.root}/taken"

    def new_runs(self, spark: SparkSession) -> list[str]:
        """Bronze runs not taken in yet (one name a run)."""
        runs = spark.read.format(self.fmt).load(self.bronze).select(lake.RUN).distinct()
        if path_exists(spark, self.taken):
            runs = runs.join(spark.read.format(self.fmt).load(self.taken).select(lake.RUN), lake.RUN, "left_anti")
        return sorted(r[lake.RUN] for r in runs.collect())


def build(spark: SparkSession, job: SilverJob, extra_bad: Column | None = None, runs: Sequence[str] | None = None) -> list[str]:
    """Take in the new bronze runs (or ``runs``); returns their names."""
    runs = job.new_runs(spark) if runs is None else list(runs)
    if not runs:
        return []
    bronze = lake.read_bronze(spark, job.bronze, job.fmt).where(F.col(lake.RUN).isin(runs))
    tagged = materialize(tag_bad(bronze, job.required, extra_bad), "silver-tagged")
    bad = tagged.where(F.col(BAD).isNotNull())
    if not bad.isEmpty():
        (bad.write.format(job.fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(lake.RUN).save(job.quarantine))
    job.table.keep_newest(tagged.where(F.col(BAD).isNull()).drop(BAD, lake.RUN), [job.event_time, INGESTED_AT])
    counts = tagged.groupBy(lake.RUN).agg(F.count_if(F.col(BAD).isNull()).alias("valid"), F.count(BAD).alias("bad"))
    (counts.write.format(job.fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(lake.RUN).save(job.taken))
    return runs
