"""Keyed tables on plain files: hash buckets of the key as partitions, of which an upsert replaces only the touched ones.

Rows are partitioned by a hash of their key. A batch touches the buckets of its keys: only these are read
(partition pruning), merged with the batch, staged as a table in the shared folder and then put in place by a
dynamic partition overwrite; every other bucket keeps its files. The number of buckets is part of the
partition column's name (``bucket_of_64``), so a table cannot be read with another number by mistake.

The staged copy makes a broken-off write repeatable: running the same batch again gives the same rows, since a
batch is idempotent (kept columns stay, refreshed ones are set to the same values). As with a lakehouse table
whose writers conflict, one job writes a table at a time. On a format with ``MERGE``, ``operators.upsert.merge_into`` runs
the same rule as one statement.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel import schemas
from kestrel.operators import upsert
from kestrel.session import materialize, path_exists

BUCKETS = 64


@dataclass(frozen=True)
class Written:
    """Rows handed over, and the buckets (of all) whose files were replaced."""

    rows: int
    buckets: tuple[int, ...] = ()


@dataclass(frozen=True)
class KeyedTable:
    """Rows of ``schema``, one for each ``key``, under ``path``."""

    path: str
    key: tuple[str, ...]
    schema: T.StructType
    buckets: int = BUCKETS
    fmt: str = "parquet"

    @property
    def partition(self) -> str:
        return f"bucket_of_{self.buckets}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast(self.schema[k].dataType) for k in self.key]), F.lit(self.buckets)).cast("int")

    def _stored(self, spark: SparkSession) -> DataFrame:
        whole = T.StructType([*self.schema.fields, T.StructField(self.partition, T.IntegerType())])
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], whole)
        return spark.read.format(self.fmt).schema(whole).load(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark).drop(self.partition)

    def create(self, spark: SparkSession) -> bool:
        """An empty table, if there is none yet; returns whether one was made."""
        if path_exists(spark, self.path):
            return False
        empty = spark.createDataFrame([], self.schema).withColumn(self.partition, F.lit(0))
        empty.write.partitionBy(self.partition).save(self.path, format=self.fmt)
        return True

    def merge(self, batch: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> Written:
        """Replace the buckets of ``batch`` by ``combine(stored rows of these buckets, batch)``.

        ``batch`` is read several times: stage it first. Rows without a key are not applied; an empty batch writes nothing.
        """
        spark = batch.sparkSession
        batch = batch.dropna(subset=list(self.key))
        counts = batch.groupBy(self.bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most one row a bucket
        touched = tuple(sorted(r["bucket"] for r in counts))
        if not touched:
            return Written(0)
        target = self._stored(spark).where(F.col(self.partition).isin(*touched)).drop(self.partition)
        state = schemas.conform(combine(target, batch), self.schema)
        staged = materialize(state.withColumn(self.partition, self.bucket()), "keyed-state")
        (staged.hint("rebalance", self.partition).write.format(self.fmt).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(self.partition).save(self.path))
        return Written(sum(r["n"] for r in counts), touched)

    def upsert(self, batch: DataFrame, rule: upsert.UpsertRule, seq: str | None = None, as_of=None) -> Written:
        """Apply ``batch`` under the conflict rule ``rule``."""
        return self.merge(batch, lambda stored, new: upsert.upsert(stored, new, rule, seq=seq, as_of=as_of))

    def keep_newest(self, batch: DataFrame, order: Sequence[str]) -> Written:
        """Of the stored and the new rows of a key, the one that is greatest in ``order`` (then in all its values) stays."""

        def newest(stored: DataFrame, new: DataFrame) -> DataFrame:
            names = self.schema.names
            rows = stored.select(*names).unionByName(schemas.conform(new, self.schema))
            value = F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in order], F.struct(*names).alias("row"))
            return rows.groupBy(*self.key).agg(F.max(value)["row"].alias("row")).select("row.*")

        return self.merge(batch, newest)


def keyed_table(root: str, name: str, buckets: int = BUCKETS, fmt: str = "parquet") -> KeyedTable:
    """The keyed table ``name`` with its declared schema, under ``root``."""
    return KeyedTable(f"{root.rstrip('/')}/{name}", tuple(schemas.KEYS[name]), schemas.ENTITY_SCHEMAS[name], buckets, fmt)


def bootstrap(spark: SparkSession, root: str, names: Sequence[str], fmt: str = "parquet") -> list[str]:
    """Create an empty table for each name that has none yet; repeating it changes nothing. Returns what was created."""
    return [name for name in names if keyed_table(root, name, fmt=fmt).create(spark)]
