"""Compaction and multi-column clustering of plain files.

Rows are ordered by interleaving the bits of their ranks in every clustering column, so that rows near each other in
all columns share a file, and a filter on any of the columns skips most files by their minima and maxima.
A rank is the place among quantiles of the column, which are taken from a bounded sample; the sample decides the
layout only. The number of files follows from the bytes of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import folder_bytes

#: 2**BITS ranks a column, found in two steps of 2**(BITS / 2); sampled rows; bytes aimed at in a file.
BITS, SAMPLE_ROWS, FILE_BYTES = 8, 20_000, 256 << 20


def quantiles(df: DataFrame, columns: Sequence[str], bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """Up to 2**bits - 1 cut values of each column, from about ``sample_rows`` rows taken by a hash of their place."""
    share = max(1, df.count() // sample_rows)
    placed = df.select(*columns, F.monotonically_increasing_id().alias("__place"))
    sample = placed.where(F.pmod(F.xxhash64("__place"), F.lit(share)) == 0).select(*columns).collect()
    cuts = {}
    for c in columns:
        values = sorted(r[c] for r in sample if r[c] is not None)
        n = 1 << bits
        cuts[c] = sorted({values[len(values) * i // n] for i in range(1, n)}) if values else []
    return cuts


def rank(column: Column, cuts: list, bits: int = BITS) -> Column:
    """How many of ``cuts`` are not above the value; a null ranks lowest. Two short searches instead of one long."""
    if not cuts:
        return F.lit(0)
    width = 1 << (bits + 1) // 2
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    at = F.size(F.filter(heads, lambda x: x <= column))
    within = F.element_at(F.array(*[F.array(*map(F.lit, g)) for g in groups]), at)
    return F.when(column.isNull() | (at <= 0), F.lit(0)).otherwise((at - 1) * width + F.size(F.filter(within, lambda x: x <= column)))


def interleaved_key(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the ranks in turn, highest first."""
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for i, r in enumerate(ranks):
            one = F.shiftright(r.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(ranks) + len(ranks) - 1 - i))
    return key


def clustered(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """``df`` in ``files`` ranges of the interleaved key, each sorted by it."""
    cuts = quantiles(df, columns, bits)
    keyed = df.withColumn("__rank", F.array(*[rank(F.col(c), cuts[c], bits).cast("int") for c in columns]))
    keyed = keyed.withColumn("__key", interleaved_key([F.col("__rank")[i] for i in range(len(columns))], bits))
    # Rows of one key may go to several files: a hot value is split by the columns' values and a hash of the row.
    spread = F.xxhash64(*df.columns)
    return keyed.repartitionByRange(files, "__key", *columns, spread).sortWithinPartitions("__key", *columns).select(*df.columns)


def compact(spark: SparkSession, path: str, target: str, columns: Sequence[str], fmt: str = "parquet", file_bytes: int = FILE_BYTES) -> int:
    """Write the table at ``path`` compacted and clustered by ``columns`` to ``target``; returns the number of files.

    Where the format does this in place (delta), ``target`` is ignored.
    """
    if fmt == "delta":
        spark.sql(f"OPTIMIZE delta.`{path}` ZORDER BY ({', '.join(columns)})")
        return 0
    files = max(1, -(-folder_bytes(spark, path) // file_bytes))
    clustered(spark.read.format(fmt).load(path), columns, files).write.save(target, format=fmt, mode="overwrite")
    return files
