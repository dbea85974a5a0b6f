"""Keyed dedup, last arrival wins.

``max_by(struct(values), seq)`` is an ordinary partial/final aggregate, so duplicates
collapse map-side before the shuffle and a hot key costs one hash entry per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_wins(df: DataFrame, key: str | Sequence[str], seq: str, keep_seq: bool = False) -> DataFrame:
    """One row per key holding the values of the row with the greatest ``seq``; a null ``seq`` is older than any."""
    keys = [key] if isinstance(key, str) else list(key)
    vals = [c for c in df.columns if c not in keys and (keep_seq or c != seq)]
    packed = F.struct(*[F.col(c) for c in vals])
    return (
        df.groupBy(*keys)
        .agg(F.max_by(packed, F.struct(F.col(seq).isNotNull(), F.col(seq))).alias("__v"))
        .select(*keys, *[F.col("__v")[c].alias(c) for c in vals])
    )
