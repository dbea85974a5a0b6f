"""Join helpers. Which side is broadcast is left to the planner, which knows the sizes at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def restrict_to(df: DataFrame, keys: DataFrame, on: str, key_col: str | None = None) -> DataFrame:
    """Keep rows of ``df`` whose ``on`` value is in ``keys`` (left semi join, set semantics)."""
    k = keys.select(F.col(key_col or on).alias(on)).where(F.col(on).isNotNull())
    return df.join(k, on=on, how="left_semi")
