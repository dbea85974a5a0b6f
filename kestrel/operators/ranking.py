"""Skew-safe ranking within groups (``rank`` / ``dense_rank`` / ``percent`` share).

A plain ``rank() OVER (PARTITION BY g ORDER BY v)`` sorts a whole group in one task; if
one group holds a third of the table, that task holds a third of the table. Here:

1. rows are pre-aggregated to distinct ``(g, v)`` with their multiplicity (partial
   aggregation collapses duplicates map-side);
2. values are cut into ``buckets`` slices at approximate quantiles of the whole column, a
   handful of literals: no join, and a group that is a third of the rows is a third of what the
   quantiles divide, so it spreads over about that share of the buckets at least;
3. per ``(g, bucket)`` totals give every bucket its offset (a window over at most
   ``buckets + 1`` rows per group);
4. the rank inside a bucket is a window over ``(g, bucket)`` only;
5. ranks go back to the rows by a null-safe join on ``(g, v)`` of two plain shuffles, which is
   split at run time where one value is hot.

A null group is a group like any other. Equal values always land in the same bucket, so ties are exact. Null values sort last
for descending and first for ascending order, as Spark does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import materialize as materialize_table



def rank_within(df: DataFrame, group: str | Sequence[str], value: str, out: str = "rank",
                method: str = "rank", descending: bool = True, buckets: int = 32,
                accuracy: int = 10_000, materialize: bool = True) -> DataFrame:
    """``df`` plus column ``out``: the rank (1-based, bigint) of ``value`` inside its group.

    The distinct ``(group, value)`` table feeds the bucket bounds, the bucket totals and
    the in-bucket ranks; with ``materialize`` it is computed once and written under the
    shared folder instead of being recomputed from the input for each use.
    """
    if method not in ("rank", "dense_rank"):
        raise ValueError(f"unknown method {method!r}")
    groups = [group] if isinstance(group, str) else list(group)
    v = F.col(value)
    distinct = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("__cnt"))
    if materialize:
        distinct = materialize_table(distinct, "rank-distinct")

    cuts: list = []
    if buckets > 1:
        probs = [i / buckets for i in range(1, buckets)]
        cuts = distinct.agg(F.percentile_approx(value, probs, accuracy).alias("c")).first()["c"] or []
    slice_ = F.lit(0)
    for cut in sorted(set(cuts)):
        slice_ = slice_ + (v > F.lit(cut)).cast("int")
    # Nulls: after everything when descending, before everything when ascending.
    tagged = distinct.select(*groups, value, "__cnt", F.when(v.isNull(), F.lit(-1)).otherwise(slice_).alias("__b"))

    per_bucket = tagged.groupBy(*groups, "__b").agg(
        F.sum("__cnt").alias("__rows"), F.count(F.lit(1)).alias("__vals")
    )
    b_order = F.col("__b").desc() if descending else F.col("__b").asc()
    w_b = Window.partitionBy(*groups).orderBy(b_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *groups, "__b",
        F.coalesce(F.sum("__rows").over(w_b), F.lit(0)).alias("__row_off"),
        F.coalesce(F.sum("__vals").over(w_b), F.lit(0)).alias("__val_off"),
    )
    v_order: Column = v.desc_nulls_last() if descending else v.asc_nulls_first()
    w_in = Window.partitionBy(*groups, "__b").orderBy(v_order)
    local = tagged.select(
        *groups, value, "__b",
        (F.coalesce(F.sum("__cnt").over(w_in.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1).alias("__lr"),
        F.row_number().over(w_in).alias("__ld"),
    )
    same = [local[c].eqNullSafe(offsets[c]) for c in (*groups, "__b")]
    ranks = local.join(offsets, on=same, how="inner").drop(*[offsets[c] for c in (*groups, "__b")])
    r = (F.col("__row_off") + F.col("__lr")) if method == "rank" else (F.col("__val_off") + F.col("__ld"))
    ranks = ranks.select(*groups, value, r.cast("bigint").alias(out))
    return _join_back(df, ranks, groups, value)


def _join_back(df: DataFrame, ranks: DataFrame, groups: list[str], value: str) -> DataFrame:
    # Null-safe on the value (null values are ranked too).
    cond = [df[g].eqNullSafe(ranks[g]) for g in groups] + [df[value].eqNullSafe(ranks[value])]
    keep = [ranks[c] for c in ranks.columns if c not in groups and c != value]
    # No hint: AQE broadcasts the rank table at runtime when it turns out small.
    return df.join(ranks, on=cond, how="inner").select(df["*"], *keep)
