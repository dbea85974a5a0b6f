"""Per-company gold aggregate: repo rollup full-outer-joined with the mention rollup.

Plan shape: the full outer join of two per-company aggregates is computed as ONE
aggregate over the union of both inputs (each side's metrics null on the other side's
rows). That is a single partial+final hash aggregate keyed by company: map-side combine
(a company holding a third of all rows costs one hash-table entry per task), one
shuffle, and no join or sort at all. A company seen on either side gets one row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPO_METRICS = ["repo_count", "total_stars", "total_forks", "total_open_issues"]
MENTION_METRICS = ["hn_mentions", "hn_points"]


def repo_rollup(repos: DataFrame, org: str = "org") -> DataFrame:
    """``groupBy(org)``: non-null repo count and star/fork/issue sums. Null orgs are dropped."""
    return (
        repos.where(F.col(org).isNotNull())
        .groupBy(F.col(org).alias("org"))
        .agg(
            F.count("full_name").alias("repo_count"),
            F.sum("stars").cast("bigint").alias("total_stars"),
            F.sum("forks").cast("bigint").alias("total_forks"),
            F.sum("open_issues").cast("bigint").alias("total_open_issues"),
        )
    )


def mention_rollup(stories: DataFrame, company: str = "company") -> DataFrame:
    """``groupBy(company)`` renamed to ``org``: mention count and point sum."""
    return (
        stories.where(F.col(company).isNotNull())
        .groupBy(F.col(company).alias("org"))
        .agg(
            F.count("story_url").alias("hn_mentions"),
            F.sum("points").cast("bigint").alias("hn_points"),
        )
    )


def _as_of(as_of: dt.datetime | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def company_signals(repos: DataFrame, stories: DataFrame, as_of=None,
                    org: str = "org", company: str = "company") -> DataFrame:
    """One gold row per company seen on either side; missing metrics are 0 (bigint).

    An empty input side yields a typed empty rollup, so both-empty gives an empty gold frame.
    ``computed_at`` is one value for the whole snapshot (``as_of``, default now).
    """
    nul = {t: F.lit(None).cast(t) for t in ("string", "bigint")}
    gh = repos.where(F.col(org).isNotNull()).select(
        F.col(org).alias("org"), F.col("full_name").alias("__repo"),
        F.col("stars").cast("bigint").alias("__stars"), F.col("forks").cast("bigint").alias("__forks"),
        F.col("open_issues").cast("bigint").alias("__issues"),
        nul["string"].alias("__story"), nul["bigint"].alias("__points"),
    )
    hn = stories.where(F.col(company).isNotNull()).select(
        F.col(company).alias("org"), nul["string"].alias("__repo"), nul["bigint"].alias("__stars"),
        nul["bigint"].alias("__forks"), nul["bigint"].alias("__issues"),
        F.col("story_url").alias("__story"), F.col("points").cast("bigint").alias("__points"),
    )
    agg = gh.unionByName(hn).groupBy("org").agg(
        F.count("__repo").alias("repo_count"),
        F.coalesce(F.sum("__stars"), F.lit(0)).alias("total_stars"),
        F.coalesce(F.sum("__forks"), F.lit(0)).alias("total_forks"),
        F.coalesce(F.sum("__issues"), F.lit(0)).alias("total_open_issues"),
        F.count("__story").alias("hn_mentions"),
        F.coalesce(F.sum("__points"), F.lit(0)).alias("hn_points"),
    )
    return agg.select(
        "org", *[F.col(c).cast("bigint").alias(c) for c in REPO_METRICS + MENTION_METRICS],
        _as_of(as_of).alias("computed_at"),
    )
