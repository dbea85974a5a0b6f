"""Newest-N reads: global top-k and per-company top-k.

Global newest-N compiles to ``TakeOrderedAndProject`` (each task keeps N rows, the driver
merges N x tasks). Per-company newest-N uses ``row_number`` with a ``<= n`` filter, which
Catalyst turns into a partial ``WindowGroupLimit`` *before* the shuffle and a final one
after: a company that owns a third of the table ships at most N rows per map task, so the
hot key never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(ts: str, tiebreak: Sequence[str]) -> list[Column]:
    return [F.col(ts).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tiebreak]


def newest(df: DataFrame, ts: str, n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """``ORDER BY ts DESC [, tiebreak] LIMIT n``."""
    return df.orderBy(*_order(ts, tiebreak)).limit(n)


def newest_per_group(df: DataFrame, group: str | Sequence[str], ts: str, n: int,
                     tiebreak: Sequence[str] = (), rank_col: str | None = None) -> DataFrame:
    """At most ``n`` newest rows per group (ties broken by ``tiebreak`` ascending)."""
    groups = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*groups).orderBy(*_order(ts, tiebreak))
    rn = rank_col or "__rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def for_company(df: DataFrame, company_col: str, company: str, ts: str, limit: int,
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """One company's newest rows: equality filter (pushed to the scan) then newest-N."""
    return newest(df.where(F.col(company_col) == F.lit(company)), ts, limit, tiebreak)


def recent_repos(repos: DataFrame, org: str, limit: int = 10) -> DataFrame:
    """Newest repos of one org by ``pushed_at`` (default 10), key as tie-break."""
    return for_company(repos, "org", org, "pushed_at", limit, ["full_name"])


def recent_stories(stories: DataFrame, company: str, limit: int = 10) -> DataFrame:
    """Newest stories of one company by ``created_at`` (default 10), key as tie-break."""
    return for_company(stories, "company", company, "created_at", limit, ["story_url"])


def recent_failures(alerts: DataFrame, limit: int = 20,
                    tiebreak: Sequence[str] = ("table", "segment", "check_name")) -> DataFrame:
    """Newest failing data-quality results (``WHERE NOT passed``), default 20."""
    tb = [c for c in tiebreak if c in alerts.columns]
    return newest(alerts.where(~F.col("passed")), "measured_at", limit, tb)
