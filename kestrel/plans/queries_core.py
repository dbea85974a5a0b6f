"""Core path: gold rollup, newest-N reads, keyed upserts, dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators import rollup
from kestrel.plans import bindings as b
from kestrel.plans.registry import AS_OF, AS_OF_SQL, ntz, register
from kestrel.session import scratch_path
from kestrel.sinks import keyed


def _repos(spark: SparkSession, sf: str) -> DataFrame:
    return b.repos(b.table(spark, sf, "orders"))


def _stories(spark: SparkSession, sf: str) -> DataFrame:
    return b.stories(b.table(spark, sf, "events"))


@register(
    "company_signals",
    f"""
WITH repos AS ({b.REPOS_SQL}), stories AS ({b.STORIES_SQL}),
gh AS (SELECT org, count(full_name) AS repo_count, sum(stars) AS total_stars,
              sum(forks) AS total_forks, sum(open_issues) AS total_open_issues
       FROM repos WHERE org IS NOT NULL GROUP BY org),
hn AS (SELECT company AS org, count(story_url) AS hn_mentions, sum(points) AS hn_points
       FROM stories WHERE company IS NOT NULL GROUP BY company)
SELECT coalesce(gh.org, hn.org) AS org,
       CAST(coalesce(repo_count, 0) AS BIGINT) AS repo_count,
       CAST(coalesce(total_stars, 0) AS BIGINT) AS total_stars,
       CAST(coalesce(total_forks, 0) AS BIGINT) AS total_forks,
       CAST(coalesce(total_open_issues, 0) AS BIGINT) AS total_open_issues,
       CAST(coalesce(hn_mentions, 0) AS BIGINT) AS hn_mentions,
       CAST(coalesce(hn_points, 0) AS BIGINT) AS hn_points,
       {AS_OF_SQL} AS computed_at
FROM gh FULL OUTER JOIN hn ON gh.org = hn.org
""",
)
def company_signals(spark: SparkSession, sf: str) -> DataFrame:
    """Gold: per-company repo and mention rollups combined (one aggregate over their union), zeros filled."""
    return ntz(rollup.company_signals(_repos(spark, sf), _stories(spark, sf), as_of=AS_OF))


# --- newest-N ---------------------------------------------------------------------------------
from kestrel.operators import newest, upsert  # noqa: E402
from kestrel.operators.joins import restrict_to  # noqa: E402

STORY_COLS = ["story_url", "company", "title", "points", "num_comments", "author", "created_at"]
REPO_COLS = ["full_name", "org", "name", "description", "language", "stars", "forks", "open_issues", "pushed_at"]


@register(
    "newest_per_company",
    f"""
WITH stories AS ({b.STORIES_SQL}), tracked AS ({b.TRACKED_SQL}),
r AS (SELECT s.*, row_number() OVER (PARTITION BY company ORDER BY created_at DESC NULLS LAST, story_url) AS rn
      FROM stories s WHERE company IN (SELECT org FROM tracked))
SELECT {", ".join(STORY_COLS)} FROM r WHERE rn <= 10
""",
)
def newest_per_company(spark: SparkSession, sf: str) -> DataFrame:
    """Per tracked company, its 10 newest stories (the default read size)."""
    s = restrict_to(_stories(spark, sf), b.tracked(b.table(spark, sf, "customer")), on="company", key_col="org")
    return ntz(newest.newest_per_group(s, "company", "created_at", 10, ["story_url"]).select(*STORY_COLS))


@register(
    "recent_repos_for_org",
    f"""
WITH repos AS ({b.REPOS_SQL})
SELECT {", ".join(REPO_COLS)} FROM repos WHERE org = '1'
ORDER BY pushed_at DESC NULLS LAST, full_name LIMIT 10
""",
)
def recent_repos_for_org(spark: SparkSession, sf: str) -> DataFrame:
    """``WHERE org = :org ORDER BY pushed_at DESC LIMIT 10`` (equality filter reaches the scan)."""
    return ntz(newest.recent_repos(_repos(spark, sf), org="1", limit=10).select(*REPO_COLS))


# --- keyed upserts -----------------------------------------------------------------------------
import datetime as _dt  # noqa: E402

LOAD1_AT = _dt.datetime(2024, 1, 16, 2, 0, 0)
LOAD2_AT = _dt.datetime(2024, 2, 1, 2, 0, 0)
STORY_SPLIT = "2024-01-16 00:00:00"
REPO_SPLIT = "1998-01-01 00:00:00"


def _coarse_stories(spark: SparkSession, sf: str) -> DataFrame:
    """Stories keyed per (company, kind): many arrivals share a key across both loads."""
    s = _stories(spark, sf)
    return s.withColumn("story_url", F.concat(F.lit("https://news.example.com/u/"), F.col("company"),
                                              F.lit("/"), F.col("title")))


COARSE_STORIES_SQL = f"""
SELECT 'https://news.example.com/u/' || company || '/' || title AS story_url, company, title, points,
       num_comments, author, created_at, seq
FROM ({b.STORIES_SQL})"""


def _two_loads(spark: SparkSession, name: str, rows: DataFrame, ts: str, split: str, seq: str) -> DataFrame:
    """Both loads into a bucketed keyed table; the second replaces only the buckets it touches."""
    cut = F.lit(split).cast("timestamp")
    table = keyed.keyed_table(scratch_path(spark, "keyed"), name, buckets=16)
    for load, at in ((rows.where(F.col(ts) < cut), LOAD1_AT), (rows.where(F.col(ts) >= cut), LOAD2_AT)):
        table.upsert(load, upsert.RULES[name], seq=seq, as_of=at)
    return table.read(spark)


def _upsert_oracle(src_sql: str, key: str, kept: list[str], refreshed: list[str], ts: str, split: str,
                   seq: str) -> str:
    in2 = f"{ts} >= TIMESTAMP '{split}'"
    k = ", ".join(
        f"CASE WHEN n1 > 0 THEN k1_{c} ELSE k2_{c} END AS {c}" for c in kept
    )
    r = ", ".join(
        f"CASE WHEN n2 > 0 THEN r2_{c} ELSE r1_{c} END AS {c}" for c in refreshed
    )
    aggs = ", ".join(
        [f"arg_min_null({c}, {seq}) FILTER (WHERE NOT ({in2})) AS k1_{c}, arg_min_null({c}, {seq}) FILTER (WHERE {in2}) AS k2_{c}" for c in kept]
        + [f"arg_max_null({c}, {seq}) FILTER (WHERE NOT ({in2})) AS r1_{c}, arg_max_null({c}, {seq}) FILTER (WHERE {in2}) AS r2_{c}" for c in refreshed]
    )
    return f"""
WITH src AS ({src_sql}),
a AS (SELECT {key}, count(*) FILTER (WHERE NOT ({in2})) AS n1, count(*) FILTER (WHERE {in2}) AS n2, {aggs}
      FROM src GROUP BY {key})
SELECT {key}, {k}, {r},
       CASE WHEN n2 > 0 THEN TIMESTAMP '{LOAD2_AT:%Y-%m-%d %H:%M:%S}' ELSE TIMESTAMP '{LOAD1_AT:%Y-%m-%d %H:%M:%S}' END AS scraped_at
FROM a"""


@register(
    "upsert_stories",
    _upsert_oracle(COARSE_STORIES_SQL, "story_url", list(upsert.STORIES_RULE.kept),
                   list(upsert.STORIES_RULE.refreshed), "created_at", STORY_SPLIT, "seq"),
)
def upsert_stories(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads into the story table: kept columns from the first arrival, counters refreshed."""
    out = _two_loads(spark, "hn_stories", _coarse_stories(spark, sf), "created_at", STORY_SPLIT, "seq")
    return ntz(out)


COARSE_REPOS_SQL = f"""
SELECT org || '/' || language AS full_name, org, name, description, language, stars, forks, open_issues,
       pushed_at, seq
FROM (SELECT *, CAST(split_part(full_name, '/', 2) AS BIGINT) AS seq FROM ({b.REPOS_SQL}))"""


@register(
    "upsert_repos",
    _upsert_oracle(COARSE_REPOS_SQL, "full_name", list(upsert.REPOS_RULE.kept),
                   list(upsert.REPOS_RULE.refreshed), "pushed_at", REPO_SPLIT, "seq"),
)
def upsert_repos(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads into the repo table: org/name kept, metrics refreshed."""
    orders = b.table(spark, sf, "orders")
    r = b.repos(orders).withColumn("seq", F.col("name").cast("bigint"))
    r = r.withColumn("full_name", F.concat(F.col("org"), F.lit("/"), F.col("language")))
    return ntz(_two_loads(spark, "github_repos", r, "pushed_at", REPO_SPLIT, "seq"))


# --- dedup, last wins --------------------------------------------------------------------------
@register(
    "dedup_last_wins",
    """
SELECT sha256(text) AS text_key, max(doc_id) AS doc_id, arg_max_null(lang, doc_id) AS lang,
       arg_max_null(source, doc_id) AS source, arg_max_null(n_chars, doc_id) AS n_chars, count(*) AS copies
FROM documents GROUP BY sha256(text)
""",
)
def dedup_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Documents deduplicated on their whole text; the last arrival (highest doc_id) wins."""
    docs = b.table(spark, sf, "documents").select(
        F.sha2("text", 256).alias("text_key"), "doc_id", "lang", "source", "n_chars"
    )
    # One aggregate: the last copy's values and the number of copies per text.
    packed = F.struct("doc_id", "lang", "source", "n_chars")
    agg = docs.groupBy("text_key").agg(F.max_by(packed, F.col("doc_id")).alias("__v"), F.count(F.lit(1)).alias("copies"))
    return agg.select("text_key", "__v.*", "copies")
