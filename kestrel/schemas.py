"""Declared schemas for every entity. Nothing is inferred: frames are built or cast to these."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, TS, B, D = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType(), T.BooleanType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


GITHUB_REPOS = _struct(
    ("full_name", S, False), ("org", S, False), ("name", S, False), ("description", S, True),
    ("language", S, True), ("stars", I, False), ("forks", I, False), ("open_issues", I, False),
    ("pushed_at", TS, False), ("scraped_at", TS, True),
)
HN_STORIES = _struct(
    ("story_url", S, False), ("company", S, False), ("title", S, False), ("points", I, False),
    ("num_comments", I, False), ("author", S, False), ("created_at", TS, False), ("scraped_at", TS, True),
)
REDDIT_POSTS = _struct(
    ("subreddit", S, False), ("title", S, False), ("score", I, False), ("num_comments", I, False),
    ("author", S, False), ("created_utc", TS, False), ("permalink", S, False),
)
JOB_LISTINGS = _struct(
    ("company", S, False), ("title", S, False), ("location", S, True), ("posted_at", S, True),
    ("source_url", S, False),
)
WIKIPEDIA_COMPANIES = _struct(
    ("name", S, False), ("title", S, False), ("summary", S, True), ("description", S, True),
    ("url", S, True), ("thumbnail_url", S, True), ("scraped_at", TS, True),
)
REPO_CONTRIBUTORS = _struct(("login", S, False), ("contributions", I, False), ("avatar_url", S, True))
DQ_RESULT = _struct(
    ("check_name", S, False), ("table", S, False), ("passed", B, False), ("severity", S, False),
    ("message", S, False), ("measured_at", TS, False), ("segment", S, True),
)
COMPANY_SIGNALS = _struct(
    ("org", S, False), ("repo_count", L, False), ("total_stars", L, False), ("total_forks", L, False),
    ("total_open_issues", L, False), ("hn_mentions", L, False), ("hn_points", L, False),
    ("computed_at", TS, False),
)

# Primary keys of the keyed tables (operational store).
KEYS = {
    "github_repos": ["full_name"],
    "hn_stories": ["story_url"],
    "reddit_posts": ["permalink"],
    "job_listings": ["source_url"],
    "wikipedia_companies": ["name"],
    "repo_contributors": ["repo", "login"],
}

# Columns that must be non-null for a parsed record to be accepted (else quarantined).
REQUIRED = {
    name: [f.name for f in schema.fields if not f.nullable and f.name != "scraped_at"]
    for name, schema in {
        "github_repos": GITHUB_REPOS,
        "hn_stories": HN_STORIES,
        "reddit_posts": REDDIT_POSTS,
        "job_listings": JOB_LISTINGS,
        "wikipedia_companies": WIKIPEDIA_COMPANIES,
    }.items()
}

ENTITY_SCHEMAS = {
    "github_repos": GITHUB_REPOS,
    "hn_stories": HN_STORIES,
    "reddit_posts": REDDIT_POSTS,
    "job_listings": JOB_LISTINGS,
    "wikipedia_companies": WIKIPEDIA_COMPANIES,
    "repo_contributors": REPO_CONTRIBUTORS,
    "dq_alerts": DQ_RESULT,
    "company_signals": COMPANY_SIGNALS,
}

# Event-time column per entity (None: no reliable event time).
EVENT_TIME = {
    "github_repos": "pushed_at",
    "hn_stories": "created_at",
    "reddit_posts": "created_utc",
    "job_listings": None,
    "dq_alerts": "measured_at",
    "company_signals": "computed_at",
}


def conform(df, schema: T.StructType):
    """Select and cast ``df`` to ``schema`` (missing columns become typed nulls).

    Every write goes through this so that parquet appends never see an int/bigint
    mix (parquet schema merge rejects it).
    """
    from pyspark.sql import functions as F

    cols = []
    present = set(df.columns)
    for f in schema.fields:
        c = F.col(f.name) if f.name in present else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
