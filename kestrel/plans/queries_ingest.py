"""Payload normalisation queries: landed responses rendered from the tables, parsed back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.plans import bindings as b
from kestrel.plans import landing
from kestrel.plans.registry import ntz, register
from kestrel.sources import payloads


@register("parse_story_payload", landing.STORY_EXPECTED_SQL)
def parse_story_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Story search pages -> stories: title/author/points defaults and the fallback story key."""
    pages = landing.story_pages(b.table(spark, sf, "events"))
    out = payloads.parse_stories(pages, company="company")
    return ntz(out.select("company", "title", "url", "points", "author", "created_at", "num_comments", "story_url"))


@register("parse_repo_payload", landing.REPO_EXPECTED_SQL)
def parse_repo_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Repo list pages -> github_repos rows; records without ``pushed_at`` are quarantined."""
    pages = landing.repo_pages(b.table(spark, sf, "orders"))
    valid = payloads.parse_repos(pages, org="org")
    return ntz(valid.drop("scraped_at"))


@register(
    "repo_quarantine",
    """
SELECT 'missing pushed_at' AS _bad, CAST(o_custkey AS VARCHAR) AS org, count(*) AS records
FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2""",
)
def repo_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Quarantined repo records per reason and org."""
    pages = landing.repo_pages(b.table(spark, sf, "orders"))
    _, bad = payloads.parse_repos(pages, org="org", with_quarantine=True)
    return bad.groupBy("_bad", "org").agg(F.count(F.lit(1)).alias("records"))


@register("parse_forum_payload", landing.POST_EXPECTED_SQL)
def parse_forum_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Forum listing pages -> posts with falsy defaults and epoch-second timestamps."""
    pages = landing.post_pages(b.table(spark, sf, "events"))
    return ntz(payloads.parse_posts(pages, subreddit="subreddit"))


@register("parse_company_facts", landing.FACTS_EXPECTED_SQL)
def parse_company_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Search + summary responses -> company facts (no hit or 404 -> no row; title fallback)."""
    customer = b.table(spark, sf, "customer")
    titles = payloads.resolve_titles(landing.search_pages(customer))
    facts = payloads.parse_facts(titles, landing.summary_pages(customer))
    return facts.drop("scraped_at")


@register("parse_contributors", landing.CONTRIB_EXPECTED_SQL)
def parse_contributors(spark: SparkSession, sf: str) -> DataFrame:
    """Contributor pages -> (repo, login, contributions, avatar_url)."""
    pages = landing.contributor_pages(b.table(spark, sf, "lineitem"))
    return payloads.parse_contributors(pages)


LISTING_SQL = r"""
WITH p AS (SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS company, url,
                  unnest(regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1)) AS blk FROM pages),
x AS (SELECT company, url,
             trim(replace(replace(replace(replace(replace(replace(replace(
                 regexp_replace(regexp_extract(blk, '(?s)<a[^>]*>(.*?)</a>', 1), '<[^>]+>', '', 'g'),
                 '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', ' '), '&amp;', '&')) AS title,
             regexp_extract(regexp_extract(blk, '<a[^>]*>', 0), 'href\s*=\s*"([^"]*)"', 1) AS href
      FROM p)
SELECT company, title, CAST(NULL AS VARCHAR) AS location, CAST(NULL AS VARCHAR) AS posted_at,
       CASE WHEN href <> '' THEN href ELSE url END AS source_url
FROM x WHERE title <> ''"""


@register("listing_extract", LISTING_SQL)
def listing_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Web pages read as a link-list board -> job listings (company = host of the page)."""
    pages = b.table(spark, sf, "pages").select(
        F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("company"), "url", "html"
    )
    return payloads.parse_listings(pages, "links", company="company")


@register(
    "newest_posts_per_forum",
    f"""
SELECT subreddit, title, score, num_comments, author, created_utc, permalink FROM (
  SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY created_utc DESC NULLS LAST, permalink, title, author,
                                                   score, num_comments) AS rn
  FROM ({landing.POST_EXPECTED_SQL})) WHERE rn <= 25""",
)
def newest_posts_per_forum(spark: SparkSession, sf: str) -> DataFrame:
    """The 25 newest posts of every forum (the per-forum search size), from parsed listings."""
    from kestrel.operators import newest

    posts = payloads.parse_posts(landing.post_pages(b.table(spark, sf, "events")), subreddit="subreddit")
    # Full tie-break: rows that still tie are identical, so the result is deterministic.
    return ntz(newest.newest_per_group(posts, "subreddit", "created_utc", 25,
                                       ["permalink", "title", "author", "score", "num_comments"]))


@register(
    "payload_field_counts",
    """
SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS events, count(DISTINCT user_id) AS companies
FROM events GROUP BY 1""",
)
def payload_field_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Typed parse of the event payloads (only the used field is parsed) and a histogram of it."""
    ev = b.table(spark, sf, "events")
    parsed = ev.select(F.from_json("props", "k int, other string")["k"].alias("k"), "user_id")
    return parsed.groupBy("k").agg(F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("companies"))
