"""Signal queries: baselines, integrity, shares, cadence, contributors, ranks, volume,
sentiment, hiring, alerts, windows, page extraction and mention matching."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators import ranking, rollup, signals
from kestrel.plans import bindings as b
from kestrel.plans.registry import AS_OF, AS_OF_SQL, ntz, register
from kestrel.session import materialize, scratch_path
from kestrel.sinks import lake
from kestrel.sources import payloads
from kestrel.streaming import windows


def _wp(alts: str) -> str:
    return signals.word_pattern(alts)


@register(
    "rolling_baseline",
    """
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2),
spine AS (SELECT event_type, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d GROUP BY event_type),
c AS (SELECT event_type, day, coalesce(n, 0) AS n FROM spine LEFT JOIN d USING (event_type, day)),
w AS (SELECT *, avg(n) OVER win AS m, stddev_pop(n) OVER win AS s, count(n) OVER win AS nb
      FROM c WINDOW win AS (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)),
z AS (SELECT *, (n - m) / CASE WHEN s IS NULL OR s = 0 THEN 1.0 ELSE s END AS zz FROM w)
SELECT event_type, day, n, round(m, 6) AS baseline_mean, round(s, 6) AS baseline_std,
       CAST(nb AS BIGINT) AS baseline_days, round(zz, 6) AS z,
       CASE WHEN nb > 0 THEN abs(zz) <= 3.0 ELSE true END AS passed
FROM z""",
)
def rolling_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """Daily event counts per type against the trailing 7-day mean and population std."""
    counts = signals.daily_counts(b.table(spark, sf, "events"), "ts", "event_type")
    return signals.rolling_baseline(counts, "event_type", days=7)


# Foreign keys checked for orphans (fixed values): (relation, child, child key, parent, parent key).
RELATIONS = [
    ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("customer.c_nationkey->nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier.s_nationkey->nation", "supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation.n_regionkey->region", "nation", "n_regionkey", "region", "r_regionkey"),
    ("events.user_id->customer", "events", "user_id", "customer", "c_custkey"),
    ("labels.doc_id->documents", "labels", "doc_id", "documents", "doc_id"),
]


def _integrity_sql() -> str:
    parts = []
    for rel, c, ck, p, pk in RELATIONS:
        parts.append(
            f"SELECT '{rel}' AS relation, (SELECT count(*) FROM {c}) AS child_rows, "
            f"CAST(count(*) AS BIGINT) AS orphan_rows, count(DISTINCT x.{ck}) AS orphan_keys, count(*) = 0 AS passed "
            f"FROM {c} x WHERE x.{ck} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pk} = x.{ck})"
        )
    return "\nUNION ALL\n".join(parts)


@register("referential_integrity", _integrity_sql())
def referential_integrity(spark: SparkSession, sf: str) -> DataFrame:
    """Orphan child rows for every foreign key among the tables (pass iff none)."""
    out = None
    for rel, c, ck, p, pk in RELATIONS:
        o = signals.orphans(b.table(spark, sf, c), ck, b.table(spark, sf, p), pk).select(
            F.lit(rel).alias("relation"), "child_rows", "orphan_rows", "orphan_keys",
            (F.col("orphan_rows") == 0).alias("passed"))
        out = o if out is None else out.unionByName(o)
    return out


@register(
    "language_share",
    f"""
WITH repos AS ({b.REPOS_SQL}),
a AS (SELECT org, language, count(*) AS repo_count, CAST(sum(stars) AS BIGINT) AS total_stars FROM repos GROUP BY 1, 2)
SELECT org, language, repo_count, total_stars,
       round(repo_count / sum(repo_count) OVER (PARTITION BY org), 6) AS share FROM a""",
)
def language_share(spark: SparkSession, sf: str) -> DataFrame:
    """Per org and language: repos, stars and the share of the org's repos."""
    return signals.language_share(b.repos(b.table(spark, sf, "orders")))


@register(
    "activity_cadence",
    f"""
SELECT company, count(*) AS events, min(created_at) AS first_at, max(created_at) AS last_at,
       CASE WHEN count(*) > 1 THEN round((epoch_us(max(created_at)) - epoch_us(min(created_at))) / 86400000000.0
                                         / (count(*) - 1), 6) END AS mean_gap_days
FROM ({b.STORIES_SQL}) GROUP BY company""",
)
def activity_cadence(spark: SparkSession, sf: str) -> DataFrame:
    """Mean days between consecutive stories per company."""
    return ntz(signals.cadence(b.stories(b.table(spark, sf, "events")), "company", "created_at"))


@register(
    "contributor_stats",
    """
SELECT CAST(l_orderkey AS VARCHAR) AS repo, count(*) AS contributors,
       CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS contributions,
       arg_max('supp' || CAST(l_suppkey AS VARCHAR), {'a': CAST(l_quantity AS INTEGER), 'b': -l_suppkey}) AS top_contributor
FROM lineitem GROUP BY l_orderkey""",
)
def contributor_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Per repo: contributor count, total contributions and the top contributor."""
    li = b.table(spark, sf, "lineitem")
    c = li.select(F.col("l_orderkey").cast("string").alias("repo"),
                  F.concat(F.lit("supp"), F.col("l_suppkey").cast("string")).alias("login"),
                  F.col("l_quantity").cast("int").alias("contributions"), F.col("l_suppkey").alias("__key"))
    return signals.contributor_stats(c, "repo", order_key="__key")


@register(
    "story_rank",
    f"""
SELECT story_url, company, points, CAST(rank() OVER (PARTITION BY company ORDER BY points DESC NULLS LAST) AS BIGINT) AS rank
FROM ({b.STORIES_SQL})""",
)
def story_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Rank of every story by points within its company (skew-safe bucketed rank)."""
    s = b.stories(b.table(spark, sf, "events")).select("story_url", "company", "points")
    return ranking.rank_within(s, "company", "points", out="rank", method="rank")


@register(
    "peer_rank",
    f"""
WITH g AS (SELECT org, CAST(sum(stars) AS BIGINT) AS total_stars
           FROM (SELECT org, stars FROM ({b.REPOS_SQL}) UNION ALL SELECT company, 0 FROM ({b.STORIES_SQL})) GROUP BY org),
j AS (SELECT g.org, c.c_nationkey AS peer_group, g.total_stars FROM g JOIN customer c ON g.org = CAST(c.c_custkey AS VARCHAR))
SELECT org, peer_group, total_stars,
       CAST(dense_rank() OVER (PARTITION BY peer_group ORDER BY total_stars DESC) AS BIGINT) AS peer_rank,
       round(CASE WHEN sum(total_stars) OVER (PARTITION BY peer_group) <> 0
                  THEN total_stars / sum(total_stars) OVER (PARTITION BY peer_group) END, 6) AS peer_share
FROM j""",
)
def peer_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Dense rank and share of stars among companies of the same nation (peer group)."""
    repos = b.repos(b.table(spark, sf, "orders"))
    stories = b.stories(b.table(spark, sf, "events"))
    gold = rollup.company_signals(repos, stories, as_of=AS_OF)
    peers = b.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("org"),
                                                  F.col("c_nationkey").alias("peer_group"))
    return signals.peer_rank(gold, peers, "total_stars", "peer_group")


@register(
    "forum_volume",
    """
SELECT CAST(user_id AS VARCHAR) AS company, 'r_' || event_type AS subreddit, count(*) AS mentions,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS total_comments,
       CAST(sum(CAST(floor(value) AS INTEGER)) AS BIGINT) AS total_score
FROM events GROUP BY 1, 2""",
)
def forum_volume(spark: SparkSession, sf: str) -> DataFrame:
    """Mentions, comment volume and score per company and forum."""
    ev = b.table(spark, sf, "events")
    posts = ev.select(
        F.col("user_id").cast("string").alias("company"), F.concat(F.lit("r_"), F.col("event_type")).alias("subreddit"),
        F.get_json_object("props", "$.k").cast("int").alias("num_comments"), F.floor("value").cast("int").alias("score"),
    )
    return signals.forum_volume(posts)


def _lexicon_sql() -> str:
    vals = ", ".join(f"('{w}', {wt!r})" for w, wt in sorted(signals.LEXICON.items()))
    return f"(SELECT * FROM (VALUES {vals}) v(word, weight))"


@register(
    "sentiment",
    f"""
WITH t AS (SELECT source, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS toks
           FROM documents),
tot AS (SELECT source, count(*) AS documents, CAST(sum(len(toks)) AS BIGINT) AS tokens FROM t GROUP BY source),
h AS (SELECT source, count(*) AS hits, sum(weight) AS weight
      FROM (SELECT source, unnest(toks) AS word FROM t) JOIN {_lexicon_sql()} USING (word) GROUP BY source)
SELECT tot.source, documents, tokens, CAST(coalesce(hits, 0) AS BIGINT) AS hits,
       round(coalesce(weight, 0.0) / tokens, 6) AS score
FROM tot LEFT JOIN h USING (source)""",
)
def sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """Lexicon sentiment per document source over whole texts."""
    docs = b.table(spark, sf, "documents")
    return signals.sentiment(docs, "source")


def _role_sql(title: str) -> str:
    expr = "'other'"
    for name, pattern in reversed(signals.ROLE_FAMILIES):
        expr = f"CASE WHEN regexp_matches({title}, '{_wp(pattern)}') THEN '{name}' ELSE {expr} END"
    return expr


@register(
    "hiring_signals",
    f"""
WITH l AS ({__import__('kestrel.plans.queries_ingest', fromlist=['x']).LISTING_SQL})
SELECT company, location, {_role_sql('title')} AS role_family, count(*) AS openings FROM l GROUP BY ALL""",
)
def hiring_signals(spark: SparkSession, sf: str) -> DataFrame:
    """Open roles per company, location and role family from the extracted listings."""
    pages = b.table(spark, sf, "pages").select(
        F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("company"), "url", "html")
    return signals.hiring_signals(payloads.parse_listings(pages, "links", company="company"))


def _alerts_sql() -> str:
    parts = []
    for name, pattern in signals.ALERT_RULES:
        parts.append(
            f"SELECT 'mention[{name}]' AS check_name, 'documents' AS \"table\", false AS passed, 'info' AS severity, "
            f"'doc_id=' || CAST(doc_id AS VARCHAR) AS message, {AS_OF_SQL} AS measured_at, source AS segment "
            f"FROM documents WHERE regexp_matches(lower(text), '{_wp(pattern)}')"
        )
    return "\nUNION ALL\n".join(parts)


@register("keyword_alerts", _alerts_sql())
def keyword_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Funding / acquisition / licensing / security mentions in whole documents, as alert rows."""
    docs = b.table(spark, sf, "documents")
    return ntz(signals.keyword_alerts(docs, "doc_id", "source", "documents", as_of=AS_OF))


@register(
    "hourly_counts",
    """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS n
FROM events GROUP BY ALL""",
)
def hourly_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tumbling 1-hour event counts per type (batch form of the streaming job)."""
    ev = b.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ntz(windows.windowed_counts(ev, "ts", ["event_type"], "1 hour"))


@register(
    "stream_window_counts",
    """
WITH w AS (SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
                  event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT * FROM w WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
)
def stream_window_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Event stream (file source, availableNow) -> watermarked hourly counts in append mode.

    Windows are emitted once the watermark (newest event - 10 minutes) passes their end,
    so the newest, still-open windows are not in the output.
    """
    root = scratch_path(spark, "stream-windows")
    ev = b.table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    ev.write.mode("overwrite").parquet(f"{root}/in")
    stream = spark.readStream.schema(ev.schema).parquet(f"{root}/in")
    counts = windows.windowed_counts(stream, "ts", ["event_type"], "1 hour", delay="10 minutes")
    q = (counts.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/ckpt")
         .trigger(availableNow=True).start(f"{root}/out"))
    q.awaitTermination()
    return ntz(spark.read.parquet(f"{root}/out"))


def _html_text_sql(expr: str) -> str:
    out = f"regexp_replace({expr}, '<[^>]+>', '', 'g')"
    # The named references that occur in the pages, besides the common ones; &amp; comes last.
    for ent, ch in [("&middot;", "·"), ("&copy;", "©"), *payloads.HTML_ENTITIES]:
        out = f"replace({out}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return f"trim({out})"


PAGE_BODY_SQL = (
    "regexp_replace(regexp_replace(regexp_replace(html, '(?s)<script[^>]*>.*?</script>', ' ', 'g'), "
    "'(?s)<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g')"
)


@register(
    "page_extract",
    f"""
SELECT page_id,
       {_html_text_sql("regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)")} AS title,
       {_html_text_sql("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")} AS heading,
       regexp_extract(html, '<html[^>]*\\blang="([^"]*)"', 1) AS lang,
       CAST(len(regexp_extract_all(html, '<a\\s[^>]*href=')) AS BIGINT) AS links,
       CAST(length({_html_text_sql(PAGE_BODY_SQL)}) AS BIGINT) AS text_chars
FROM pages""",
)
def page_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Title, heading, language, link count and visible text size of every page."""
    return signals.page_extract(b.table(spark, sf, "pages"))


def _mention_sql() -> str:
    parts = []
    for name in signals.TRACKED_NAMES:
        gram = " ".join(t for t in __import__("re").split(r"[^0-9a-z]+", name.lower()) if t)
        k = len(gram.split(" "))
        parts.append(
            f"SELECT doc_id, '{name}' AS name, "
            f"CAST(len(list_filter(range(1, len(t) - {k} + 2), lambda i: array_to_string(t[i:i + {k - 1}], ' ') = '{gram}')) AS BIGINT) AS mentions "
            f"FROM toks"
        )
    return (
        "WITH toks AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS t "
        "FROM documents)\nSELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE mentions > 0"
    )


@register("mention_match", _mention_sql())
def mention_match(spark: SparkSession, sf: str) -> DataFrame:
    """Occurrences of the tracked company names in whole documents (token boundaries)."""
    return signals.mention_match(b.table(spark, sf, "documents"), signals.TRACKED_NAMES, "doc_id")


@register(
    "null_rate_drift",
    f"""
WITH d AS (SELECT CAST(pushed_at AS DATE) AS day, count(*) AS n,
                  sum(CASE WHEN description IS NULL THEN 1 ELSE 0 END) AS z_description,
                  sum(CASE WHEN language IS NULL THEN 1 ELSE 0 END) AS z_language
           FROM ({b.REPOS_SQL}) GROUP BY 1),
l AS (SELECT 'description' AS "column", day, z_description / n AS r FROM d
      UNION ALL SELECT 'language', day, z_language / n FROM d),
w AS (SELECT *, avg(r) OVER (PARTITION BY "column" ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS base FROM l)
SELECT "column", day, round(r, 6) AS null_rate, round(base, 6) AS baseline, round(r - base, 6) AS delta,
       coalesce(r - base <= 0.1, true) AS passed
FROM w""",
)
def null_rate_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Daily null rate per column against its trailing 7-day mean."""
    repos = b.repos(b.table(spark, sf, "orders"))
    return signals.null_rate_drift(repos, "pushed_at", ["description", "language"], days=7, max_delta=0.1)


DAY1_AT = dt.datetime(2024, 1, 16, 2, 0, 0)


def _gold_sql(orders_filter: str, events_filter: str, at: str) -> str:
    return f"""
SELECT coalesce(gh.org, hn.org) AS org, CAST(coalesce(total_stars, 0) AS BIGINT) AS total_stars,
       CAST(coalesce(hn_mentions, 0) AS BIGINT) AS hn_mentions, TIMESTAMP '{at}' AS computed_at
FROM (SELECT org, sum(stars) AS total_stars FROM ({b.REPOS_SQL}) WHERE {orders_filter} GROUP BY org) gh
FULL OUTER JOIN (SELECT company AS org, count(story_url) AS hn_mentions FROM ({b.STORIES_SQL}) WHERE {events_filter}
                 GROUP BY company) hn ON gh.org = hn.org"""


@register(
    "competitor_delta",
    f"""
WITH h AS ({_gold_sql("pushed_at < TIMESTAMP '1998-01-01'", "created_at < TIMESTAMP '2024-01-16'", f"{DAY1_AT:%Y-%m-%d %H:%M:%S}")}
           UNION ALL {_gold_sql("true", "true", "2024-02-01 00:00:00")})
SELECT org, computed_at, total_stars, hn_mentions,
       total_stars - lag(total_stars) OVER (PARTITION BY org ORDER BY computed_at) AS total_stars_delta,
       hn_mentions - lag(hn_mentions) OVER (PARTITION BY org ORDER BY computed_at) AS hn_mentions_delta
FROM h""",
)
def competitor_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Two published gold snapshots (mid-month and month-end runs) -> change per company since the last run."""
    repos = b.repos(b.table(spark, sf, "orders"))
    stories = b.stories(b.table(spark, sf, "events"))
    path = scratch_path(spark, "gold-history")
    day1 = rollup.company_signals(repos.where(F.col("pushed_at") < F.lit("1998-01-01").cast("timestamp")),
                                  stories.where(F.col("created_at") < F.lit("2024-01-16").cast("timestamp")),
                                  as_of=DAY1_AT)
    lake.write_gold(day1, path, DAY1_AT)
    lake.write_gold(rollup.company_signals(repos, stories, as_of=AS_OF), path, AS_OF)
    history = lake.read_history(spark, path)
    return ntz(signals.snapshot_delta(history, "org", "computed_at", ["total_stars", "hn_mentions"]))


# --- posting lifetimes, sentiment near mentions, name tables, page texts ------------------------
LISTED_DAYS_SQL = """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS company, event_type || '-' || CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR) AS source_url, CAST(ts AS DATE) AS day FROM events"""

POSTING_SQL = f"""
shown AS ({LISTED_DAYS_SQL}),
days AS (SELECT company, day, lead(day) OVER (PARTITION BY company ORDER BY day) AS nxt FROM (SELECT DISTINCT company, day FROM shown)),
seen AS (SELECT company, source_url, day, nxt, CASE WHEN lag(nxt) OVER w = day THEN 0 ELSE 1 END AS new
         FROM shown JOIN days USING (company, day) WINDOW w AS (PARTITION BY company, source_url ORDER BY day)),
islands AS (SELECT *, sum(new) OVER (PARTITION BY company, source_url ORDER BY day ROWS UNBOUNDED PRECEDING) AS island FROM seen),
periods AS (SELECT company, source_url, min(day) AS opened, arg_max_null(nxt, day) AS closed FROM islands GROUP BY company, source_url, island)"""


def _periods(spark: SparkSession, sf: str) -> DataFrame:
    bucket = F.floor(F.col("value") / 10).cast("string")
    listings = b.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("company"), F.concat("event_type", F.lit("-"), bucket).alias("source_url"), F.to_date("ts").alias("scraped_on"))
    return signals.posting_periods(listings)


@register("posting_periods", f"WITH {POSTING_SQL} SELECT * FROM periods")
def posting_periods(spark: SparkSession, sf: str) -> DataFrame:
    """When each posting of each company was open, from its daily snapshots."""
    return _periods(spark, sf)


@register(
    "hiring_activity",
    f"""
WITH {POSTING_SQL},
e AS (SELECT company, opened AS day, 1 AS o, 0 AS c FROM periods UNION ALL SELECT company, closed, 0, 1 FROM periods WHERE closed IS NOT NULL),
d AS (SELECT company, day, sum(o) AS o, sum(c) AS c FROM e GROUP BY 1, 2),
spine AS (SELECT company, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d GROUP BY company),
f AS (SELECT company, day, coalesce(o, 0) AS o, coalesce(c, 0) AS c FROM spine LEFT JOIN d USING (company, day)),
w AS (SELECT *, avg(o) OVER win AS m, stddev_pop(o) OVER win AS s FROM f
      WINDOW win AS (PARTITION BY company ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)),
z AS (SELECT *, (o - m) / CASE WHEN s IS NULL OR s = 0 THEN 1.0 ELSE s END AS zz FROM w)
SELECT company, day, CAST(o AS BIGINT) AS openings, CAST(c AS BIGINT) AS closings, round(m, 6) AS baseline_mean, round(zz, 6) AS z,
       coalesce(abs(zz) > 3.0 AND zz > 0, false) AS spike
FROM z""",
)
def hiring_activity(spark: SparkSession, sf: str) -> DataFrame:
    """Openings and closings per company and day, and the days on which openings spike."""
    return signals.hiring_activity(_periods(spark, sf))


# Words that stand near the names in the test texts, besides the lexicon (fixed values).
NEAR_LEXICON = signals.LEXICON | {"licensed": 0.5, "license": 0.25, "version": -0.25, "under": -0.5}
NEAR = 10


def _near_sql() -> str:
    parts = []
    for name in signals.TRACKED_NAMES:
        toks = [t for t in re.split(r"[\W_]+", name.lower()) if t]
        gram, k = " ".join(toks), len(toks)
        parts.append(f"SELECT t, '{name}' AS company, {k} AS k, list_filter(range(0, len(t) - {k} + 1), lambda i: array_to_string(t[i + 1:i + {k}], ' ') = '{gram}') AS starts FROM toks")
    vals = ", ".join(f"('{w}', {wt!r})" for w, wt in sorted(NEAR_LEXICON.items()))
    return f"""
WITH toks AS (SELECT list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS t FROM documents),
m AS (SELECT row_number() OVER () AS rid, * FROM ({" UNION ALL ".join(parts)}) WHERE len(starts) > 0),
p AS (SELECT rid, company, k, starts, t, unnest(range(0, len(t))) AS p FROM m),
near AS (SELECT rid, company, t[p + 1] AS word FROM p
         WHERE len(list_filter(starts, lambda s: p >= s - {NEAR} AND p <= s + k - 1 + {NEAR})) > 0 AND len(list_filter(starts, lambda s: p >= s AND p <= s + k - 1)) = 0),
h AS (SELECT company, count(*) AS hits, avg(weight) AS score FROM near JOIN (SELECT * FROM (VALUES {vals}) v(word, weight)) USING (word) GROUP BY company)
SELECT company, count(*) AS documents, CAST(sum(len(starts)) AS BIGINT) AS mentions, CAST(coalesce(any_value(hits), 0) AS BIGINT) AS hits, round(any_value(score), 6) AS score
FROM m LEFT JOIN h USING (company) GROUP BY company"""


@register("company_sentiment", _near_sql())
def company_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """Sentiment of the words within ten tokens of each company's mentions, over whole documents."""
    return signals.mention_sentiment(b.table(spark, sf, "documents"), signals.TRACKED_NAMES, within=NEAR, lexicon=NEAR_LEXICON)


@register(
    "mention_table",
    """
WITH toks AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS t FROM documents),
bench AS (SELECT list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS t FROM benchmark),
names AS (SELECT DISTINCT array_to_string(t[1:2], ' ') AS name FROM toks WHERE len(t) >= 2 UNION SELECT array_to_string(t[1:3], ' ') FROM bench WHERE len(t) >= 3),
grams AS (SELECT doc_id, array_to_string(t[i:i + 1], ' ') AS name FROM (SELECT doc_id, t, unnest(range(1, len(t))) AS i FROM toks)
          UNION ALL SELECT doc_id, array_to_string(t[i:i + 2], ' ') FROM (SELECT doc_id, t, unnest(range(1, len(t) - 1)) AS i FROM toks))
SELECT doc_id, name, count(*) AS mentions FROM grams JOIN names USING (name) GROUP BY doc_id, name""",
)
def mention_table(spark: SparkSession, sf: str) -> DataFrame:
    """Mentions of a large table of names (how documents and benchmark items begin) in all documents."""
    docs = b.table(spark, sf, "documents")

    def beginning(df: DataFrame, k: int) -> DataFrame:
        return df.select(signals.tokens(F.col("text")).alias("t")).where(F.size("t") >= k).select(F.array_join(F.slice("t", 1, k), " ").alias("name"))

    names = beginning(docs, 2).unionByName(beginning(b.table(spark, sf, "benchmark"), 3)).distinct()
    return signals.mention_match(docs, materialize(names, "mention-names"), "doc_id")


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


MAIN_TEXT_SQL = f"""
SELECT page_id, url, CAST(len(list_filter(b, lambda x: x.text <> '')) AS BIGINT) AS blocks, CAST(len(k) AS BIGINT) AS main_blocks,
       coalesce(array_to_string(list_transform(k, lambda x: x.text), chr(10)), '') AS text
FROM (SELECT page_id, url, b, list_filter(b, lambda x: length(x.text) >= {signals.MIN_BLOCK_CHARS} AND length(x.linked) * 100 <= length(x.text) * {signals.MAX_LINK_PERCENT}) AS k
      FROM (SELECT page_id, url, list_transform(string_split_regex({PAGE_BODY_SQL}, {_sql_text(signals.BLOCK_SPLIT)}), lambda x: struct_pack(
              text := {_html_text_sql("x")}, linked := {_html_text_sql(f"array_to_string(regexp_extract_all(x, {_sql_text(signals.ANCHOR)}), '')")})) AS b FROM pages))"""


@register("page_main_text", f"SELECT page_id, blocks, main_blocks, text FROM ({MAIN_TEXT_SQL})")
def page_main_text(spark: SparkSession, sf: str) -> DataFrame:
    """The main text of every page: blocks of text that are not mostly links."""
    return signals.main_text(b.table(spark, sf, "pages"))


@register(
    "page_links",
    f"""
SELECT page_id, CAST(i - 1 AS INTEGER) AS position,
       coalesce(nullif(regexp_extract(tag, '(?i)\\shref\\s*=\\s*"([^"]*)"', 1), ''), nullif(regexp_extract(tag, '(?i)\\shref\\s*=\\s*''([^'']*)''', 1), ''),
                nullif(regexp_extract(tag, '(?i)\\shref\\s*=\\s*([^\\s"''>]+)', 1), '')) AS href,
       {_html_text_sql("a")} AS text
FROM (SELECT page_id, i, l[i] AS a, regexp_extract(l[i], '(?s)^<[^>]*>', 0) AS tag
      FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, regexp_extract_all({PAGE_BODY_SQL}, {_sql_text(signals.ANCHOR)}) AS l FROM pages)))""",
)
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    """Every link of every page."""
    return signals.page_links(b.table(spark, sf, "pages"))


@register(
    "page_headings",
    f"""
SELECT page_id, CAST(i - 1 AS INTEGER) AS position, CAST(substr(l[i], 3, 1) AS INTEGER) AS level, {_html_text_sql("l[i]")} AS text
FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i
      FROM (SELECT page_id, regexp_extract_all({PAGE_BODY_SQL}, '(?is)<h[1-6][\\s>].*?</h[1-6]>') AS l FROM pages))""",
)
def page_headings(spark: SparkSession, sf: str) -> DataFrame:
    """Every heading of every page."""
    return signals.page_headings(b.table(spark, sf, "pages"))


def _page_alerts_sql() -> str:
    parts = [f"SELECT 'mention[{name}]' AS check_name, page_id, url FROM main WHERE regexp_matches(lower(text), '{_wp(pattern)}')" for name, pattern in signals.ALERT_RULES]
    return (
        f"WITH main AS ({MAIN_TEXT_SQL})\nSELECT check_name, 'pages' AS \"table\", false AS passed, 'info' AS severity, 'page_id=' || CAST(page_id AS VARCHAR) AS message, "
        f"{AS_OF_SQL} AS measured_at, regexp_extract(url, '^https?://([^/?#]+)', 1) AS segment FROM ({' UNION ALL '.join(parts)})"
    )


@register("page_alerts", _page_alerts_sql())
def page_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alert rules on the main text of every page (menus and link lists raise none)."""
    pages = b.table(spark, sf, "pages")
    host = pages.select("page_id", F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("host"))
    main = signals.main_text(pages).join(host, "page_id")
    return ntz(signals.keyword_alerts(main, "page_id", "host", "pages", as_of=AS_OF))
