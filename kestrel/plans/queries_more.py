"""Reads, keyed upserts, publication, streams and windows that the other query modules leave out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel import schemas
from kestrel.operators import dq, newest, rollup, upsert
from kestrel.plans import bindings as b
from kestrel.plans import landing
from kestrel.plans.queries_dq import REPO_NULL_COLS, _suite_sql
from kestrel.plans.registry import AS_OF, ntz, register
from kestrel.session import materialize, scratch_path
from kestrel.sinks import cluster, keyed, lake, topic
from kestrel.sources import landing as landed
from kestrel.sources import payloads
from kestrel.streaming import ingest, windows
from kestrel.streaming.specs import DQ_ALERTS_TOPIC, SPECS_BY_NAME, STREAM_SPECS, TOPICS


@register(
    "recent_stories_for_company",
    f"""
SELECT story_url, company, title, points, created_at FROM ({b.STORIES_SQL}) WHERE company = '1'
ORDER BY created_at DESC NULLS LAST, story_url LIMIT 10""",
)
def recent_stories_for_company(spark: SparkSession, sf: str) -> DataFrame:
    """The ten newest stories of one company (the limit is the feature)."""
    stories = b.stories(b.table(spark, sf, "events"))
    return ntz(newest.recent_stories(stories, "1").select("story_url", "company", "title", "points", "created_at"))


QUARANTINE_SQL = """
SELECT 'repos' AS source, CAST(o_custkey AS VARCHAR) AS company,
       CASE o_orderstatus WHEN 'P' THEN 'unparsable page' WHEN 'F' THEN 'missing stars' ELSE 'valid' END AS outcome,
       count(*) AS records
FROM orders GROUP BY ALL
UNION ALL
SELECT 'stories', CAST(user_id AS VARCHAR),
       CASE WHEN event_type IN ('error', 'view') THEN 'unparsable page' WHEN event_type = 'click' THEN 'bad points' ELSE 'valid' END,
       count(*)
FROM events GROUP BY ALL
UNION ALL
SELECT 'posts', CAST(user_id AS VARCHAR),
       CASE WHEN event_type IN ('error', 'view') THEN 'unparsable page' WHEN event_type = 'click' THEN 'bad score' ELSE 'valid' END,
       count(*)
FROM events GROUP BY ALL
UNION ALL
SELECT 'contributors', CAST(l_suppkey AS VARCHAR),
       CASE l_returnflag WHEN 'R' THEN 'unparsable page' WHEN 'A' THEN 'missing contributions' ELSE 'valid' END, count(*)
FROM lineitem GROUP BY ALL
UNION ALL
SELECT 'facts', c_name,
       CASE WHEN c_nationkey % 5 = 0 THEN 'status 500' WHEN c_nationkey % 5 = 1 THEN 'unparsable page' ELSE 'valid' END, count(*)
FROM customer WHERE c_nationkey % 5 <> 2 GROUP BY ALL"""

ERROR_PAGE = "<html><body>503</body></html>"


@register("payload_quarantine", QUARANTINE_SQL.replace("WHERE c_nationkey % 5 <> 2", "WHERE c_nationkey - 5 * (c_nationkey // 5) <> 2"))
def payload_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Truncated pages, web pages, numbers that do not fit, error responses: every page sent to any of the five parsers is valid or quarantined."""
    bad_number = F.lit("3000000000")

    def counted(tagged: DataFrame, source: str, company: str) -> DataFrame:
        outcome = F.coalesce(F.col(payloads.BAD), F.lit("valid")).alias("outcome")
        return tagged.groupBy(F.lit(source).alias("source"), F.col(company).alias("company"), outcome).agg(F.count(F.lit(1)).alias("records"))

    status = F.col("o_orderstatus")
    record = F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("name"), F.col("o_orderkey").cast("string").alias("full_name"), F.lit("x").alias("language"),
        F.when(status == "F", bad_number).otherwise(F.lit("12")).alias("stars"), F.lit(0).alias("forks"), F.lit(0).alias("open_issues"),
        F.date_format(F.col("o_orderdate").cast("timestamp"), landing.ISO).alias("pushed_at")))
    page = F.concat(F.lit("["), record, F.when(status == "P", F.lit(",")).otherwise(F.lit("]")))
    repo_pages = b.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("org"), page.alias("payload"))

    kind = F.col("event_type")
    number = F.when(kind == "click", bad_number).otherwise(F.lit("7"))
    company = F.col("user_id").cast("string").alias("company")

    def broken(whole):
        return F.when(kind == "error", F.substring(whole, 1, 25)).when(kind == "view", F.lit(ERROR_PAGE)).otherwise(whole).alias("payload")

    hit = F.to_json(F.struct(F.array(F.struct(
        F.lit("t").alias("title"), number.alias("points"), F.date_format(F.col("ts").cast("timestamp"), landing.ISO).alias("created_at"))).alias("hits")))
    post = F.to_json(F.struct(F.struct(F.array(F.struct(F.struct(
        F.lit("t").alias("title"), number.alias("score"), F.lit("/p").alias("permalink")).alias("data"))).alias("children")).alias("data")))
    events = b.table(spark, sf, "events")

    flag = F.col("l_returnflag")
    entry = F.to_json(F.struct(F.lit("x").alias("login"), F.when(flag != "A", F.lit(3)).alias("contributions")))
    contributors = b.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("company"), F.when(flag == "R", F.lit(ERROR_PAGE)).otherwise(F.concat(F.lit("["), entry, F.lit("]"))).alias("payload"))

    customer, case = b.table(spark, sf, "customer"), F.col("c_nationkey") % 5
    searches = customer.select(F.col("c_name").alias("name"), F.lit('{"query":{"search":[{"title":"T"}]}}').alias("payload"))
    summaries = customer.select(
        F.col("c_name").alias("name"), F.when(case == 0, F.lit(500)).when(case == 2, F.lit(404)).otherwise(F.lit(200)).alias("status"),
        F.when(case <= 1, F.lit(ERROR_PAGE)).otherwise(F.lit('{"extract":"e"}')).alias("payload"))

    parts = [
        counted(payloads.parse_repos(repo_pages, tagged=True), "repos", "org"),
        counted(payloads.parse_stories(events.select(company, broken(hit)), tagged=True), "stories", "company"),
        counted(payloads.parse_posts(events.select(company, F.lit("s").alias("subreddit"), broken(post)), tagged=True), "posts", "company"),
        counted(payloads.parse_contributors(contributors, tagged=True), "contributors", "company"),
        counted(payloads.parse_facts(payloads.resolve_titles(searches), summaries, tagged=True), "facts", "name"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _listings(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_name").alias("company"), F.concat(F.lit("Engineer "), F.col("c_mktsegment")).alias("title"),
        F.when(F.col("c_nationkey") % 2 == 0, F.lit("Remote")).alias("location"), F.lit("3 days ago").alias("posted_at"),
        F.concat(F.lit("https://jobs.example.org/"), F.col("c_custkey").cast("string")).alias("source_url"))


LISTINGS_SQL = """
SELECT c_name AS company, 'Engineer ' || c_mktsegment AS title, CASE WHEN c_nationkey % 2 = 0 THEN 'Remote' END AS location,
       '3 days ago' AS posted_at, 'https://jobs.example.org/' || CAST(c_custkey AS VARCHAR) AS source_url
FROM customer"""


@register("landed_records", LISTINGS_SQL)
def landed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records landed as JSON lines, read back with the declared schema."""
    path = scratch_path(spark, "landed-listings")
    _listings(b.table(spark, sf, "customer")).withColumn("unknown", F.lit(1)).write.json(path)
    return landed.read_records(spark, path, schemas.JOB_LISTINGS).select("company", "title", "location", "posted_at", "source_url")


def _board_pages(customer: DataFrame, posting) -> DataFrame:
    """One page per company with three postings: complete, without place or link, and with a blank title."""
    key = F.col("c_custkey").cast("string")
    body = F.concat(*[posting(*x) for x in (
        (F.concat(F.lit("R&amp;D &eacute;tude &#8211; "), F.col("c_mktsegment")), F.lit(" Paris "), F.concat(F.lit("/job/"), key)),
        (F.concat(F.lit(" Analyst "), key), None, None),
        (F.lit("  "), F.lit("Nowhere"), F.lit("/job/x")),
    )])
    return customer.select(F.col("c_name").alias("company"), F.concat(F.lit("https://boards.example.org/"), key).alias("url"),
                           F.concat(F.lit("<html><body><p class='location'>Page</p>"), body, F.lit("</body></html>")).alias("html"))


LISTED_SQL = """
SELECT c_name AS company, 'R&D étude – ' || c_mktsegment AS title, 'Paris' AS location, '/job/' || CAST(c_custkey AS VARCHAR) AS source_url FROM customer
UNION ALL
SELECT c_name, 'Analyst ' || CAST(c_custkey AS VARCHAR), NULL, 'https://boards.example.org/' || CAST(c_custkey AS VARCHAR) FROM customer"""


def _listed(pages: DataFrame, board: str) -> DataFrame:
    return payloads.parse_listings(pages, board).select("company", "title", "location", "source_url")


@register("lever_listings", LISTED_SQL)
def lever_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Lever boards: both quote styles, character references, a place only inside the posting's categories."""

    def posting(title, place, link):
        where = F.lit("") if place is None else F.concat(F.lit("<div class='posting-categories'><span class=\"sort location\">"), place, F.lit("</span></div>"))
        href = F.lit("") if link is None else link
        return F.concat(F.lit('<div class="posting" data-id="1"><span class="location">Elsewhere</span><a class=\'posting-title big\' href=\''), href, F.lit("'><h5>"), title, F.lit("</h5></a>"), where, F.lit("</div>"))

    return _listed(_board_pages(b.table(spark, sf, "customer"), posting), "lever")


@register("greenhouse_listings", LISTED_SQL)
def greenhouse_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Greenhouse boards: the posting's first link is its title, the place may be missing."""

    def posting(title, place, link):
        where = F.lit("") if place is None else F.concat(F.lit('<span class="location">'), place, F.lit("</span>"))
        tag = F.lit("<a>") if link is None else F.concat(F.lit('<a href="'), link, F.lit('">'))
        return F.concat(F.lit("<div class='opening level-0'>"), tag, title, F.lit("</a>"), where, F.lit("</div>"))

    return _listed(_board_pages(b.table(spark, sf, "customer"), posting), "greenhouse")


@register(
    "upsert_facts",
    f"""
WITH f AS ({landing.FACTS_EXPECTED_SQL})
SELECT name, title, CASE WHEN length(name) % 2 = 0 THEN upper(summary) ELSE summary END AS summary, description, url, thumbnail_url,
       CASE WHEN length(name) % 2 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-16 00:00:00' END AS scraped_at
FROM f""",
)
def upsert_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Company facts into a bootstrapped table, then a second load that refreshes some of them."""
    customer = b.table(spark, sf, "customer")
    facts = payloads.parse_facts(payloads.resolve_titles(landing.search_pages(customer)), landing.summary_pages(customer)).drop("scraped_at")
    table = keyed.keyed_table(scratch_path(spark, "facts"), "wikipedia_companies", buckets=16)
    table.create(spark)
    facts = materialize(facts, "facts-parsed")
    for batch, at in ((facts, dt.datetime(2024, 1, 16)), (facts.where(F.length("name") % 2 == 0).withColumn("summary", F.upper("summary")), AS_OF)):
        table.upsert(batch, upsert.FACTS_RULE, as_of=at)
    return ntz(table.read(spark).select("name", "title", "summary", "description", "url", "thumbnail_url", "scraped_at"))


@register(
    "alert_publication",
    f"""
WITH tracked AS ({b.TRACKED_SQL}), repos AS (SELECT *, org AS repos_grp FROM ({b.REPOS_SQL})),
res AS ({_suite_sql("repos", "github_repos", "pushed_at", REPO_NULL_COLS)})
SELECT check_name, count(*) AS logged, count(*) FILTER (NOT passed) AS failed, count(*) FILTER (NOT passed) AS published FROM res GROUP BY 1""",
)
def alert_publication(spark: SparkSession, sf: str) -> DataFrame:
    """The suite's results in the alert log, and its failures as messages on the alert topic, both read back."""
    root = scratch_path(spark, "alerts")
    results = dq.suite(b.repos(b.table(spark, sf, "orders")), b.tracked(b.table(spark, sf, "customer")), "github_repos", "org", "pushed_at",
                       as_of=AS_OF, columns=REPO_NULL_COLS)
    lake.append_results(results, f"{root}/log")
    log = spark.read.parquet(f"{root}/log")
    topic.publish_alerts(log, fmt="parquet", path=f"{root}/topics")
    sent = spark.read.parquet(f"{root}/topics/{DQ_ALERTS_TOPIC}").select(F.get_json_object(F.decode("value", "UTF-8"), "$.check_name").alias("check_name"))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = log.select("check_name", one.alias("logged"), (~F.col("passed")).cast("long").alias("failed"), none.alias("published")).unionByName(
        sent.select("check_name", none.alias("logged"), none.alias("failed"), one.alias("published")))
    return both.groupBy("check_name").agg(*[F.sum(c).alias(c) for c in ("logged", "failed", "published")])


@register(
    "publish_topics",
    f"""
SELECT 'github.repos' AS topic, count(*) AS published, count(*) AS messages, count(DISTINCT full_name) AS keys FROM ({b.REPOS_SQL})
UNION ALL SELECT 'hn.stories', count(*), count(*), count(DISTINCT title) FROM ({b.STORIES_SQL})
UNION ALL SELECT 'jobs.listings', count(*), count(*), count(DISTINCT company) FROM ({LISTINGS_SQL})""",
)
def publish_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed messages of three sources on their topics: the count the writer returned, and what is there."""
    root = scratch_path(spark, "topics")
    sources = {
        "github": (b.repos(b.table(spark, sf, "orders")), "full_name"),
        "hn": (b.stories(b.table(spark, sf, "events")).drop("seq"), "title"),
        "jobs": (_listings(b.table(spark, sf, "customer")), "company"),
    }
    out = None
    for source, (rows, key) in sources.items():
        n = topic.publish(rows, TOPICS[source], key, fmt="parquet", path=root)
        there = spark.read.parquet(f"{root}/{TOPICS[source]}").agg(
            F.lit(TOPICS[source]).alias("topic"), F.lit(n).cast("long").alias("published"), F.count(F.lit(1)).alias("messages"), F.count_distinct("key").alias("keys"))
        out = there if out is None else out.unionByName(there)
    return out


@register(
    "gold_empty_sides",
    f"""
SELECT 'repos only' AS side, org, count(*) AS repo_count, CAST(sum(stars) AS BIGINT) AS total_stars, 0 AS hn_mentions, 0 AS hn_points FROM ({b.REPOS_SQL}) GROUP BY org
UNION ALL
SELECT 'stories only', company, 0, 0, count(*), CAST(sum(points) AS BIGINT) FROM ({b.STORIES_SQL}) GROUP BY company""",
)
def gold_empty_sides(spark: SparkSession, sf: str) -> DataFrame:
    """Gold when one of the two tables is empty: the other side's companies, zeros for what is missing."""
    repos, stories = b.repos(b.table(spark, sf, "orders")), b.stories(b.table(spark, sf, "events"))
    cols = ["org", "repo_count", "total_stars", "hn_mentions", "hn_points"]
    left = rollup.company_signals(repos, spark.createDataFrame([], stories.schema), as_of=AS_OF).select(F.lit("repos only").alias("side"), *cols)
    right = rollup.company_signals(spark.createDataFrame([], repos.schema), stories, as_of=AS_OF).select(F.lit("stories only").alias("side"), *cols)
    return left.unionByName(right).select("side", "org", *[F.col(c).cast("long").alias(c) for c in cols[1:]])


@register("compacted_silver", f"SELECT full_name, org, language, stars FROM ({b.REPOS_SQL})")
def compacted_silver(spark: SparkSession, sf: str) -> DataFrame:
    """A table compacted and clustered by company and stars together: the same rows."""
    path, target = scratch_path(spark, "silver"), scratch_path(spark, "compacted")
    lake.write_silver(b.repos(b.table(spark, sf, "orders")).select("full_name", "org", "language", "stars"), path)
    cluster.compact(spark, path, target, ["org", "stars"], file_bytes=1 << 18)
    return spark.read.parquet(target)


@register(
    "stream_ingest_all",
    f"""
SELECT 'github_repos' AS stream, count(*) AS records, count(*) AS stamped, CAST(sum(stars) AS BIGINT) AS metric FROM ({b.REPOS_SQL})
UNION ALL SELECT 'hn_stories', count(*), count(*), CAST(sum(points) AS BIGINT) FROM ({b.STORIES_SQL})
UNION ALL SELECT 'reddit_posts', count(*), count(*), CAST(sum(score) AS BIGINT) FROM ({landing.POST_EXPECTED_SQL})
UNION ALL SELECT 'job_listings', count(*), count(*), CAST(count(location) AS BIGINT) FROM ({LISTINGS_SQL})""",
)
def stream_ingest_all(spark: SparkSession, sf: str) -> DataFrame:
    """All four topics published, ingested by four concurrent streams, and read back with their ingest stamp."""
    root = scratch_path(spark, "streams")
    rows = {
        "github_repos": (b.repos(b.table(spark, sf, "orders")), "stars"),
        "hn_stories": (b.stories(b.table(spark, sf, "events")), "points"),
        "reddit_posts": (payloads.parse_posts(landing.post_pages(b.table(spark, sf, "events"))), "score"),
        "job_listings": (_listings(b.table(spark, sf, "customer")), None),
    }
    for spec in STREAM_SPECS:
        frame, _ = rows[spec.name]
        topic.publish(frame.select(*[c for c in spec.schema.names if c in frame.columns]), spec.topic, None, fmt="parquet", path=f"{root}/topics")
    ingest.run(spark, root, STREAM_SPECS, available_now=True, source_format="parquet", source_path=f"{root}/topics", sink_format="parquet")
    out = None
    for name, (_, metric) in rows.items():
        value = F.sum(metric) if metric else F.count("location")
        one = spark.read.parquet(SPECS_BY_NAME[name].bronze_path(root)).agg(
            F.lit(name).alias("stream"), F.count(F.lit(1)).alias("records"), F.count("ingested_at").alias("stamped"), value.cast("long").alias("metric"))
        out = one if out is None else out.unionByName(one)
    return out


@register("stream_dedup", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every event sent twice through a stream that drops repeats within the watermark."""
    root = scratch_path(spark, "stream-dedup")
    ev = b.table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    ev.unionByName(ev).write.parquet(f"{root}/in")
    stream = windows.dedupe(spark.readStream.schema(ev.schema).parquet(f"{root}/in"), ["event_id"], "ts")
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start(f"{root}/out")
    query.awaitTermination()
    return spark.read.schema(ev.schema).parquet(f"{root}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@register(
    "sliding_counts",
    """
WITH w AS (SELECT user_id, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS s FROM events)
SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, CAST(user_id AS VARCHAR) AS company, count(*) AS n FROM w GROUP BY ALL""",
)
def sliding_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Events per company in one-hour windows that start every half hour."""
    ev = b.table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").cast("string").alias("company"))
    return ntz(windows.windowed_counts(ev, "ts", ["company"], "1 hour", slide="30 minutes"))


@register(
    "session_counts",
    """
WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT min(ts) AS window_start, max(ts) + INTERVAL 6 HOUR AS window_end, CAST(user_id AS VARCHAR) AS company, count(*) AS n FROM s GROUP BY user_id, k""",
)
def session_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Bursts of events per company, apart by at least six hours."""
    ev = b.table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").cast("string").alias("company"))
    return ntz(windows.windowed_counts(ev, "ts", ["company"], session_gap="6 hours"))
