"""Envelope, key, stream and table-layer queries (they write under the shared folder and read back)."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel import schemas
from kestrel.functions.scalars import story_key
from kestrel.operators import rollup
from kestrel.plans import bindings as b
from kestrel.plans import landing as _landing
from kestrel.plans import silver
from kestrel.plans.registry import _ORACLES, AS_OF, ntz, register
from kestrel.plans.queries_core import COARSE_STORIES_SQL, _coarse_stories
from kestrel.session import scratch_path, spread
from kestrel.sinks import keyed, lake, topic
from kestrel.streaming import ingest, late
from kestrel.streaming.specs import DQ_ALERTS_TOPIC, SPECS_BY_NAME, TOPICS


def _hn_messages(events: DataFrame) -> DataFrame:
    """Stream messages for the story topic; 'error' events arrive as truncated (malformed) JSON."""
    rec = F.to_json(F.struct(
        F.col("event_type").alias("title"),
        F.when(F.col("event_type") != "signup",
               F.concat(F.lit("https://news.example.com/item/"), F.col("event_id").cast("string"))).alias("url"),
        F.floor("value").cast("int").alias("points"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("created_at"),
        F.get_json_object("props", "$.k").cast("int").alias("num_comments"),
    ))
    value = F.when(F.col("event_type") == "error", F.substring(rec, 1, 20)).otherwise(rec)
    return events.select(F.col("event_id").cast("string").cast("binary").alias("key"), value.cast("binary").alias("value"))


HN_EXPECTED_SQL = """
SELECT CASE WHEN event_type <> 'error' THEN event_type END AS title,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN 'https://news.example.com/item/' || CAST(event_id AS VARCHAR) END AS url,
       CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS INTEGER) END AS points,
       CASE WHEN event_type <> 'error' THEN 'user' || CAST(user_id AS VARCHAR) END AS author,
       CASE WHEN event_type <> 'error' THEN ts END AS created_at,
       CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS num_comments
FROM events"""
HN_COLS = ["title", "url", "points", "author", "created_at", "num_comments"]


@register("parse_stream_envelope", HN_EXPECTED_SQL)
def parse_stream_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """Envelope bytes -> typed story rows (malformed messages land as all-null rows), batch form."""
    raw = _hn_messages(b.table(spark, sf, "events"))
    return ntz(ingest.parse_stream(raw, SPECS_BY_NAME["hn_stories"]).select(*HN_COLS))


@register("stream_ingest", HN_EXPECTED_SQL)
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Publish to file-backed topics, drain them with the streaming ingest (availableNow), read bronze back."""
    root = scratch_path(spark, "stream-ingest")
    landing = f"{root}/topics"
    events = b.table(spark, sf, "events")
    _hn_messages(events).write.mode("append").parquet(f"{landing}/{TOPICS['hn']}")
    ingest.run(spark, root, [SPECS_BY_NAME["hn_stories"]], available_now=True, source_format="parquet",
               source_path=landing, sink_format="parquet")
    bronze = spark.read.parquet(SPECS_BY_NAME["hn_stories"].bronze_path(root))
    return ntz(bronze.select(*HN_COLS))


@register(
    "publish_envelope",
    f"""
WITH repos AS ({b.REPOS_SQL}), stories AS ({b.STORIES_SQL})
SELECT 'github.repos' AS topic, full_name AS key, full_name AS record_id, CAST(stars AS BIGINT) AS metric FROM repos
UNION ALL
SELECT 'hn.stories', title, story_url, CAST(points AS BIGINT) FROM stories
""",
)
def publish_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed messages for both source topics (repos keyed by full_name, stories by title), decoded back."""
    repos = b.repos(b.table(spark, sf, "orders"))
    stories = b.stories(b.table(spark, sf, "events")).drop("seq")
    env = topic.envelope(repos, "full_name", TOPICS["github"]).select(
        "topic", "key", F.get_json_object(F.col("value").cast("string"), "$.full_name").alias("record_id"),
        F.get_json_object(F.col("value").cast("string"), "$.stars").cast("bigint").alias("metric"),
    ).unionByName(topic.envelope(stories, "title", TOPICS["hn"]).select(
        "topic", "key", F.get_json_object(F.col("value").cast("string"), "$.story_url").alias("record_id"),
        F.get_json_object(F.col("value").cast("string"), "$.points").cast("bigint").alias("metric"),
    ))
    return env.select("topic", F.col("key").cast("string").alias("key"), "record_id", "metric")


@register(
    "story_key",
    """
SELECT CAST(user_id AS VARCHAR) AS org, event_type AS title,
       CASE WHEN event_type IN ('signup', 'click') THEN 'https://news.ycombinator.com/item?' || event_type
            ELSE 'https://news.example.com/item/' || CAST(event_id AS VARCHAR) END AS story_url,
       CASE WHEN event_type IN ('signup', 'click')
            THEN 'hn://' || CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                                 ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00/' || sha256(event_type)
            ELSE 'https://news.example.com/item/' || CAST(event_id AS VARCHAR) END AS cli_key
FROM events""",
)
def story_key_query(spark: SparkSession, sf: str) -> DataFrame:
    """Surrogate story keys (url, else title-based / time+hash-based) and the company -> org rename."""
    ev = b.table(spark, sf, "events")
    url = F.when(F.col("event_type") == "signup", F.lit(None)).when(F.col("event_type") == "click", F.lit("")).otherwise(
        F.concat(F.lit("https://news.example.com/item/"), F.col("event_id").cast("string")))
    s = ev.select(F.col("user_id").cast("string").alias("company"), F.col("event_type").alias("title"),
                  url.alias("url"), F.col("ts").cast("timestamp").alias("created_at"))
    return s.select(
        F.col("company").alias("org"), "title",
        story_key("url", "title", form="item").alias("story_url"),
        story_key("url", "title", "created_at", form="hash").alias("cli_key"),
    )


@register(
    "bronze_roundtrip",
    f"""
SELECT full_name, org, name, CASE WHEN pushed_at >= TIMESTAMP '1998-01-01' THEN description END AS description,
       language, stars, forks, open_issues, pushed_at
FROM ({b.REPOS_SQL})""",
)
def bronze_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two bronze appends, the second with an extra column (schema merge on read)."""
    path = scratch_path(spark, "bronze-repos")
    repos = b.repos(b.table(spark, sf, "orders"))
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp")
    lake.write_bronze(repos.where(F.col("pushed_at") < cut).drop("description"), path)
    lake.write_bronze(repos.where(F.col("pushed_at") >= cut), path)
    back = lake.read_bronze(spark, path)
    return ntz(back.select("full_name", "org", "name", "description", "language", "stars", "forks", "open_issues",
                           "pushed_at"))


SILVER_CUT = "2024-01-16 00:00:00"


@register(
    "silver_build",
    f"""
WITH bronze AS (
  SELECT story_url, company, CASE WHEN title <> 'error' THEN title END AS title, CASE WHEN num_comments > 5 THEN points END AS points,
         num_comments, author, created_at, created_at + INTERVAL 1 DAY AS ingested_at, seq
  FROM ({COARSE_STORIES_SQL})
)
SELECT story_url, company, title, points, num_comments, author, created_at, ingested_at
FROM bronze WHERE title IS NOT NULL AND points IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY story_url ORDER BY created_at DESC, company DESC, title DESC, points DESC, num_comments DESC) = 1""",
)
def silver_build(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze in two runs, with bad rows in both, taken into silver one run at a time: the newest valid row per key."""
    root = scratch_path(spark, "silver-stories")
    rows = _coarse_stories(spark, sf).select(
        "story_url", "company", F.when(F.col("title") != "error", F.col("title")).alias("title"), F.when(F.col("num_comments") > 5, F.col("points")).alias("points"),
        "num_comments", "author", "created_at", (F.col("created_at") + F.expr("INTERVAL 1 DAY")).alias(silver.INGESTED_AT))
    schema = T.StructType([*schemas.HN_STORIES.fields[:-1], T.StructField(silver.INGESTED_AT, T.TimestampType())])
    table = keyed.KeyedTable(f"{root}/silver", ("story_url",), schema, buckets=16)
    job = silver.SilverJob(f"{root}/bronze", table, "created_at", tuple(schemas.REQUIRED["hn_stories"]), root)
    cut = F.lit(SILVER_CUT).cast("timestamp")
    for run, part in (("at-1", rows.where(F.col("created_at") < cut)), ("at-2", rows.where(F.col("created_at") >= cut))):
        lake.write_run(part, job.bronze, run)
        silver.build(spark, job)
    return ntz(table.read(spark))


@register("gold_snapshot", _ORACLES["company_signals"])
def gold_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Gold published by two runs; readers see the newest one."""
    path = scratch_path(spark, "gold-company-signals")
    repos = b.repos(b.table(spark, sf, "orders"))
    stories = b.stories(b.table(spark, sf, "events"))
    gold = rollup.company_signals(repos, stories, as_of=AS_OF)
    lake.write_gold(gold.where(F.col("repo_count") > 0), path, AS_OF - dt.timedelta(days=1))
    lake.write_gold(gold, path, AS_OF)
    return ntz(lake.read_gold(spark, path))


def _stream_quality_sql() -> str:
    from kestrel.plans.registry import AS_OF_SQL
    from kestrel.plans.sqltext import fmt, sev

    nulls = {
        "title": "event_type = 'error'", "url": "event_type IN ('error', 'signup')", "points": "event_type = 'error'",
        "author": "event_type = 'error'", "created_at": "event_type = 'error'", "num_comments": "event_type = 'error'",
    }
    parts = []
    for c, cond in nulls.items():
        rate = f"(CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS DOUBLE) / count(*))"
        parts.append(
            f"SELECT 'null_rate[{c}]' AS check_name, 'hn_stories' AS \"table\", {rate} <= 0.1 AS passed, "
            f"{sev(f'{rate} <= 0.1', 'warning')} AS severity, 'null_rate=' || {fmt(rate, 3)} || ' threshold=0.1' AS message, "
            f"{AS_OF_SQL} AS measured_at, CAST(NULL AS VARCHAR) AS segment FROM events"
        )
    from kestrel.plans.queries_dq import TWO_DAYS_US, _freshness_sql

    fresh = _freshness_sql("(SELECT CASE WHEN event_type <> 'error' THEN ts END AS created_at FROM events)",
                           "hn_stories", "created_at", TWO_DAYS_US)
    return "\nUNION ALL\n".join(parts + [fresh])


class _BrokenOff(RuntimeError):
    """Raised by the queries that break a stream off on purpose."""


def break_off_once(start):
    """Run ``start(on_written)`` twice: the first run fails after its first batch is written and before it is checkpointed."""

    def fail(batch_id: int) -> None:
        raise _BrokenOff(f"batch {batch_id}")

    try:
        start(fail).awaitTermination()
    except StreamingQueryException:
        pass
    else:
        raise AssertionError("the stream was to be broken off")
    start(None).awaitTermination()


@register("stream_batch_quality", f"SELECT *, (SELECT count(*) FROM events) AS landed, CASE WHEN passed THEN 0 ELSE 1 END AS messages FROM ({_stream_quality_sql()})")
def stream_batch_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Stream ingest with checks observed on each batch's write; the batch is broken off and repeated, and still lands, is checked and tells once."""
    from kestrel.streaming.quality import quality_paths, start_ingest_with_quality

    root = scratch_path(spark, "stream-quality")
    spec = SPECS_BY_NAME["hn_stories"]
    _hn_messages(b.table(spark, sf, "events")).write.mode("append").parquet(f"{root}/topics/{spec.topic}")
    break_off_once(lambda on_written: start_ingest_with_quality(
        spark, spec, root, source_format="parquet", source_path=f"{root}/topics", available_now=True, as_of=AS_OF, on_written=on_written))
    paths = quality_paths(spec, root)
    alerts = spark.read.parquet(paths["alerts"]).drop("batch")
    sent = spark.read.parquet(f"{paths['topics']}/{DQ_ALERTS_TOPIC}")
    told = sent.select(F.get_json_object(F.col("value").cast("string"), "$.check_name").alias("check_name")).groupBy("check_name").agg(F.count(F.lit(1)).alias("messages"))
    landed = spark.read.parquet(paths["bronze"]).agg(F.count(F.lit(1)).alias("landed")).first()["landed"]
    out = alerts.join(told, "check_name", "left").withColumn("landed", F.lit(landed)).withColumn("messages", F.coalesce("messages", F.lit(0)))
    return ntz(out.select("check_name", "table", "passed", "severity", "message", "measured_at", "segment", "landed", "messages"))


@register(
    "stream_resume",
    """
SELECT 'bronze' AS side, event_type AS kind, count(*) AS messages, CAST(sum(event_id) AS BIGINT) AS ids FROM events WHERE event_type <> 'error' GROUP BY 2
UNION ALL SELECT 'quarantine', 'malformed record', count(*), CAST(sum(event_id) AS BIGINT) FROM events WHERE event_type = 'error' HAVING count(*) > 0""",
)
def stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """A stream broken off between its writes and its checkpoint, restarted: every message once, in bronze or quarantine."""
    root, spec = scratch_path(spark, "stream-resume"), SPECS_BY_NAME["hn_stories"]
    events = b.table(spark, sf, "events")
    record = F.to_json(F.struct(F.col("event_type").alias("title"), F.col("event_id").cast("string").alias("url")))
    value = F.when(F.col("event_type") == "error", F.concat(F.col("event_id").cast("string"), F.lit("} not json"))).otherwise(record)
    events.select(F.lit(None).cast("binary").alias("key"), value.cast("binary").alias("value")).write.parquet(f"{root}/topics/{spec.topic}")
    break_off_once(lambda on_written: ingest.start_query(
        spark, spec, root, source_format="parquet", source_path=f"{root}/topics", sink_format="parquet", available_now=True,
        quarantine=True, required=["title"], on_written=on_written))
    good = spark.read.parquet(ingest.batches_path(spec, root)).select(F.lit("bronze").alias("side"), F.col("title").alias("kind"), F.col("url").cast("bigint").alias("id"))
    bad = spark.read.parquet(ingest.quarantine_path(spec, root)).select(
        F.lit("quarantine").alias("side"), F.col("_bad").alias("kind"), F.regexp_extract(ingest.CORRUPT, "^[0-9]+", 0).cast("bigint").alias("id"))
    return good.unionByName(bad).groupBy("side", "kind").agg(F.count(F.lit(1)).alias("messages"), F.sum("id").alias("ids"))


@register(
    "late_rows",
    """
WITH m AS (SELECT max(ts) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS first_newest, max(ts) AS newest FROM events),
late AS (
  SELECT event_type, event_id FROM events, m WHERE event_type = 'click' AND ts < TIMESTAMP '2024-01-16' AND ts < first_newest - INTERVAL 6 HOUR
  UNION ALL SELECT event_type, event_id FROM events, m WHERE ts < newest - INTERVAL 6 HOUR
)
SELECT 'rows' AS side, event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 2
UNION ALL SELECT 'late', event_type, count(*), CAST(sum(event_id) AS BIGINT) FROM late GROUP BY 2""",
)
def late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches: the first half; the second half with old clicks again; everything again. Each event is kept once, late ones are all set aside."""
    root = scratch_path(spark, "late-rows")
    events = b.table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    early = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp")
    for batch in (events.where(early), events.where(~early | (F.col("event_type") == "click")), events):
        batch.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        late.start_dedup_with_late_rows(stream, root, ["event_id"], "ts", "6 hours", drain=True).awaitTermination()
    paths = late.late_paths(root)
    sides = [spark.read.parquet(paths[side]).select(F.lit(side).alias("side"), "event_type", "event_id") for side in ("rows", "late")]
    return sides[0].unionByName(sides[1]).groupBy("side", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@register(
    "gold_history",
    f"""
WITH days(day) AS (VALUES (TIMESTAMP '2024-01-10'), (TIMESTAMP '2024-01-16'), (TIMESTAMP '2024-01-22'), (TIMESTAMP '2024-02-01')),
runs AS (SELECT day, lead(day) OVER (ORDER BY day) AS nxt FROM days),
g AS (SELECT company AS org, day, nxt, count(*) AS hn_mentions FROM ({b.STORIES_SQL}) JOIN runs ON created_at < day AND created_at >= day - INTERVAL 8 DAY GROUP BY ALL),
n AS (SELECT *, CASE WHEN lag(nxt) OVER w = day AND lag(hn_mentions) OVER w = hn_mentions THEN 0 ELSE 1 END AS new FROM g WINDOW w AS (PARTITION BY org ORDER BY day)),
p AS (SELECT *, sum(new) OVER (PARTITION BY org ORDER BY day ROWS UNBOUNDED PRECEDING) AS period FROM n)
SELECT org, any_value(hn_mentions) AS hn_mentions, min(day) AS valid_from, arg_max_null(nxt, day) AS valid_to FROM p GROUP BY org, period""",
)
def gold_history(spark: SparkSession, sf: str) -> DataFrame:
    """Four published snapshots (mentions of the last eight days) as periods of unchanged values per company, from one read of one table."""
    path = scratch_path(spark, "gold-history")
    stories = b.stories(b.table(spark, sf, "events"))
    none = spark.createDataFrame([], schemas.GITHUB_REPOS)
    for at in (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 16), dt.datetime(2024, 1, 22), AS_OF):
        recent = stories.where((F.col("created_at") < F.lit(at).cast("timestamp")) & (F.col("created_at") >= F.lit(at - dt.timedelta(days=8)).cast("timestamp")))
        lake.write_gold(rollup.company_signals(none, recent, as_of=at), path, at)
    return ntz(lake.intervals(lake.read_history(spark, path), ["org"], ["hn_mentions"], "computed_at"))


@register(
    "routed_topics",
    f"""
SELECT 'github.repos' AS topic, count(*) AS messages, count(DISTINCT full_name) AS keys, CAST(sum(length(full_name)) AS BIGINT) AS key_chars FROM ({b.REPOS_SQL})
UNION ALL SELECT 'hn.stories', count(*), count(DISTINCT story_url), CAST(sum(length(story_url)) AS BIGINT) FROM ({b.STORIES_SQL})""",
)
def routed_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Records of two sources in one write, each to the topic of its source."""
    path = scratch_path(spark, "routed")
    rows = b.repos(b.table(spark, sf, "orders")).select(F.lit("github").alias("source"), F.col("full_name").alias("id"), F.col("stars").alias("n")).unionByName(
        b.stories(b.table(spark, sf, "events")).select(F.lit("hn").alias("source"), F.col("story_url").alias("id"), F.col("points").alias("n")))
    topic.routed(rows, "source", "id").write.partitionBy("topic").parquet(path)
    there = spark.read.parquet(path).withColumn("k", F.col("key").cast("string"))
    return there.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"), F.count_distinct("k").alias("keys"), F.sum(F.length("k")).alias("key_chars"))


# --- the daily job, run twice -----------------------------------------------------------------
REFRESH_SQL = f"""
WITH tracked AS ({b.TRACKED_SQL}),
repos AS (SELECT *, CASE WHEN language = '1-URGENT' THEN 7 ELSE 0 END AS more FROM ({b.REPOS_SQL}) WHERE description IS NOT NULL AND org IN (SELECT org FROM tracked)),
stories AS (SELECT *, CASE WHEN title = 'purchase' THEN 1 ELSE 0 END AS more FROM ({b.STORIES_SQL}) WHERE title <> 'error' AND company IN (SELECT org FROM tracked)),
facts AS (SELECT * FROM customer WHERE c_acctbal >= 0),
gold AS (SELECT org, sum(repos) AS repo_count, sum(stars) AS total_stars, sum(mentions) AS hn_mentions, sum(points) AS hn_points
         FROM (SELECT org, 1 AS repos, stars + more AS stars, 0 AS mentions, 0 AS points FROM repos
               UNION ALL SELECT company, 0, 0, 1, points + more FROM stories) GROUP BY org),
counts AS (
  SELECT 'day 1' AS org, (SELECT count(*) FROM repos) AS repos_written, (SELECT count(*) FROM stories) AS stories_written, (SELECT count(*) FROM facts) AS facts_written,
         (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') + (SELECT count(*) FROM events WHERE event_type = 'error') + (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS quarantined
  UNION ALL
  SELECT 'day 2', (SELECT count(*) FROM repos WHERE more > 0), (SELECT count(*) FROM stories WHERE more > 0), 0, (SELECT count(*) FROM customer)
)
SELECT 'gold' AS what, org, CAST(repo_count AS BIGINT) AS a, CAST(total_stars AS BIGINT) AS b, CAST(hn_mentions AS BIGINT) AS c, CAST(hn_points AS BIGINT) AS d FROM gold
UNION ALL SELECT 'written', org, repos_written, stories_written, facts_written, quarantined FROM counts
UNION ALL SELECT 'facts', NULL, count(*), CAST(sum(length(c_mktsegment)) AS BIGINT), 0, 0 FROM facts"""


@register("refresh_twice", REFRESH_SQL)
def refresh_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The daily job on two days: all repositories, stories and facts, then changed ones, and error pages in place of all facts."""
    from kestrel.plans import refresh

    status = F.col("o_orderstatus")

    def repo_page(more: int, name):
        return F.to_json(F.array(F.struct(
            name.alias("name"), F.concat_ws("/", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")).alias("full_name"),
            F.col("o_orderpriority").alias("language"), (F.floor(F.col("o_totalprice") / 1000) + more).alias("stars"), F.lit(0).alias("forks"),
            F.when(status != "P", F.lit(1)).alias("open_issues"), F.date_format(F.col("o_orderdate").cast("timestamp"), _landing.ISO).alias("pushed_at"))))

    def hit_page(more: int):
        page = F.to_json(F.struct(F.array(F.struct(
            F.col("event_type").alias("title"), F.concat(F.lit("https://x.example/"), F.col("event_id").cast("string")).alias("url"),
            (F.floor("value") + more).alias("points"), F.date_format(F.col("ts").cast("timestamp"), _landing.ISO).alias("created_at"))).alias("hits")))
        return F.when(F.col("event_type") == "error", F.substring(page, 1, 30)).otherwise(page)

    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate")
    events = b.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    customer = b.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    tracked, store = b.tracked(customer), refresh.Store(scratch_path(spark, "refresh-twice"))
    # Every row becomes a page that is written and parsed, in tasks that the size of the files does not tell.
    orders, events, customer = spread(orders), spread(events), spread(customer)
    key = F.col("c_custkey").cast("string").alias("name")
    searches = customer.select(key, F.lit('{"query":{"search":[{"title":"T"}]}}').alias("payload"))
    summary = F.to_json(F.struct(F.col("c_mktsegment").alias("extract")))
    summaries = customer.select(key, F.lit(200).alias("status"), F.when(F.col("c_acctbal") >= 0, summary).otherwise(F.lit("<html>")).alias("payload"))
    first = refresh.refresh(
        spark, store, tracked, orders.select(F.col("o_custkey").cast("string").alias("org"), repo_page(0, F.col("o_orderkey").cast("string")).alias("payload")),
        events.select(F.col("user_id").cast("string").alias("company"), hit_page(0).alias("payload"), F.col("event_id").alias("seq")),
        AS_OF - dt.timedelta(days=1), landed_searches=searches, landed_summaries=summaries)
    urgent, bought = orders.where("o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P'"), events.where("event_type = 'purchase'")
    second = refresh.refresh(
        spark, store, tracked, urgent.select(F.col("o_custkey").cast("string").alias("org"), repo_page(7, F.lit("renamed")).alias("payload")),
        bought.select(F.col("user_id").cast("string").alias("company"), hit_page(1).alias("payload"), F.col("event_id").alias("seq")),
        AS_OF, landed_searches=searches, landed_summaries=customer.select(key, F.lit(500).alias("status"), F.lit("<html>").alias("payload")))
    numbers = lambda *cols: [F.col(c).cast("bigint").alias(n) for c, n in zip(cols, "abcd")]
    gold = lake.read_gold(spark, store.gold("company_signals")).select(F.lit("gold").alias("what"), "org", *numbers("repo_count", "total_stars", "hn_mentions", "hn_points"))
    written = spark.createDataFrame(
        [("written", day, r.repos_written, r.stories_written, r.facts_written, r.quarantined) for day, r in (("day 1", first), ("day 2", second))],
        "what string, org string, a bigint, b bigint, c bigint, d bigint")
    facts = refresh.read_keyed(spark, store, "wikipedia_companies").agg(F.count(F.lit(1)).alias("a"), F.sum(F.length("summary")).cast("bigint").alias("b")).select(
        F.lit("facts").alias("what"), F.lit(None).cast("string").alias("org"), "a", "b", F.lit(0).cast("bigint").alias("c"), F.lit(0).cast("bigint").alias("d"))
    return gold.unionByName(written).unionByName(facts)
