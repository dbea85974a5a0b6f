"""Landed raw responses rendered from the shared tables (what the fetchers would have stored).

Each page groups at most ``PAGE`` records: the page key is (request context, floor(unique id /
PAGE)), so no page can grow with a hot company - a company with a third of all rows gets
many pages, never one giant array. Null / empty fields are introduced by fixed rules on the
data so that every default of the parsers is exercised on whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


PAGE = 50
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _iso(c: Column) -> Column:
    return F.date_format(c.cast("timestamp"), ISO)


def _pages(rows: DataFrame, ctx: list[str], seq: str, item: Column, wrap, keep_nulls: bool = False) -> DataFrame:
    """Group ``item`` structs into bounded pages and serialise each page with ``wrap(array)``.

    Null fields are omitted from the JSON unless ``keep_nulls``.
    """
    grouped = rows.groupBy(*ctx, F.floor(F.col(seq) / PAGE).alias("page")).agg(
        F.collect_list(item).alias("items")
    )
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return grouped.select(*ctx, "page", F.to_json(wrap(F.col("items")), opts).alias("payload"))


# --- story search pages <- events ------------------------------------------------------------
def story_pages(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("bigint")
    hit = F.struct(
        F.when(et == "error", F.lit(None)).when(et == "view", F.lit("")).otherwise(et).alias("title"),
        F.concat(F.lit("story "), F.col("event_id").cast("string")).alias("story_title"),
        F.when(et == "signup", F.lit(None)).when(et == "click", F.lit(""))
        .otherwise(F.concat(F.lit("https://news.example.com/item/"), F.col("event_id").cast("string"))).alias("url"),
        F.when(F.col("value") < 5, F.lit(None)).otherwise(F.floor("value")).alias("points"),
        F.when(et == "purchase", F.lit("")).otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string"))).alias("author"),
        _iso(F.col("ts")).alias("created_at"),
        F.when(k < 10, F.lit(None)).otherwise(k).alias("num_comments"),
    )
    rows = events.select(F.col("user_id").cast("string").alias("company"), "user_id", "event_id", "event_type",
                         "value", "props", "ts")
    pages = _pages(rows, ["company"], "event_id", hit, lambda a: F.struct(a.alias("hits")))
    # A response without a hits array per company: parses to no rows.
    empty = rows.select("company").distinct().select("company", F.lit(-1).cast("bigint").alias("page"),
                                                     F.lit('{"nbHits":0}').alias("payload"))
    return pages.unionByName(empty).drop("page")


STORY_EXPECTED_SQL = """
SELECT CAST(user_id AS VARCHAR) AS company,
       CASE WHEN event_type IN ('error', 'view') THEN 'story ' || CAST(event_id AS VARCHAR) ELSE event_type END AS title,
       CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'click' THEN ''
            ELSE 'https://news.example.com/item/' || CAST(event_id AS VARCHAR) END AS url,
       CASE WHEN value < 5 THEN 0 ELSE CAST(floor(value) AS INTEGER) END AS points,
       CASE WHEN event_type = 'purchase' THEN 'anonymous' ELSE 'user' || CAST(user_id AS VARCHAR) END AS author,
       ts AS created_at,
       CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 10 THEN 0
            ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS num_comments,
       CASE WHEN event_type IN ('signup', 'click')
            THEN 'https://news.ycombinator.com/item?' ||
                 CASE WHEN event_type IN ('error', 'view') THEN 'story ' || CAST(event_id AS VARCHAR) ELSE event_type END
            ELSE 'https://news.example.com/item/' || CAST(event_id AS VARCHAR) END AS story_url
FROM events"""


# --- repo list pages <- orders ---------------------------------------------------------------
def repo_pages(orders: DataFrame) -> DataFrame:
    st = F.col("o_orderstatus")
    low = F.col("o_orderpriority") == "5-LOW"
    stars = F.floor(F.col("o_totalprice") / 1000)
    item = F.struct(
        F.col("o_orderkey").cast("string").alias("name"),
        F.concat(F.col("o_custkey").cast("string"), F.lit("/"), F.col("o_orderkey").cast("string")).alias("full_name"),
        F.when(~low, stars).alias("stargazers_count"),
        F.when(low, stars).alias("stars"),
        F.floor(F.col("o_totalprice") / 10000).alias("forks_count"),
        F.when(st == "O", 1).otherwise(0).alias("open_issues_count"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")).alias("language"),
        F.when(st != "P", _iso(F.col("o_orderdate"))).alias("pushed_at"),
        F.when(st != "F", F.concat(F.lit("order "), st)).alias("description"),
    )
    rows = orders.select(F.col("o_custkey").cast("string").alias("org"), "o_orderkey", "o_custkey", "o_orderstatus",
                         "o_orderpriority", "o_totalprice", "o_orderdate")
    # Every key is sent; null values stay explicit (language may be null but must be present).
    return _pages(rows, ["org"], "o_orderkey", item, lambda a: a, keep_nulls=True).drop("page")


REPO_EXPECTED_SQL = """
SELECT CAST(o_custkey AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) AS full_name,
       CAST(o_custkey AS VARCHAR) AS org, CAST(o_orderkey AS VARCHAR) AS name,
       CASE WHEN o_orderstatus <> 'F' THEN 'order ' || o_orderstatus END AS description,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS language,
       CAST(floor(o_totalprice / 1000) AS INTEGER) AS stars,
       CAST(floor(o_totalprice / 10000) AS INTEGER) AS forks,
       CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS open_issues,
       o_orderdate AS pushed_at
FROM orders WHERE o_orderstatus <> 'P'"""


# --- forum listing pages <- events -----------------------------------------------------------
def post_pages(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("bigint")
    data = F.struct(
        F.when(et != "error", F.concat(F.lit("r_"), et)).alias("subreddit"),
        F.when(F.col("value") >= 45, F.lit("")).otherwise(F.concat(F.lit("post "), F.col("event_id").cast("string"))).alias("title"),
        F.when(F.col("value") >= 3, F.floor("value")).alias("score"),
        k.alias("num_comments"),
        F.when(k > 90, F.lit(None)).otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("author"),
        F.when(et != "view", F.unix_seconds(F.col("ts").cast("timestamp")).cast("double")).alias("created_utc"),
        F.when(et != "click", F.concat(F.lit("/r/x/comments/"), F.col("event_id").cast("string"))).alias("permalink"),
    )
    rows = events.select(F.concat(F.lit("r_"), et).alias("subreddit"), "event_id", "event_type", "value", "props",
                         "user_id", "ts")
    return _pages(rows, ["subreddit"], "event_id", F.struct(F.lit("t3").alias("kind"), data.alias("data")),
                  lambda a: F.struct(F.struct(a.alias("children")).alias("data"))).drop("page")


POST_EXPECTED_SQL = """
SELECT 'r_' || event_type AS subreddit,
       CASE WHEN value >= 45 THEN '(no title)' ELSE 'post ' || CAST(event_id AS VARCHAR) END AS title,
       CASE WHEN value >= 3 THEN CAST(floor(value) AS INTEGER) ELSE 0 END AS score,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS num_comments,
       CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) > 90 THEN '[deleted]' ELSE 'u' || CAST(user_id AS VARCHAR) END AS author,
       CASE WHEN event_type <> 'view' THEN date_trunc('second', ts) ELSE TIMESTAMP '1970-01-01 00:00:00' END AS created_utc,
       CASE WHEN event_type <> 'click' THEN '/r/x/comments/' || CAST(event_id AS VARCHAR) ELSE '' END AS permalink
FROM events"""


# --- encyclopedia responses <- customer ------------------------------------------------------
def search_pages(customer: DataFrame) -> DataFrame:
    hit = F.struct(F.concat(F.col("c_name"), F.lit(" (company)")).alias("title"))
    hits = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.array().cast("array<struct<title:string>>")).otherwise(F.array(hit))
    return customer.select(F.col("c_name").alias("name"),
                           F.to_json(F.struct(F.struct(hits.alias("search")).alias("query"))).alias("payload"))


def summary_pages(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    body = F.struct(
        F.when(F.col("c_nationkey") >= 5, F.concat(F.lit("Page of "), F.col("c_name"))).alias("title"),
        F.concat(F.col("c_name"), F.lit(" is a "), F.lower("c_mktsegment"), F.lit(" company.")).alias("extract"),
        F.col("c_mktsegment").alias("description"),
        F.struct(F.struct(F.concat(F.lit("https://wiki.example.org/"), key).alias("page")).alias("desktop")).alias("content_urls"),
        F.when(F.col("c_acctbal") > 5000, F.struct(F.concat(F.lit("https://img.example.org/"), key).alias("source"))).alias("thumbnail"),
    )
    return customer.select(
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") < 0, F.lit(404)).otherwise(F.lit(200)).alias("status"),
        F.when(F.col("c_acctbal") < 0, F.lit('{"type":"not_found"}')).otherwise(F.to_json(body)).alias("payload"),
    )


FACTS_EXPECTED_SQL = """
SELECT c_name AS name,
       CASE WHEN c_nationkey >= 5 THEN 'Page of ' || c_name ELSE c_name || ' (company)' END AS title,
       c_name || ' is a ' || lower(c_mktsegment) || ' company.' AS summary,
       c_mktsegment AS description,
       'https://wiki.example.org/' || CAST(c_custkey AS VARCHAR) AS url,
       CASE WHEN c_acctbal > 5000 THEN 'https://img.example.org/' || CAST(c_custkey AS VARCHAR) END AS thumbnail_url
FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' AND c_acctbal >= 0"""


# --- contributor pages <- lineitem ----------------------------------------------------------
def contributor_pages(lineitem: DataFrame) -> DataFrame:
    item = F.struct(
        F.concat(F.lit("supp"), F.col("l_suppkey").cast("string")).alias("login"),
        F.col("l_quantity").cast("int").alias("contributions"),
        F.concat(F.lit("https://avatars.example.org/"), F.col("l_suppkey").cast("string")).alias("avatar_url"),
    )
    rows = lineitem.select(F.col("l_orderkey").cast("string").alias("repo"), "l_linenumber", "l_suppkey", "l_quantity")
    return _pages(rows, ["repo"], "l_linenumber", item, lambda a: a).drop("page")


CONTRIB_EXPECTED_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS repo, 'supp' || CAST(l_suppkey AS VARCHAR) AS login,
       CAST(l_quantity AS INTEGER) AS contributions,
       'https://avatars.example.org/' || CAST(l_suppkey AS VARCHAR) AS avatar_url
FROM lineitem"""
