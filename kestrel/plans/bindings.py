"""Binding of the shared test tables to the entities of the pipeline.

The live sources (code host, news site, forum, encyclopedia, job boards) are not
reachable, so their records are derived from the given tables by a fixed rule:
a company is a customer key, a repo is an order, a story / forum post is an event,
a contributor is a line item, a company page is a customer row, a job board is a web
page. Each binding exists twice: as a DataFrame (what the jobs consume) and as the
equivalent SQL text (what the DuckDB oracle consumes), and the two must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- repos <- orders -------------------------------------------------------------------------
def repos(orders: DataFrame) -> DataFrame:
    org = F.col("o_custkey").cast("string")
    return orders.select(
        F.concat(org, F.lit("/"), F.col("o_orderkey").cast("string")).alias("full_name"),
        org.alias("org"),
        F.col("o_orderkey").cast("string").alias("name"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("order "), F.col("o_orderstatus"))).alias("description"),
        F.col("o_orderpriority").alias("language"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("stars"),
        F.floor(F.col("o_totalprice") / 10000).cast("int").alias("forks"),
        F.when(F.col("o_orderstatus") == "O", 1).otherwise(0).alias("open_issues"),
        F.col("o_orderdate").cast("timestamp").alias("pushed_at"),
    )


REPOS_SQL = """
SELECT CAST(o_custkey AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) AS full_name,
       CAST(o_custkey AS VARCHAR) AS org,
       CAST(o_orderkey AS VARCHAR) AS name,
       CASE WHEN o_orderstatus <> 'P' THEN 'order ' || o_orderstatus END AS description,
       o_orderpriority AS language,
       CAST(floor(o_totalprice / 1000) AS INTEGER) AS stars,
       CAST(floor(o_totalprice / 10000) AS INTEGER) AS forks,
       CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS open_issues,
       o_orderdate AS pushed_at
FROM orders"""


# --- stories <- events -----------------------------------------------------------------------
STORY_URL_PREFIX = "https://news.example.com/item/"


def stories(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit(STORY_URL_PREFIX), F.col("event_id").cast("string")).alias("story_url"),
        F.col("user_id").cast("string").alias("company"),
        F.col("event_type").alias("title"),
        F.floor(F.col("value")).cast("int").alias("points"),
        F.get_json_object("props", "$.k").cast("int").alias("num_comments"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("event_id").alias("seq"),
    )


STORIES_SQL = f"""
SELECT '{STORY_URL_PREFIX}' || CAST(event_id AS VARCHAR) AS story_url,
       CAST(user_id AS VARCHAR) AS company,
       event_type AS title,
       CAST(floor(value) AS INTEGER) AS points,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS num_comments,
       'user' || CAST(user_id AS VARCHAR) AS author,
       ts AS created_at,
       event_id AS seq
FROM events"""


# --- tracked companies <- customer -----------------------------------------------------------
def tracked(customer: DataFrame) -> DataFrame:
    """The tracked-company list: every customer (a company may have no rows anywhere)."""
    return customer.select(F.col("c_custkey").cast("string").alias("org"))


TRACKED_SQL = "SELECT CAST(c_custkey AS VARCHAR) AS org FROM customer"
