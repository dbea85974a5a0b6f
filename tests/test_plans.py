"""Plan assertions: the optimizer does the pruning, pushdown and map-side work we rely on."""

import json

from pyspark.sql import functions as F

from kestrel.operators import rollup
from kestrel.plans import bindings as b
from kestrel.streaming import ingest
from kestrel.streaming.specs import SPECS_BY_NAME

SF = "/root/testdata/sf0.001"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_json_parse_pruned_to_used_fields(spark):
    raw = spark.createDataFrame([(None, json.dumps({"title": "t", "points": 1}).encode())], "key binary, value binary")
    only_title = ingest.parse_stream(raw, SPECS_BY_NAME["hn_stories"], stamp=False).select("title")
    plan = optimized(only_title)
    assert "title" in plan and "num_comments" not in plan and "created_at" not in plan


def test_gold_is_partial_aggregated_and_column_pruned(spark):
    repos = b.repos(b.table(spark, SF, "orders"))
    stories = b.stories(b.table(spark, SF, "events"))
    plan = executed(rollup.company_signals(repos, stories))
    assert "partial_count" in plan and "partial_sum" in plan
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in plan  # no ts/props/event_type
    assert "o_orderdate" not in plan.split("ReadSchema: struct<o_orderkey")[1].split(">")[0]


def test_company_filter_reaches_the_scan(spark):
    ev = b.table(spark, SF, "events")
    plan = executed(ev.where(F.col("user_id") == 7).select("event_id"))
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,7)]" in plan
