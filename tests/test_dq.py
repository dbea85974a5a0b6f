import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.operators import dq

UTC = dt.timezone.utc
AS_OF = dt.datetime(2026, 5, 30, 12, 0, 0)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_row_count_passes_within_sigma(spark):
    df = spark.range(100)
    r = one(dq.row_count_anomaly(df, "t", baseline=[95, 98, 100, 102, 105], sigma=3.0))
    assert r.passed and r.severity == "info"
    assert r.message == "current=100 baseline_mean=100.0 z=0.00"


def test_row_count_flags_outlier(spark):
    r = one(dq.row_count_anomaly(spark.range(10_000), "t", baseline=[95, 98, 100, 102, 105], sigma=3.0))
    assert not r.passed and r.severity == "warning"


def test_row_count_without_baseline_passes(spark):
    r = one(dq.row_count_anomaly(spark.range(7), "t", baseline=[]))
    assert r.passed and r.message == "no baseline yet; current=7"
    r = one(dq.row_count_anomaly(spark.range(7), "t", baseline=None))
    assert r.passed


def test_row_count_constant_baseline_uses_unit_std(spark):
    # std 0 -> 1.0: z = (103 - 100) / 1 = 3 -> passes (inclusive)
    r = one(dq.row_count_anomaly(spark.range(103), "t", baseline=[100, 100, 100]))
    assert r.passed and r.message.endswith("z=3.00")
    r = one(dq.row_count_anomaly(spark.range(104), "t", baseline=[100, 100, 100]))
    assert not r.passed


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=8), st.integers(0, 600))
def test_row_count_matches_numpy(spark, baseline, current):
    mean = float(np.mean(baseline))
    std = float(np.std(baseline)) or 1.0
    z = (current - mean) / std
    r = one(dq.row_count_anomaly(spark.range(current), "t", baseline=baseline))
    assert r.passed == (abs(z) <= 3.0) or math.isclose(abs(z), 3.0, rel_tol=1e-12)


def test_freshness_recent_and_stale(spark):
    now = dt.datetime.now(UTC)
    fresh = spark.createDataFrame([(now - dt.timedelta(minutes=5),)], "updated_at timestamp")
    stale = spark.createDataFrame([(now - dt.timedelta(days=2),)], "updated_at timestamp")
    assert one(dq.freshness(fresh, "t", "updated_at", dt.timedelta(hours=1))).passed
    r = one(dq.freshness(stale, "t", "updated_at", dt.timedelta(hours=1)))
    assert not r.passed and r.severity == "error"


def test_freshness_empty_missing_allnull_future(spark):
    empty = spark.createDataFrame([], "updated_at timestamp")
    r = one(dq.freshness(empty, "t", "updated_at", dt.timedelta(hours=1), as_of=AS_OF))
    assert not r.passed and r.message == "empty or missing column 'updated_at'"
    r = one(dq.freshness(spark.range(3), "t", "updated_at", dt.timedelta(hours=1), as_of=AS_OF))
    assert not r.passed and r.message == "empty or missing column 'updated_at'"
    nulls = spark.createDataFrame([(None,), (None,)], "updated_at timestamp")
    assert not one(dq.freshness(nulls, "t", "updated_at", dt.timedelta(hours=1), as_of=AS_OF)).passed
    future = spark.createDataFrame([(AS_OF + dt.timedelta(minutes=5),)], "updated_at timestamp")
    r = one(dq.freshness(future, "t", "updated_at", dt.timedelta(hours=1), as_of=AS_OF))
    assert r.passed and r.message == "newest=2026-05-30 12:05:00+00:00 age=-1 day, 23:55:00"


def test_freshness_message_matches_python(spark):
    newest = dt.datetime(2026, 5, 28, 9, 30, 15, 250)
    df = spark.createDataFrame([(newest,)], "ts timestamp")
    r = one(dq.freshness(df, "t", "ts", dt.timedelta(days=2), as_of=AS_OF))
    age = AS_OF - newest
    assert r.message == f"newest={newest.replace(tzinfo=UTC)} age={age}"
    assert r.passed == (age <= dt.timedelta(days=2))


def test_schema_drift(spark):
    r = one(dq.schema_drift(spark, {"a": "string", "b": "int", "c": "float"}, {"a": "string", "b": "int"}, "t"))
    assert not r.passed and "added" in r.message and r.severity == "warning"
    r = one(dq.schema_drift(spark, {"a": "string", "b": "string"}, {"a": "string", "b": "int"}, "t"))
    assert not r.passed and r.message == "type_changed={'b': ('int', 'string')}"
    r = one(dq.schema_drift(spark, {"a": "string"}, {"a": "string", "b": "int"}, "t"))
    assert r.message == "removed=['b']"
    r = one(dq.schema_drift(spark, {"a": "string"}, {"a": "string"}, "t"))
    assert r.passed and r.message == "no drift"


def test_schema_drift_from_frame(spark):
    df = spark.createDataFrame([("x", 1)], "a string, b bigint")
    r = one(dq.schema_drift(spark, df, {"a": "string", "b": "int"}, "t"))
    assert r.message == "type_changed={'b': ('int', 'bigint')}"


def test_null_rate_per_column(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None), (4, 1)], "good bigint, bad bigint")
    by = {r.check_name: r for r in dq.null_rate(df, "t", 0.1).collect()}
    assert by["null_rate[good]"].passed
    assert not by["null_rate[bad]"].passed
    assert by["null_rate[bad]"].message == "null_rate=0.750 threshold=0.1"


def test_null_rate_counts_nan_and_empty_frame(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,)], "x double")
    r = one(dq.null_rate(df, "t", 0.5))
    assert r.message == "null_rate=0.500 threshold=0.5" and r.passed
    assert dq.null_rate(spark.createDataFrame([], "x double"), "t").count() == 0


def test_suite_zero_row_company_and_all_rows(spark):
    rows = [("a", f"a/{i}", dt.datetime(2026, 5, 30) - dt.timedelta(hours=i), None if i % 2 else "x") for i in range(1001)]
    rows += [("b", "b/0", dt.datetime(2026, 1, 1), "y")]
    df = spark.createDataFrame(rows, "org string, full_name string, pushed_at timestamp, description string")
    tracked = spark.createDataFrame([("a",), ("b",), ("c",)], "org string")
    res = dq.suite(df, tracked, "github_repos", "org", "pushed_at", as_of=AS_OF).collect()
    by = {(r.segment, r.check_name): r for r in res}
    assert by[("a", "row_count_anomaly")].message == "no baseline yet; current=1001"
    assert by[("a", "freshness")].passed
    assert not by[("b", "freshness")].passed
    assert by[("c", "row_count_anomaly")].passed and by[("c", "row_count_anomaly")].message.endswith("current=0")
    assert by[("c", "freshness")].message == "empty or missing column 'pushed_at'"
    assert not any(seg == "c" and name.startswith("null_rate") for seg, name in by)
    assert by[("a", "null_rate[description]")].message == "null_rate=0.500 threshold=0.5"


def test_failures_and_count(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "good bigint, bad bigint")
    res = dq.null_rate(df, "t", 0.1)
    assert dq.failures(res).count() == 1
    assert dq.failure_count(res).first().failures == 1


def test_payload_drift_observed_types(spark):
    df = spark.createDataFrame([('{"k": 69, "d": 1}',), ('{"k": "x", "s": "x", "d": 1.5, "o": {"a": [1]}}',),
                                ("bad json",), (None,)], "p string")
    assert dq.observed_json_schema(df, "p") .collect()
    r = one(dq.payload_drift(df, "p", {"k": "bigint", "z": "string"}, "t"))
    assert r.message == "added=['d', 'o', 's']; removed=['z']; type_changed={'k': ('bigint', 'variant')}"
    same = spark.createDataFrame([('{"k": 1}',), ('{"k": 2}',)], "p string")
    assert one(dq.payload_drift(same, "p", {"k": "bigint"}, "t")).message == "no drift"


def test_suite_with_baseline_history(spark):
    df = spark.createDataFrame([("a", f"a/{i}", AS_OF) for i in range(10)] + [("b", "b/0", AS_OF)],
                               "org string, full_name string, pushed_at timestamp")
    tracked = spark.createDataFrame([("a",), ("b",)], "org string")
    history = spark.createDataFrame([("a", 10), ("a", 11), ("a", 9), ("b", 100), ("b", 100)], "org string, n bigint")
    res = dq.suite(df, tracked, "t", "org", "pushed_at", baseline=history, as_of=AS_OF).collect()
    rc = {r.segment: r for r in res if r.check_name == "row_count_anomaly"}
    assert rc["a"].passed and rc["a"].message == "current=10 baseline_mean=10.0 z=0.00"
    assert not rc["b"].passed and rc["b"].message == "current=1 baseline_mean=100.0 z=-99.00"  # std 0 -> 1
