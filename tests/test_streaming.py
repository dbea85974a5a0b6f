import datetime as dt
import json

from pyspark.sql import functions as F

from kestrel.session import scratch_path
from kestrel.sinks import topic
from kestrel.streaming import ingest, windows
from kestrel.streaming.specs import SPECS_BY_NAME, STREAM_SPECS, TOPICS


def test_spec_registry_is_consistent():
    names = [s.name for s in STREAM_SPECS]
    topics = [s.topic for s in STREAM_SPECS]
    assert len(set(names)) == len(names) == 4 and len(set(topics)) == 4
    for s in STREAM_SPECS:
        if s.watermark_col:
            assert s.watermark_col in s.schema.names
            assert s.schema[s.watermark_col].dataType.typeName() == "timestamp"
        assert s.topic in TOPICS.values()
    paths = {s.bronze_path("/r") for s in STREAM_SPECS} | {s.checkpoint_path("/r") for s in STREAM_SPECS}
    assert len(paths) == 8


def test_parse_stream_edge_cases(spark):
    good = json.dumps({"title": "t", "url": "u", "points": 3, "author": "a", "created_at": "2026-05-01T00:00:00Z",
                       "num_comments": 1})
    values = [good, "not json {", None, "", "[1, 2]", json.dumps({"title": "t", "points": "7"}),
              json.dumps({"title": "t", "points": 9999999999})]
    raw = spark.createDataFrame([(None, v.encode() if v is not None else None) for v in values], "key binary, value binary")
    rows = ingest.parse_stream(raw, SPECS_BY_NAME["hn_stories"]).collect()
    assert len(rows) == len(values)  # nothing is dropped
    assert rows[0].title == "t" and rows[0].created_at == dt.datetime(2026, 5, 1)
    assert all(rows[1][c] is None for c in ("title", "points", "created_at"))
    assert rows[5].title == "t" and rows[5].points is None
    assert rows[6].points is None
    assert all(r.ingested_at is not None for r in rows)


def test_publish_keyed_and_unkeyed(spark):
    path = scratch_path(spark, "topics-test")
    df = spark.createDataFrame([("a/b", 1), ("c/d", 2)], "full_name string, stars int")
    assert topic.publish(df, "github.repos", key_field="full_name", fmt="parquet", path=path) == 2
    msgs = spark.read.parquet(f"{path}/github.repos").orderBy("key").collect()
    assert msgs[0].key == b"a/b" and json.loads(msgs[0].value) == {"full_name": "a/b", "stars": 1}
    one = spark.createDataFrame([("x",)], "title string")
    assert topic.publish(one, "hn.stories", fmt="parquet", path=path) == 1
    assert spark.read.parquet(f"{path}/hn.stories").first().key is None


def test_routed_envelope(spark):
    df = spark.createDataFrame([("github", "a"), ("hn", "b")], "source string, title string")
    rows = {r.topic: r for r in topic.routed(df, "source", "title").collect()}
    assert set(rows) == {"github.repos", "hn.stories"} and json.loads(rows["hn.stories"].value) == {"title": "b"}


def test_file_stream_ingest_matches_batch(spark):
    root = scratch_path(spark, "ingest-test")
    spec = SPECS_BY_NAME["github_repos"]
    recs = [{"full_name": f"o/r{i}", "name": f"r{i}", "description": None, "language": "Go", "stars": i, "forks": 0,
             "open_issues": 0, "pushed_at": f"2026-05-01T00:{i:02d}:00Z"} for i in range(20)]
    df = spark.createDataFrame([(r["full_name"], json.dumps(r)) for r in recs], "full_name string, payload string")
    env = df.select(F.col("full_name").cast("binary").alias("key"), F.col("payload").cast("binary").alias("value"))
    env.write.parquet(f"{root}/topics/{spec.topic}")
    ingest.run(spark, root, [spec], available_now=True, source_format="parquet", source_path=f"{root}/topics",
               sink_format="parquet")
    bronze = spark.read.parquet(spec.bronze_path(root))
    batch = ingest.parse_stream(env, spec, stamp=False)
    cols = spec.schema.names
    assert sorted(bronze.select(*cols).collect()) == sorted(batch.select(*cols).collect())
    # a restart with the same checkpoint adds nothing (exactly-once resume)
    ingest.run(spark, root, [spec], available_now=True, source_format="parquet", source_path=f"{root}/topics",
               sink_format="parquet")
    assert spark.read.parquet(spec.bronze_path(root)).count() == 20


def test_streaming_windows_and_dedup(spark):
    root = scratch_path(spark, "window-test")
    base = dt.datetime(2026, 5, 1)
    rows = [(base + dt.timedelta(minutes=7 * i), "k" if i % 2 else "j", f"id{i % 30}") for i in range(60)]
    df = spark.createDataFrame(rows, "ts timestamp, kind string, id string")
    df.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{root}/in")
    counts = windows.windowed_counts(stream, "ts", ["kind"], "1 hour", delay="10 minutes")
    q = (counts.writeStream.format("memory").queryName("win_test").outputMode("append")
         .option("checkpointLocation", f"{root}/ck1").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.window_start, r.kind): r.n for r in spark.table("win_test").collect()}
    expect = {(r.window_start, r.kind): r.n for r in windows.windowed_counts(df, "ts", ["kind"], "1 hour").collect()}
    watermark = max(r[0] for r in rows) - dt.timedelta(minutes=10)
    closed = {k: v for k, v in expect.items() if k[0] + dt.timedelta(hours=1) <= watermark}
    assert got == closed and len(closed) < len(expect)
    deduped = windows.dedupe(stream, ["id"], "ts", delay="1 day")
    q2 = (deduped.writeStream.format("memory").queryName("dedup_test").outputMode("append")
          .option("checkpointLocation", f"{root}/ck2").trigger(availableNow=True).start())
    q2.awaitTermination()
    assert spark.table("dedup_test").count() == 30
    assert windows.dedupe(df, ["id"]).count() == 30


def test_sliding_and_session_windows_batch(spark):
    base = dt.datetime(2026, 5, 1)
    df = spark.createDataFrame([(base + dt.timedelta(minutes=m), "a") for m in (0, 5, 50, 200)], "ts timestamp, k string")
    sliding = windows.windowed_counts(df, "ts", ["k"], "1 hour", slide="30 minutes")
    assert sliding.agg(F.sum("n")).first()[0] == 8
    sessions = windows.windowed_counts(df, "ts", ["k"], session_gap="30 minutes").orderBy("window_start").collect()
    assert [r.n for r in sessions] == [2, 1, 1]


def test_checks_are_observed_and_a_repeated_batch_tells_once(spark):
    from kestrel.plans.queries_io import break_off_once
    from kestrel.streaming import quality

    root, spec = scratch_path(spark, "observed"), SPECS_BY_NAME["hn_stories"]
    rows = [json.dumps({"title": "t", "url": None, "points": i, "author": "a", "created_at": "2026-05-01T00:00:00Z", "num_comments": 0}) for i in range(10)]
    for part in (rows, rows[:3]):
        spark.createDataFrame([(None, r.encode()) for r in part], "key binary, value binary").coalesce(1).write.mode("append").parquet(f"{root}/topics/{spec.topic}")
        break_off_once(lambda on_written: quality.start_ingest_with_quality(
            spark, spec, root, source_format="parquet", source_path=f"{root}/topics", available_now=True, as_of=dt.datetime(2026, 5, 2), on_written=on_written))
    paths = quality.quality_paths(spec, root)
    assert {r.batch: r["count"] for r in spark.read.parquet(paths["bronze"]).groupBy("batch").count().collect()} == {0: 10, 1: 3}
    results = spark.read.parquet(paths["alerts"]).collect()
    assert sorted((r.batch, r.check_name) for r in results if not r.passed) == [(0, "null_rate[url]"), (1, "null_rate[url]")]
    assert len(results) == 2 * 7 and {r.message for r in results if r.check_name == "freshness"} == {"newest=2026-05-01 00:00:00+00:00 age=1 day, 0:00:00"}
    sent = spark.read.parquet(f"{paths['topics']}/dq.alerts").collect()
    assert sorted(r.key for r in sent) == [b"hn_stories/0/null_rate[url]", b"hn_stories/1/null_rate[url]"]


def test_late_and_repeated_rows(spark):
    from kestrel.streaming import late

    root = scratch_path(spark, "late-test")
    at = lambda h, m=0: dt.datetime(2026, 5, 1, h, m)
    schema = "id string, v int, ts timestamp"
    batches = [
        [("a", 1, at(10)), ("b", 1, at(12)), ("b", 2, at(12)), (None, 5, at(12)), ("n", 0, None)],  # newest 12:00
        [("a", 1, at(10)), ("c", 1, at(11, 30)), ("b", 3, at(12, 5)), (None, 6, at(12, 10)), ("d", 1, at(9))],  # watermark 11:00; newest 12:10
        [("c", 2, at(11, 40)), ("a", 2, at(13)), ("d", 2, at(11, 9))],  # watermark 11:10
    ]
    broken = []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = lambda: spark.readStream.schema(schema).parquet(f"{root}/in")

        def fail(batch_id):
            broken.append(batch_id)
            raise RuntimeError("broken off")

        query = late.start_dedup_with_late_rows(stream(), root, ["id"], "ts", "1 hour", drain=True, on_written=fail)
        try:
            query.awaitTermination()
        except Exception:  # noqa: BLE001 - the failure above
            pass
        late.start_dedup_with_late_rows(stream(), root, ["id"], "ts", "1 hour", drain=True).awaitTermination()
    assert broken == [0, 1, 2]
    paths = late.late_paths(root)
    key = lambda r: (r.batch, r.id or "", r.v)
    assert sorted(map(key, spark.read.parquet(paths["rows"]).collect())) == [(0, "", 5), (0, "a", 1), (0, "b", 1), (1, "c", 1), (2, "a", 2)]
    assert sorted(map(key, spark.read.parquet(paths["late"]).collect())) == [(0, "n", 0), (1, "a", 1), (1, "d", 1), (2, "d", 2)]


def test_stream_quarantine_split(spark):
    root = scratch_path(spark, "quarantine-test")
    spec = SPECS_BY_NAME["hn_stories"]
    good = json.dumps({"title": "t", "url": "u", "points": 1, "author": "a", "created_at": "2026-05-01T00:00:00Z",
                       "num_comments": 0})
    values = [good, "not json {", json.dumps({"url": "no title"}), json.dumps({"title": "t", "points": "x"})]
    env = spark.createDataFrame([(None, v.encode()) for v in values], "key binary, value binary")
    env.write.parquet(f"{root}/topics/{spec.topic}")
    q = ingest.start_query(spark, spec, root, source_format="parquet", source_path=f"{root}/topics",
                           sink_format="parquet", available_now=True, quarantine=True, required=["title"])
    q.awaitTermination()
    bronze = spark.read.parquet(ingest.batches_path(spec, root)).collect()
    bad = {r._bad for r in spark.read.parquet(ingest.quarantine_path(spec, root)).collect()}
    assert [r.title for r in bronze] == ["t"] and "_corrupt_record" not in bronze[0].asDict()
    assert bad == {"malformed record", "missing title"}


def test_run_all_specs_together(spark):
    root = scratch_path(spark, "multi-spec")
    recs = {
        "github_repos": [{"full_name": f"o/r{i}", "name": f"r{i}", "stars": i, "forks": 0, "open_issues": 0,
                          "language": None, "pushed_at": "2026-05-01T00:00:00Z"} for i in range(5)],
        "hn_stories": [{"title": f"t{i}", "url": None, "points": i, "author": "a", "created_at": "2026-05-01T00:00:00Z",
                        "num_comments": 0} for i in range(7)],
        "reddit_posts": [{"subreddit": "s", "title": "t", "score": 1, "num_comments": 0, "author": "a",
                          "created_utc": "2026-05-01T00:00:00Z", "permalink": f"/p{i}"} for i in range(3)],
        "job_listings": [{"company": "acme", "title": "Engineer", "location": None, "posted_at": "3 days ago",
                          "source_url": f"https://jobs/{i}"} for i in range(2)],
    }
    for spec in STREAM_SPECS:
        df = spark.createDataFrame([(None, json.dumps(r).encode()) for r in recs[spec.name]], "key binary, value binary")
        df.write.parquet(f"{root}/topics/{spec.topic}")
    queries = ingest.run(spark, root, available_now=True, source_format="parquet", source_path=f"{root}/topics",
                         sink_format="parquet")
    assert len(queries) == 4
    for spec in STREAM_SPECS:
        assert spark.read.parquet(spec.bronze_path(root)).count() == len(recs[spec.name])
    assert spark.read.parquet(SPECS_BY_NAME["job_listings"].bronze_path(root)).first().posted_at == "3 days ago"
