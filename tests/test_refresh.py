import datetime as dt
import json

import pytest

from kestrel.plans import refresh
from kestrel.sinks import lake
from kestrel.session import scratch_path

AS_OF = dt.datetime(2026, 5, 30, 2, 0, 0)


def repo(name, org, stars, pushed):
    return {"name": name, "full_name": f"{org}/{name}", "stargazers_count": stars, "forks_count": 1,
            "open_issues_count": 0, "language": "Scala", "pushed_at": pushed, "description": "d"}


def test_refresh_end_to_end(spark):
    store = refresh.Store(scratch_path(spark, "refresh"))
    tracked = spark.createDataFrame([("databricks",), ("apache",), ("dbt-labs",)], "org string")
    landed_repos = spark.createDataFrame([
        ("databricks", json.dumps([repo("delta", "databricks", 100, "2026-05-29T00:00:00Z"),
                                   repo("spark", "databricks", 50, "2026-05-29T01:00:00Z")])),
        ("apache", json.dumps([repo("airflow", "apache", 200, "2026-04-01T00:00:00Z")])),
        ("untracked", json.dumps([repo("x", "untracked", 1, "2026-05-29T00:00:00Z")])),
    ], "org string, payload string")
    hits = {"hits": [
        {"title": "A", "url": "https://example.com/a", "points": 1, "author": "x", "created_at": "2026-05-29T00:00:00Z", "num_comments": 2},
        {"title": "A again", "url": "https://example.com/a", "points": 3, "author": "y", "created_at": "2026-05-29T01:00:00Z", "num_comments": 4},
    ]}
    other = {"hits": [{"title": "shared", "url": "https://example.com/a", "points": 9, "author": "z",
                       "created_at": "2026-05-29T02:00:00Z", "num_comments": 1}]}
    landed_stories = spark.createDataFrame([("databricks", json.dumps(hits), 1), ("apache", json.dumps(other), 2)],
                                           "company string, payload string, seq int")
    res = refresh.refresh(spark, store, tracked, landed_repos, landed_stories, AS_OF)
    assert res.repos_written == 3 and res.stories_written == 2
    stories = refresh.read_keyed(spark, store, "hn_stories").collect()
    assert len(stories) == 1
    s = stories[0]
    # within databricks the last duplicate wins; across companies the first company is kept, counters refreshed
    assert (s.company, s.title, s.author, s.points) == ("databricks", "A again", "y", 9)
    gold = {r.org: r for r in lake.read_gold(spark, store.gold("company_signals")).collect()}
    assert gold["databricks"].repo_count == 2 and gold["databricks"].hn_mentions == 1
    assert gold["apache"].total_stars == 200 and gold["apache"].hn_mentions == 0
    assert "untracked" not in gold and "dbt-labs" not in gold
    # dq: 3 companies x 2 tables x (row count + freshness) + null rates for non-empty ones
    alerts = refresh.recent_alerts(spark, store, limit=50).collect()
    failing = {(a.table, a.segment, a.check_name) for a in alerts}
    assert ("github_repos", "apache", "freshness") in failing
    assert ("github_repos", "dbt-labs", "freshness") in failing
    assert ("github_repos", "databricks", "freshness") not in failing
    assert all(a.measured_at == "2026-05-30 02:00:00+00:00" for a in alerts)
    assert res.failures == len(failing) and res.checks > res.failures

    # a repeat of the run replaces what it logged and changes no table
    logs = (store.alerts, store.row_counts, store.bronze("github_repos"), store.bronze("hn_stories"))
    before = [spark.read.parquet(p).count() for p in logs]
    again = refresh.refresh(spark, store, tracked, landed_repos, landed_stories, AS_OF)
    assert (again.checks, again.failures) == (res.checks, res.failures)
    assert [spark.read.parquet(p).count() for p in logs] == before
    assert refresh.read_keyed(spark, store, "github_repos").count() == 3

    # second day: an existing repo changes, names stay from the first insert
    landed_repos2 = spark.createDataFrame([("databricks", json.dumps([dict(repo("delta", "databricks", 120, "2026-05-30T00:00:00Z"),
                                                                          name="renamed")]))], "org string, payload string")
    empty_stories = spark.createDataFrame([], "company string, payload string, seq int")
    res2 = refresh.refresh(spark, store, tracked, landed_repos2, empty_stories, AS_OF + dt.timedelta(days=1))
    assert res2.repos_written == 1 and res2.stories_written == 0
    delta = refresh.read_keyed(spark, store, "github_repos").where("full_name = 'databricks/delta'").first()
    assert (delta.name, delta.stars) == ("delta", 120)


def test_cli_refresh_and_alerts(spark, capsys):
    from kestrel.__main__ import main

    root = scratch_path(spark, "cli")
    spark.createDataFrame([("acme", json.dumps([repo("a", "acme", 5, "2026-05-29T00:00:00Z")]))],
                          "org string, payload string").write.json(f"{root}/repos")
    spark.createDataFrame([("acme", json.dumps({"hits": []}), 1)], "company string, payload string, seq long") \
        .write.json(f"{root}/stories")
    spark.createDataFrame([("acme",), ("ghost",)], "value string").write.text(f"{root}/tracked")
    main(["refresh", "--store", f"{root}/store", "--repos", f"{root}/repos", "--stories", f"{root}/stories",
          "--tracked", f"{root}/tracked", "--as-of", "2026-05-30T02:00:00"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["repos_written"] == 1 and out["gold_rows"] == 1
    main(["alerts", "--store", f"{root}/store"])
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert {(x["segment"], x["check_name"]) for x in lines} >= {("ghost", "freshness")}


def test_refresh_row_count_baseline_from_history(spark):
    store = refresh.Store(scratch_path(spark, "refresh-baseline"))
    tracked = spark.createDataFrame([("acme",)], "org string")
    no_stories = spark.createDataFrame([], "company string, payload string, seq int")

    def day(n_repos, d):
        landed = spark.createDataFrame(
            [("acme", json.dumps([repo(f"r{d}-{i}", "acme", 1, f"2026-05-{d:02d}T00:00:00Z") for i in range(n_repos)]))],
            "org string, payload string")
        return refresh.refresh(spark, store, tracked, landed, no_stories, dt.datetime(2026, 5, d, 2, 0), baseline_days=7)

    for d in range(1, 6):
        day(1, d)  # one new repo per day: 1, 2, 3, 4, 5 rows
    day(50, 6)      # 55 rows against a baseline of 1..5 -> anomaly
    alerts = spark.read.parquet(store.alerts).where(
        "check_name = 'row_count_anomaly' AND `table` = 'github_repos'").orderBy("measured_at").collect()
    assert alerts[0].message == "no baseline yet; current=1"
    assert alerts[1].message.startswith("current=2 baseline_mean=1.0")
    assert not alerts[-1].passed and alerts[-1].message.startswith("current=55 baseline_mean=3.0")


def test_refresh_reads_every_row_and_the_last_page_wins(spark):
    store = refresh.Store(scratch_path(spark, "lake"))
    tracked = spark.createDataFrame([("acme",)], "org string")
    pages = [("acme", json.dumps([repo(f"r{i}", "acme", 1, "2026-05-29T00:00:00Z") for i in range(a, a + 400)]), a) for a in (0, 400, 800)]
    pages.append(("acme", json.dumps([repo("r0", "acme", 5, "2026-05-29T00:00:00Z")]), 2000))
    landed = spark.createDataFrame(pages, "org string, payload string, seq int").repartition(4)
    stories = spark.createDataFrame([], "company string, payload string, seq int")
    refresh.refresh(spark, store, tracked, landed, stories, AS_OF)
    gold = lake.read_gold(spark, store.gold("company_signals")).first()
    assert (gold.repo_count, gold.total_stars) == (1200, 1204)


def test_pages_of_one_small_file_are_parsed_by_many_tasks(spark, monkeypatch):
    from kestrel.plans import queries_io

    class Seen(Exception):
        pass

    def watched(spark, store, tracked, repos, stories, as_of, *, landed_searches, landed_summaries):
        raise Seen([df.rdd.getNumPartitions() for df in (repos, stories, landed_searches, landed_summaries)])

    monkeypatch.setattr(refresh, "refresh", watched)
    sf = scratch_path(spark, "small-files")
    for name, row in (
        ("orders", "id AS o_orderkey, id AS o_custkey, 'O' AS o_orderstatus, '1-URGENT' AS o_orderpriority, 1.0D AS o_totalprice, DATE'2024-01-01' AS o_orderdate"),
        ("events", "id AS event_id, id AS user_id, 'view' AS event_type, 1.0D AS value, TIMESTAMP'2024-01-01' AS ts"),
        ("customer", "id AS c_custkey, 'BUILDING' AS c_mktsegment, 1.0D AS c_acctbal"),
    ):
        spark.range(0, 100, 1, 1).selectExpr(*row.split(", ")).write.parquet(f"{sf}/{name}.parquet")
    with pytest.raises(Seen) as seen:
        queries_io.refresh_twice(spark, sf)
    assert set(seen.value.args[0]) == {int(spark.conf.get("spark.sql.shuffle.partitions"))}
