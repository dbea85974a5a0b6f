import datetime as dt
import json

import pytest

from kestrel.functions.scalars import falsy_coalesce, story_key, timestamp_text
from kestrel.sources import payloads

UTC = dt.timezone.utc


def landed(spark, ctx_name, ctx_value, payload, extra=None):
    cols = f"{ctx_name} string, payload string" + (", " + extra[0] if extra else "")
    row = (ctx_value, payload) + ((extra[1],) if extra else ())
    return spark.createDataFrame([row], cols)


def test_repo_payload(spark):
    payload = json.dumps([{
        "name": "delta", "full_name": "databricks/delta", "stargazers_count": 7500, "forks_count": 1600,
        "open_issues_count": 200, "language": "Scala", "pushed_at": "2026-05-01T12:00:00Z",
        "description": "lakehouse"}])
    rows = payloads.parse_repos(landed(spark, "org", "databricks", payload)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.full_name, r.org, r.stars, r.forks, r.open_issues, r.language) == ("databricks/delta", "databricks", 7500, 1600, 200, "Scala")
    assert r.pushed_at == dt.datetime(2026, 5, 1, 12, 0)


def test_repo_payload_short_names_missing_description_and_quarantine(spark):
    payload = json.dumps([
        {"name": "a", "full_name": "o/a", "stars": 1, "forks": 2, "open_issues": 3, "language": None,
         "pushed_at": "2026-05-01T00:00:00Z"},
        {"name": "b", "full_name": "o/b", "stars": 1, "forks": 2, "open_issues": 3, "language": "Go"},
        {"name": "c", "full_name": "o/c", "stars": 1, "forks": 2, "open_issues": 3, "pushed_at": "2026-05-01T00:00:00Z"},
    ])
    valid, bad = payloads.parse_repos(landed(spark, "org", "o", payload), with_quarantine=True)
    v = valid.collect()
    assert [(r.name, r.description, r.language, r.stars) for r in v] == [("a", None, None, 1)]
    reasons = sorted((r.name, r._bad) for r in bad.collect())
    assert reasons == [("b", "missing pushed_at"), ("c", "missing language")]


def test_story_payload_and_defaults(spark):
    payload = json.dumps({"hits": [
        {"title": "Databricks raises", "url": "https://x.com/a", "points": 234, "author": "pg",
         "created_at": "2026-04-15T08:00:00Z", "num_comments": 56},
        {"title": "", "story_title": "fallback", "url": None, "points": None, "author": "",
         "created_at": "2026-04-15T09:00:00Z"},
        {"title": None, "story_title": None, "url": "", "points": 0, "created_at": "2026-04-15T10:00:00Z"},
    ]})
    rows = payloads.parse_stories(landed(spark, "company", "databricks", payload)).orderBy("created_at").collect()
    assert [(r.title, r.points, r.author, r.num_comments) for r in rows] == [
        ("Databricks raises", 234, "pg", 56), ("fallback", 0, "anonymous", 0), ("(no title)", 0, "anonymous", 0)]
    assert rows[0].story_url == "https://x.com/a"
    assert rows[1].story_url == "https://news.ycombinator.com/item?fallback"
    assert rows[2].story_url == "https://news.ycombinator.com/item?(no title)"


def test_story_payload_without_hits(spark):
    assert payloads.parse_stories(landed(spark, "company", "x", '{"nbHits": 0}')).count() == 0


def test_forum_payload(spark):
    payload = json.dumps({"data": {"children": [{"data": {
        "subreddit": "dataengineering", "title": "Databricks vs Snowflake", "score": 42, "num_comments": 17,
        "author": "someone", "created_utc": 1714521600, "permalink": "/r/x/1"}}, {"data": {}}]}})
    rows = payloads.parse_posts(landed(spark, "subreddit", "requested", payload)).collect()
    assert (rows[0].score, rows[0].num_comments, rows[0].created_utc) == (42, 17, dt.datetime(2024, 5, 1, 0, 0))
    d = rows[1]
    assert (d.subreddit, d.title, d.score, d.author, d.created_utc, d.permalink) == (
        "requested", "(no title)", 0, "[deleted]", dt.datetime(1970, 1, 1), "")


def test_forum_payload_empty(spark):
    df = spark.createDataFrame([(s, '{"data": {"children": []}}') for s in ("a", "b", "c")], "subreddit string, payload string")
    assert payloads.parse_posts(df).count() == 0


def test_company_facts(spark):
    search = spark.createDataFrame([
        ("Databricks", json.dumps({"query": {"search": [{"title": "Databricks"}]}})),
        ("Nobody", json.dumps({"query": {"search": []}})),
        ("Gone", json.dumps({"query": {"search": [{"title": "Gone Inc"}]}})),
        ("NoTitle", json.dumps({"query": {"search": [{"title": "Searched Title"}]}})),
    ], "name string, payload string")
    summaries = spark.createDataFrame([
        ("Databricks", 200, json.dumps({"title": "Databricks", "extract": "A company.", "description": "software",
                                         "content_urls": {"desktop": {"page": "https://w/D"}}, "thumbnail": {"source": "https://i/D"}})),
        ("Gone", 404, "{}"),
        ("NoTitle", 200, json.dumps({"extract": "x", "content_urls": None, "thumbnail": None})),
    ], "name string, status int, payload string")
    titles = payloads.resolve_titles(search)
    assert {r.name: r.searched_title for r in titles.collect()}["Nobody"] is None
    rows = {r.name: r for r in payloads.parse_facts(titles, summaries).collect()}
    assert set(rows) == {"Databricks", "NoTitle"}
    assert (rows["Databricks"].url, rows["Databricks"].thumbnail_url) == ("https://w/D", "https://i/D")
    assert (rows["NoTitle"].title, rows["NoTitle"].url) == ("Searched Title", None)


def test_contributors_are_all_kept(spark):
    payload = json.dumps([{"login": f"u{i}", "contributions": i, "avatar_url": "a"} for i in range(40)])
    rows = payloads.parse_contributors(landed(spark, "repo", "o/r", payload)).collect()
    assert len(rows) == 40 and rows[0].login == "u0"


LEVER = """<html><body>
<div class="posting" data-qa-posting-id="1"><a class="posting-title" href="https://jobs.lever.co/acme/123"><h5>Staff Engineer</h5>
<div class="posting-categories"><span class="sort-by-location posting-category location">Remote</span></div></a></div>
<div class="posting"><a class="posting-title" href=""><h5>  Data &amp; ML Analyst </h5></a></div>
<div class="posting"><a class="posting-title" href="/x"><h5>   </h5></a></div>
</body></html>"""
GREENHOUSE = """<div class="opening"><a href="/acme/jobs/9">Product Designer</a><span class="location">Berlin</span></div>
<div class="opening"><span class="location">Paris</span></div>"""


def test_job_listings(spark):
    pages = spark.createDataFrame([("acme", "https://jobs.lever.co/acme", LEVER)], "company string, url string, html string")
    rows = payloads.parse_listings(pages, "lever").collect()
    assert [(r.title, r.location, r.source_url, r.posted_at) for r in rows] == [
        ("Staff Engineer", "Remote", "https://jobs.lever.co/acme/123", None),
        ("Data & ML Analyst", None, "https://jobs.lever.co/acme", None)]
    gh = spark.createDataFrame([("acme", "https://boards.greenhouse.io/acme", GREENHOUSE)], "company string, url string, html string")
    rows = payloads.parse_listings(gh, "greenhouse").collect()
    assert [(r.title, r.location, r.source_url) for r in rows] == [("Product Designer", "Berlin", "/acme/jobs/9")]
    with pytest.raises(ValueError):
        payloads.parse_listings(gh, "unknown")
    assert payloads.board_url("lever", "acme") == "https://jobs.lever.co/acme"


def test_scalar_helpers(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("", None, "t", dt.datetime(2026, 5, 30, 12, 0)), ("u", "x", "t", dt.datetime(2026, 5, 30, 12, 0, 0, 5))],
                               "url string, b string, title string, ts timestamp")
    rows = df.select(
        falsy_coalesce("url", "b", default="d").alias("c"),
        story_key("url", "title").alias("k"),
        story_key("url", "title", "ts", form="hash").alias("h"),
        timestamp_text("ts").alias("t"),
    ).collect()
    assert rows[0].c == "d" and rows[1].c == "u"
    assert rows[0].k == "https://news.ycombinator.com/item?t" and rows[1].k == "u"
    assert rows[0].h.startswith("hn://2026-05-30T12:00:00+00:00/")
    assert rows[0].t == "2026-05-30 12:00:00+00:00" and rows[1].t == "2026-05-30 12:00:00.000005+00:00"


def test_story_quarantine(spark):
    payload = json.dumps({"hits": [{"title": "ok", "created_at": "2026-04-15T08:00:00Z"}, {"title": "no time"}]})
    valid, bad = payloads.parse_stories(landed(spark, "company", "c", payload), with_quarantine=True)
    assert [r.title for r in valid.collect()] == ["ok"]
    assert [(r.title, r._bad) for r in bad.collect()] == [("no time", "missing created_at")]


def test_broken_contributor_forum_and_summary_pages_are_kept(spark):
    html, cut = "<html>502</html>", '{"data": {"children": [{"data": {"title": "t"'
    pages = spark.createDataFrame([("r1", html), ("r2", '[{"login": "a", "contributions": 1}, {"login": "b"}]'), ("r3", "[]"), ("r4", None), ("r5", '[{"login":"a"')], "repo string, payload string")
    good, bad = payloads.parse_contributors(pages, with_quarantine=True)
    assert [(r.repo, r.login, r.contributions) for r in good.collect()] == [("r2", "a", 1)]
    assert {(r.repo, r._bad) for r in bad.collect()} == {("r1", "unparsable page"), ("r2", "missing contributions"), ("r5", "unparsable page")}

    post = '{"data": {"children": [{"data": {"title": "t", "score": "%s"}}, {"kind": "x"}]}}'
    forums = spark.createDataFrame([("s1", html), ("s2", cut), ("s3", post % "3000000000"), ("s4", post % "5"), ("s5", '{"error": 404}'), ("s6", '{"data": {"children": []}}')],
                                   "subreddit string, payload string")
    good, bad = payloads.parse_posts(forums, with_quarantine=True)
    assert [(r.subreddit, r.score) for r in good.collect()] == [("s4", 5)]
    assert {(r.subreddit, r._bad) for r in bad.collect()} == {("s1", "unparsable page"), ("s2", "unparsable page"), ("s3", "bad score"), ("s3", "malformed record"),
                                                             ("s4", "malformed record"), ("s5", "unparsable page")}

    titles = spark.createDataFrame([(n, "T") for n in "abcdef"] + [("z", None)], "name string, searched_title string")
    summaries = spark.createDataFrame([("a", 200, '{"extract": "fine"}'), ("b", 500, html), ("c", 200, html), ("d", 404, "{}"), ("e", None, '{"extract": "no status"}'), ("f", 200, None)],
                                      "name string, status int, payload string")
    good, bad = payloads.parse_facts(titles, summaries, with_quarantine=True)
    assert {(r.name, r.summary) for r in good.collect()} == {("a", "fine"), ("e", "no status")}
    assert {(r.name, r._bad) for r in bad.collect()} == {("b", "status 500"), ("c", "unparsable page"), ("f", "unparsable page")}
    # and a stored summary survives them
    from kestrel.operators import upsert

    stored = upsert.upsert(upsert.empty_table(spark, "wikipedia_companies"), payloads.parse_facts(titles, summaries.where("name = 'a'")).drop("scraped_at"), upsert.FACTS_RULE)
    again = upsert.upsert(stored, payloads.parse_facts(titles, spark.createDataFrame([("a", 500, html)], summaries.schema)).drop("scraped_at"), upsert.FACTS_RULE)
    assert again.first().summary == "fine"
