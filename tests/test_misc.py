import datetime as dt
import json

import pytest

from kestrel import schemas, session
from kestrel.operators import dedup, ranking, signals, upsert
from kestrel.plans import refresh
from kestrel.session import scratch_path
from kestrel.sinks import keyed
from kestrel.sources import landing, payloads

T0 = dt.datetime(2026, 5, 1)


def test_read_landed_records_and_missing_folder(spark):
    path = scratch_path(spark, "landing")
    assert landing.read_records(spark, path, schemas.JOB_LISTINGS).count() == 0
    spark.createDataFrame([(json.dumps({"company": "acme", "title": "Staff Engineer", "location": "Remote",
                                        "posted_at": None, "source_url": "https://jobs.lever.co/acme/123",
                                        "extra": 1}),)], "value string").write.text(path)
    rows = landing.read_records(spark, path, schemas.JOB_LISTINGS).collect()
    assert rows[0].title == "Staff Engineer" and rows[0].posted_at is None and "extra" not in rows[0].asDict()


def test_bootstrap_is_idempotent(spark):
    root = scratch_path(spark, "boot")
    names = ["github_repos", "hn_stories"]
    assert keyed.bootstrap(spark, root, names) == names
    assert keyed.bootstrap(spark, root, names) == []
    made = keyed.keyed_table(root, "github_repos").read(spark)
    assert made.schema.names == schemas.GITHUB_REPOS.names and made.isEmpty()


def test_facts_upsert_refreshes_everything(spark):
    t = spark.createDataFrame([("acme", "Acme", "old", None, None, None, T0)], schemas.WIKIPEDIA_COMPANIES)
    b = spark.createDataFrame([("acme", "Acme Corp", "new", "d", "u", None)],
                              "name string, title string, summary string, description string, url string, thumbnail_url string")
    r = upsert.upsert(t, b, upsert.FACTS_RULE, as_of=T0 + dt.timedelta(days=1)).first()
    assert (r.title, r.summary, r.description, r.scraped_at) == ("Acme Corp", "new", "d", T0 + dt.timedelta(days=1))


def test_demo_checks_log_only_failures(spark):
    store = refresh.Store(scratch_path(spark, "demo"))
    repos = spark.createDataFrame([("o/a", "o", None, T0), ("o/b", "o", None, T0)],
                                  "full_name string, org string, description string, pushed_at timestamp")
    results, logged = refresh.demo_checks(repos, store, as_of=T0 + dt.timedelta(days=2))
    failing = {r.check_name for r in results.collect() if not r.passed}
    assert failing == {"row_count_anomaly", "null_rate[description]"}
    assert logged == 2 and spark.read.parquet(store.alerts).count() == 2


def test_posting_periods_and_spikes(spark):
    day = lambda d: dt.date(2026, 5, d)
    # acme is looked at on days 1 to 10 but for day 5; "x" is gone on day 3 and from day 8 on; "y" stays; day 9 brings 20 postings
    shown = [("acme", "x", day(d)) for d in (1, 2, 4, 6, 7)] + [("acme", "y", day(d)) for d in (1, 2, 3, 4, 6, 7, 8, 9, 10)]
    shown += [("acme", f"n{i}", day(9)) for i in range(20)] + [("acme", "x", day(2)), (None, "z", day(1)), ("beta", "x", day(4))]
    listings = spark.createDataFrame(shown, "company string, source_url string, scraped_on date")
    periods = signals.posting_periods(listings)
    got = {(r.company, r.source_url, r.opened.day): r.closed and r.closed.day for r in periods.collect()}
    assert got[("acme", "x", 1)] == 3 and got[("acme", "x", 4)] == 8 and got[("acme", "y", 1)] is None and got[("acme", "n3", 9)] == 10
    assert got[("beta", "x", 4)] is None and len(got) == 3 + 20 + 1
    # a board seen empty closes what it had
    empty_board = spark.createDataFrame([("beta", day(6))], "company string, day date")
    assert {r.closed for r in signals.posting_periods(listings, snapshots=empty_board).where("company = 'beta'").collect()} == {day(6)}
    activity = {(r.company, r.day.day): r for r in signals.hiring_activity(periods).collect()}
    assert activity[("acme", 9)].openings == 20 and activity[("acme", 9)].spike and activity[("acme", 10)].closings == 20
    assert activity[("acme", 5)].openings == 0 and not activity[("acme", 4)].spike


def test_last_wins_ignores_a_null_order(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, None), ("b", 3, 1)], "k string, v int, seq int")
    assert sorted(map(tuple, dedup.last_wins(df, "k", "seq").collect())) == [("a", 1), ("b", 3)]


def test_rank_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 2), (None, None)], "g string, v int")
    got = {(r.g, r.v): r["rank"] for r in ranking.rank_within(df, "g", "v", buckets=4).collect()}
    assert got == {(None, 3): 1, (None, 1): 2, (None, None): 3, ("a", 2): 1}


def test_baseline_uses_calendar_days(spark):
    day = dt.date(2026, 1, 1)
    counts = spark.createDataFrame([(day, 10), (day + dt.timedelta(days=1), 10), (day + dt.timedelta(days=30), 10)], "day date, n bigint")
    out = {r.day: r for r in signals.rolling_baseline(counts).collect()}
    assert len(out) == 31
    assert (out[day].baseline_days, out[day + dt.timedelta(days=30)].baseline_mean) == (0, 0.0)
    assert out[day + dt.timedelta(days=2)].n == 0 and not out[day + dt.timedelta(days=2)].passed


def test_long_names_are_found(spark):
    docs = spark.createDataFrame([(1, "The Bank of New York said; bank of new jersey"), (2, None)], "doc_id long, text string")
    for names in (["Bank of New York"], spark.createDataFrame([("Bank of New York",)], "name string")):
        assert [tuple(r) for r in signals.mention_match(docs, names, "doc_id").collect()] == [(1, "Bank of New York", 1)]


def test_pages_and_numbers_that_do_not_fit_go_to_quarantine(spark):
    good = '{"full_name": "o/r", "name": "r", "description": null, "language": null, "stargazers_count": "12", "forks_count": 1, "open_issues_count": 0, "pushed_at": "2026-01-01T00:00:00Z"}'
    pages = [f"[{good}]", f"[{good}, ", '{"message": "rate limit"}', "<html>", f"[{good.replace('\"12\"', '3000000000')}]"]
    df = spark.createDataFrame([("o", p) for p in pages], "org string, payload string")
    valid, bad = payloads.parse_repos(df, with_quarantine=True)
    assert [r.stars for r in valid.collect()] == [12]
    assert sorted(r["_bad"] for r in bad.collect()) == ["missing stars", "unparsable page", "unparsable page", "unparsable page"]
    hits = ['{"hits": [{"title": "t", "points": "12", "created_at": "2026-01-01T00:00:00Z"}]}', '{"hits": [{"title"', '{"hits": [{"title": "t", "points": 3000000000, "created_at": "2026-01-01T00:00:00Z"}]}', "{}"]
    valid, bad = payloads.parse_stories(spark.createDataFrame([("c", p) for p in hits], "company string, payload string"), with_quarantine=True)
    assert [r.points for r in valid.collect()] == [12]
    assert sorted(r["_bad"] for r in bad.collect()) == ["bad points", "unparsable page"]


def test_shared_dir_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_sentiment_near_mentions(spark):
    far = " ".join(["filler"] * 20)
    texts = [f"Great news: dbt labs is good. {far} terrible dbt-labs!", f"awful {far} apache {far} bad", "good good dbtlabs labs dbt", None, "", "dbt labs"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.company: tuple(r)[1:] for r in signals.mention_sentiment(docs, ["dbt-labs", "apache"], within=5).collect()}
    assert got == {"dbt-labs": (2, 3, 3, round((1 + 1 - 1) / 3, 6)), "apache": (1, 1, 0, None)}


def test_grams_scale_with_name_starts(spark):
    names = spark.createDataFrame([("Acme Corp of Spain",), ("zeta",), ("Acme",), ("...",)], "name string")
    words = [f"w{i}" for i in range(5000)]
    words[10:14] = ["acme", "corp", "of", "spain"]
    words[4000], words[4999] = "zeta", "acme"
    docs = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, "ZETA zeta")], "id int, text string")
    got = {(r.id, r.name): r.mentions for r in signals.mention_match(docs, names, "id").collect()}
    assert got == {(1, "Acme Corp of Spain"): 1, (1, "Acme"): 2, (1, "zeta"): 1, (3, "zeta"): 2}
    from pyspark.sql import functions as F

    grams = names.select(F.explode(F.array(F.lit("acme corp of spain"), F.lit("zeta"), F.lit("acme"))).alias("gram"))
    first = signals._first_tokens(grams)
    n = docs.where("id = 1").select(signals.tokens(F.col("text")).alias("t")).select(F.size(signals.candidate_grams(F.col("t"), [1, 4], first)).alias("n")).first().n
    assert n <= 20  # three starts, two lengths, and a few chance hits in the bit set; not 5000 x 2


def test_peer_rank_keeps_companies_without_a_group(spark):
    gold = spark.createDataFrame([("a", 10), ("b", 30), ("c", 5), ("d", 5)], "org string, total_stars long")
    peers = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None)], "org string, peer_group string")
    got = {r.org: (r.peer_group, r.peer_rank, r.peer_share) for r in signals.peer_rank(gold, peers).collect()}
    assert got == {"a": ("x", 2, 0.25), "b": ("x", 1, 0.75), "c": (None, 1, 0.5), "d": (None, 1, 0.5)}


def test_page_texts_links_and_headings(spark):
    html = """<html lang='en'><head><title>T</title><style>p {}</style></head><body><ul><li><a href='/a'>Menu one is a long link text here</a></li>
      <li><a class="x" href="/b">Menu two</a></li></ul><H2 id=1>Big &amp; small</H2><p>This paragraph has <b>enough</b> plain text, and <a href=c>one link</a>.</p>
      <script>var a = "<p>not text at all, though long enough</p>";</script><p>short</p><!-- <h1>no</h1> --></body></html>"""
    pages = spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id int, html string")
    main = {r.page_id: r for r in signals.main_text(pages).collect()}
    assert main[1].text == "This paragraph has enough plain text, and one link." and main[1].main_blocks == 1
    assert (main[2].text, main[2].blocks, main[3].main_blocks) == ("", 0, 0)
    links = [(r.position, r.href, r.text) for r in signals.page_links(pages).orderBy("position").collect()]
    assert links == [(0, "/a", "Menu one is a long link text here"), (1, "/b", "Menu two"), (2, "c", "one link")]
    assert [(r.level, r.text) for r in signals.page_headings(pages).collect()] == [(2, "Big & small")]
    assert signals.page_extract(pages).where("page_id = 1").first().lang == "en"
