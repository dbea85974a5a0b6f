import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel import schemas
from kestrel.operators import dedup, rollup, upsert

AS_OF = dt.datetime(2026, 5, 30, 2, 0, 0)


def test_company_signals_joins_and_zero_fills(spark):
    gh = spark.createDataFrame(
        [("databricks/delta", "databricks", 100, 10, 1), ("databricks/spark", "databricks", 50, 5, 2),
         ("apache/airflow", "apache", 200, 20, 3)],
        "full_name string, org string, stars int, forks int, open_issues int")
    hn = spark.createDataFrame([("a", "databricks", 10), ("b", "databricks", 5)], "story_url string, company string, points int")
    by = {r.org: r for r in rollup.company_signals(gh, hn, as_of=AS_OF).collect()}
    assert by["databricks"].repo_count == 2 and by["databricks"].total_stars == 150
    assert by["databricks"].hn_mentions == 2 and by["databricks"].hn_points == 15
    assert by["apache"].hn_mentions == 0 and by["apache"].total_stars == 200
    assert by["apache"].computed_at == AS_OF


def test_company_signals_empty_inputs(spark):
    gh = spark.createDataFrame([], "full_name string, org string, stars int, forks int, open_issues int")
    hn = spark.createDataFrame([], "story_url string, company string, points int")
    assert rollup.company_signals(gh, hn).isEmpty()


def test_company_signals_drops_null_org_and_one_sided(spark):
    gh = spark.createDataFrame([("x/1", None, 1, 1, 1)], "full_name string, org string, stars int, forks int, open_issues int")
    hn = spark.createDataFrame([("u", "only-hn", 7)], "story_url string, company string, points int")
    rows = rollup.company_signals(gh, hn, as_of=AS_OF).collect()
    assert [(r.org, r.repo_count, r.hn_points) for r in rows] == [("only-hn", 0, 7)]
    assert dict(rollup.company_signals(gh, hn).dtypes)["repo_count"] == "bigint"


def test_dedup_last_wins(spark):
    df = spark.createDataFrame(
        [("https://example.com/a", "A", 1, 0), ("https://example.com/a", "A again", 3, 1), ("b", "B", 5, 2)],
        "story_url string, title string, points int, seq int")
    rows = {r.story_url: r for r in dedup.last_wins(df, "story_url", "seq").collect()}
    assert len(rows) == 2 and rows["https://example.com/a"].title == "A again" and rows["https://example.com/a"].points == 3


STORY_T = "story_url string, company string, title string, points int, num_comments int, author string, created_at timestamp, scraped_at timestamp"
STORY_B = "story_url string, company string, title string, points int, num_comments int, author string, created_at timestamp, seq int"
T0 = dt.datetime(2026, 5, 1)


def test_upsert_rules(spark):
    target = spark.createDataFrame([
        ("u1", "acme", "old", 1, 1, None, T0, T0),     # author null must stay null (kept column)
        ("u2", "acme", "keep", 2, 2, "z", T0, T0),      # untouched
    ], STORY_T)
    batch = spark.createDataFrame([
        ("u1", "other", "new", 10, 11, "y", T0, 0),
        ("u1", "other2", "newer", 20, 21, "w", T0, 1),  # duplicate key in batch: refreshed from the last
        ("u3", "beta", "first", 5, 6, "q", T0, 2),
        ("u3", "gamma", "second", 7, 8, "r", T0, 3),    # kept from the first, refreshed from the last
    ], STORY_B)
    out = {r.story_url: r for r in upsert.upsert(target, batch, upsert.STORIES_RULE, seq="seq", as_of=AS_OF).collect()}
    assert set(out) == {"u1", "u2", "u3"}
    assert (out["u1"].company, out["u1"].title, out["u1"].author) == ("acme", "old", None)
    assert (out["u1"].points, out["u1"].num_comments, out["u1"].scraped_at) == (20, 21, AS_OF)
    assert (out["u2"].points, out["u2"].scraped_at) == (2, T0)
    assert (out["u3"].company, out["u3"].title, out["u3"].points) == ("beta", "first", 7)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcde"), st.integers(0, 9), st.integers(0, 9)), min_size=0, max_size=12),
       st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(0, 9), st.integers(0, 9)), min_size=0, max_size=12))
def test_upsert_matches_dict_model(spark, first, second):
    """Applying two batches row by row to a dict gives the same table as the Spark merge."""
    def apply(model, rows, stamp):
        for key, kept, refreshed in rows:
            if key in model:
                model[key] = (model[key][0], refreshed, stamp)
            else:
                model[key] = (kept, refreshed, stamp)

    model = {}
    apply(model, first, 1)
    apply(model, second, 2)
    rule = upsert.UpsertRule("t", ("k",), ("a",), ("b",), "s")
    empty = spark.createDataFrame([], "k string, a int, b int, s int")
    b1 = spark.createDataFrame([(k, a, b, i) for i, (k, a, b) in enumerate(first)], "k string, a int, b int, seq int")
    b2 = spark.createDataFrame([(k, a, b, i) for i, (k, a, b) in enumerate(second)], "k string, a int, b int, seq int")
    s1 = upsert.upsert(empty, b1, rule, seq="seq", as_of=__import__("pyspark.sql.functions", fromlist=["x"]).lit(1))
    s2 = upsert.upsert(s1, b2, rule, seq="seq", as_of=__import__("pyspark.sql.functions", fromlist=["x"]).lit(2))
    got = {r.k: (r.a, r.b, r.s) for r in s2.collect()}
    assert got == model


def test_empty_table_and_written_count(spark):
    assert upsert.empty_table(spark, "github_repos").schema == schemas.GITHUB_REPOS
    assert upsert.written_count(spark.createDataFrame([], "k string")) == 0


def test_upsert_ignores_null_keys(spark):
    target = spark.createDataFrame([], STORY_T)
    batch = spark.createDataFrame([(None, "c", "t", 1, 1, "a", T0, 0), ("u", "c", "t", 1, 1, "a", T0, 1)], STORY_B)
    out = upsert.upsert(target, batch, upsert.STORIES_RULE, seq="seq", as_of=AS_OF)
    assert [r.story_url for r in out.collect()] == ["u"]


def test_merge_sql_text_and_unsupported_table(spark):
    sql = upsert.merge_sql(upsert.STORIES_RULE, "delta.`/t`", "b", "TIMESTAMP '2026-05-30 02:00:00'")
    assert "ON t.`story_url` = s.`story_url`" in sql
    assert "UPDATE SET t.`points` = s.`points`, t.`num_comments` = s.`num_comments`, t.`scraped_at` = TIMESTAMP" in sql
    assert "t.`company`" not in sql.split("WHEN NOT MATCHED")[0]  # kept columns are never updated
    assert "INSERT (`story_url`, `company`, `title`, `author`, `created_at`, `points`, `num_comments`, `scraped_at`)" in sql
    facts = upsert.merge_sql(upsert.FACTS_RULE, "t1", "s1")
    assert "t.`title` = s.`title`" in facts
    import pytest

    batch = spark.createDataFrame([("u", "c", "t", 1, 1, "a", T0, 0)], STORY_B)
    path = __import__("kestrel.session", fromlist=["x"]).scratch_path(spark, "merge-parquet")
    batch.drop("seq").write.parquet(path)
    with pytest.raises(Exception):
        upsert.merge_into(spark, f"parquet.`{path}`", batch, upsert.STORIES_RULE, seq="seq", as_of=AS_OF)
