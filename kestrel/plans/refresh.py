"""The daily refresh as one ordered Spark job: normalise -> upsert -> bronze -> data quality -> gold.

State passes between steps through written tables only, which also cuts the lineage: a lost executor
recomputes from the last written table, not from the raw landing files. Keyed tables are cut into hash
buckets, of which a run replaces those its batch touches; what cannot be read is kept in quarantine tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel import schemas
from kestrel.operators import dedup, dq, newest, rollup, upsert
from kestrel.operators.joins import restrict_to
from kestrel.sinks import keyed, lake, warehouse
from kestrel.session import materialize, path_exists
from kestrel.sources import payloads


@dataclass
class Store:
    """Where the layered tables live (a folder on shared storage) and in which format."""

    root: str
    fmt: str = "parquet"

    def keyed(self, name: str) -> keyed.KeyedTable:
        return keyed.keyed_table(f"{self.root}/operational", name, fmt=self.fmt)

    def quarantine(self, name: str) -> str:
        return f"{self.root}/quarantine/{name}"

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    @property
    def alerts(self) -> str:
        return f"{self.root}/operational/dq_alerts"

    @property
    def row_counts(self) -> str:
        return f"{self.root}/operational/row_counts"


@dataclass
class RefreshResult:
    repos_written: int = 0
    stories_written: int = 0
    facts_written: int = 0
    quarantined: int = 0
    checks: int = 0
    failures: int = 0
    gold_rows: int = 0
    buckets: dict[str, tuple[int, ...]] = field(default_factory=dict)
    gold_run: str | None = None


def read_keyed(spark: SparkSession, store: Store, name: str) -> DataFrame:
    return store.keyed(name).read(spark)


def _apply(store: Store, name: str, batch: DataFrame, seq: str | None, as_of, res: RefreshResult) -> int:
    """Upsert ``batch`` into the keyed table ``name``; returns the rows handed over."""
    written = store.keyed(name).upsert(batch, upsert.RULES[name], seq=seq, as_of=as_of)
    res.buckets[name] = written.buckets
    return written.rows


def _parsed(store: Store, name: str, tagged: DataFrame, run: str, res: RefreshResult) -> DataFrame:
    """The valid rows of a parser's output, staged; the others go to the quarantine table of ``name``, under the run."""
    staged = materialize(tagged, f"refresh-{name}-parsed")
    bad = staged.where(F.col(payloads.BAD).isNotNull())
    n = bad.count()
    if n:
        lake.write_run(bad.select(payloads.BAD, F.to_json(F.struct(*[c for c in bad.columns if c != payloads.BAD])).alias("record")),
                       store.quarantine(name), run, store.fmt)
    res.quarantined += n
    return staged.where(F.col(payloads.BAD).isNull()).drop(payloads.BAD, payloads.PAGE_TEXT)


def refresh(spark: SparkSession, store: Store, tracked: DataFrame, landed_repos: DataFrame,
            landed_stories: DataFrame, as_of: dt.datetime, *,
            freshness_sla: dt.timedelta = dq.DAG_FRESHNESS_SLA, max_null_rate: float = dq.DAG_MAX_NULL_RATE,
            warehouse_project: str | None = None, warehouse_dataset: str | None = None,
            baseline_days: int | None = None, landed_searches: DataFrame | None = None,
            landed_summaries: DataFrame | None = None) -> RefreshResult:
    """Run the four steps for every tracked company.

    ``landed_repos``: (org, payload[, seq]); ``landed_stories``: (company, payload, seq) where
    ``seq`` orders pages by arrival; ``tracked``: (org); ``landed_searches``: (name, payload) and ``landed_summaries``:
    (name, status, payload), encyclopedia responses, where there are any. Each run records the per-company
    row counts it checked. By default the row-count check has no baseline (it passes, as the
    original daily job did); with ``baseline_days`` (e.g. 7, the documented rolling baseline) it
    compares against the counts of the runs in the preceding days.
    """
    res = RefreshResult()
    ts = F.lit(as_of).cast("timestamp")
    run = lake.run_name(as_of)  # a repeat with the same snapshot time replaces its own log rows

    # 1. repos: normalise, keep tracked orgs, upsert, land bronze.
    #    A repository that was landed twice keeps what the later page, and in it the later place, says.
    arrival = F.struct(F.col("seq") if "seq" in landed_repos.columns else F.lit(0).alias("seq"), F.col("position"))
    parsed = payloads.parse_repos(landed_repos, org="org", scraped_at=ts, keep=["seq", "position"], tagged=True)
    repos = _parsed(store, "github_repos", parsed, run, res)
    repos = materialize(restrict_to(repos.withColumn("__seq", arrival), tracked, on="org"), "refresh-repos-batch")
    res.repos_written = _apply(store, "github_repos", repos, "__seq", as_of, res)
    if res.repos_written:
        lake.write_run(schemas.conform(repos, schemas.GITHUB_REPOS), store.bronze("github_repos"), run, store.fmt)

    # 2. stories: normalise; within one company's results a repeated URL keeps its last values;
    #    across companies the upsert rule applies (first company kept, counters from the last).
    st = _parsed(store, "hn_stories", payloads.parse_stories(landed_stories, company="company", scraped_at=ts, tagged=True), run, res)
    st = restrict_to(st, tracked.select(F.col("org").alias("company")), on="company")
    st = st.withColumn("__seq", F.struct(F.col("seq"), F.col("position")))
    deduped = materialize(dedup.last_wins(st.select(*schemas.HN_STORIES.names, "__seq"), ["company", "story_url"],
                                          "__seq", keep_seq=True), "refresh-stories-batch")
    res.stories_written = _apply(store, "hn_stories", deduped, "__seq", as_of, res)
    if res.stories_written:
        lake.write_run(schemas.conform(deduped, schemas.HN_STORIES), store.bronze("hn_stories"), run, store.fmt)

    #    Company facts, where they were fetched: a response that is no page never overwrites a stored one.
    if landed_searches is not None and landed_summaries is not None:
        facts = payloads.parse_facts(payloads.resolve_titles(landed_searches), landed_summaries, scraped_at=ts, tagged=True)
        facts = _parsed(store, "wikipedia_companies", facts, run, res)
        facts = restrict_to(facts, tracked.select(F.col("org").alias("name")), on="name")
        res.facts_written = _apply(store, "wikipedia_companies", facts, None, as_of, res)

    # 3. data quality over all rows of the tracked companies, read back from the written tables.
    tracked_co = tracked.select(F.col("org").alias("company"))
    gh = restrict_to(read_keyed(spark, store, "github_repos"), tracked, on="org")
    hn = restrict_to(read_keyed(spark, store, "hn_stories"), tracked_co, on="company")
    gh_base = _baseline(spark, store, "github_repos", as_of, baseline_days)
    hn_base = _baseline(spark, store, "hn_stories", as_of, baseline_days)
    results = dq.suite(gh, tracked, "github_repos", "org", schemas.EVENT_TIME["github_repos"],
                       baseline=gh_base, max_age=freshness_sla, max_null_rate=max_null_rate, as_of=as_of).unionByName(
        dq.suite(hn, tracked, "hn_stories", "company", schemas.EVENT_TIME["hn_stories"], baseline=hn_base,
                 max_age=freshness_sla, max_null_rate=max_null_rate, as_of=as_of))
    results = schemas.conform(results, schemas.DQ_RESULT)
    lake.write_run(_counts(tracked, gh, "org", "github_repos", ts).unionByName(_counts(tracked, hn, "company", "hn_stories", ts)),
                   store.row_counts, run, store.fmt)
    lake.write_run(results, store.alerts, run, store.fmt)
    counts = spark.read.format(store.fmt).load(store.alerts).where(F.col(lake.RUN) == run).agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("passed")).alias("failures")).first()
    res.checks, res.failures = int(counts["checks"]), int(counts["failures"])

    # 4. gold over the same rows; publish the snapshot and the optional warehouse copy.
    gold = schemas.conform(rollup.company_signals(gh, hn, as_of=as_of), schemas.COMPANY_SIGNALS)
    if not gold.isEmpty():
        res.gold_run = lake.write_gold(gold, store.gold("company_signals"), as_of, store.fmt)
        published = lake.read_gold(spark, store.gold("company_signals"), store.fmt, res.gold_run)
        res.gold_rows = published.count()
        warehouse.write_warehouse(published, "company_signals", mode="overwrite", project=warehouse_project,
                                  dataset=warehouse_dataset)
    return res


def _baseline(spark: SparkSession, store: Store, table: str, as_of: dt.datetime, days: int | None) -> DataFrame | None:
    """(segment, n) row counts recorded by the runs of the ``days`` days before ``as_of``."""
    if not days or not path_exists(spark, store.row_counts):
        return None
    hist = spark.read.format(store.fmt).load(store.row_counts)
    lo = F.lit(as_of - dt.timedelta(days=days)).cast("timestamp")
    hi = F.lit(as_of).cast("timestamp")
    return hist.where((F.col("table") == table) & (F.col("measured_at") >= lo) & (F.col("measured_at") < hi)) \
        .select("segment", "n")


def _counts(tracked: DataFrame, rows: DataFrame, group: str, table: str, ts) -> DataFrame:
    """Row count per tracked company (0 for companies without rows)."""
    counts = rows.groupBy(F.col(group).alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    return tracked.select(F.col("org").alias("segment")).distinct().join(counts, "segment", "left").select(
        "segment", F.lit(table).alias("table"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), ts.alias("measured_at"))


def recent_alerts(spark: SparkSession, store: Store, limit: int = 20) -> DataFrame:
    """The serving query: newest failing checks, timestamps as text."""
    from kestrel.functions.scalars import timestamp_text

    alerts = spark.read.format(store.fmt).load(store.alerts).drop(lake.RUN)
    top = newest.recent_failures(alerts, limit)
    return top.withColumn("measured_at", timestamp_text("measured_at"))


# Thresholds of the interactive demo run (fixed values).
DEMO_BASELINE = [20, 25, 30, 28, 27]
DEMO_MAX_AGE = dt.timedelta(days=365)
DEMO_MAX_NULL_RATE = 0.2


def demo_checks(repos: DataFrame, store: Store, as_of=None) -> tuple[DataFrame, int]:
    """Checks on a freshly scraped frame (not read back); only failures are logged.

    Returns the results frame and the number of failing rows appended to the alert log.
    """
    results = dq.row_count_anomaly(repos, "github_repos", baseline=DEMO_BASELINE, as_of=as_of).unionByName(
        dq.freshness(repos, "github_repos", "pushed_at", DEMO_MAX_AGE, as_of=as_of)).unionByName(
        dq.null_rate(repos, "github_repos", DEMO_MAX_NULL_RATE, as_of=as_of))
    return results, lake.append_results(results, store.alerts, only_failures=True, fmt=store.fmt, run="demo")
