"""Data-quality queries: null rate, freshness, row-count anomaly, grouped suite, failures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.scalars import timestamp_text
from kestrel.operators import dq, newest
from kestrel.plans import bindings as b
from kestrel.plans.registry import AS_OF, AS_OF_SQL, ntz, register
from kestrel.plans.sqltext import fmt, sev, timedelta_text, ts_text

REPO_NULL_COLS = ["full_name", "org", "name", "description", "language", "stars", "forks", "open_issues", "pushed_at"]
STORY_NULL_COLS = ["story_url", "company", "title", "points", "num_comments", "author", "created_at"]
OUT = ["check_name", "table", "passed", "severity", "message", "measured_at", "segment"]


def _null_rate_sql(src: str, table: str, cols: list[str], max_rate: float, seg: str | None = None,
                   n_expr: str = "count(*)") -> str:
    parts = []
    for c in cols:
        rate = f"(CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / {n_expr})"
        parts.append(
            f"SELECT 'null_rate[{c}]' AS check_name, '{table}' AS \"table\", {rate} <= {max_rate!r} AS passed, "
            f"{sev(f'{rate} <= {max_rate!r}', 'warning')} AS severity, "
            f"'null_rate=' || {fmt(rate, 3)} || ' threshold={max_rate!r}' AS message, {AS_OF_SQL} AS measured_at, "
            f"{seg or 'CAST(NULL AS VARCHAR)'} AS segment FROM {src}"
            + (f" GROUP BY {seg}" if seg else "") + " HAVING count(*) > 0"
        )
    return "\nUNION ALL\n".join(parts)


@register(
    "null_rate",
    f"WITH repos AS ({b.REPOS_SQL})\n" + _null_rate_sql("repos", "github_repos", REPO_NULL_COLS, 0.1),
)
def null_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Per-column null rate of the whole repo table against the default 0.1 ceiling."""
    repos = b.repos(b.table(spark, sf, "orders"))
    return ntz(dq.null_rate(repos, "github_repos", 0.1, as_of=AS_OF).select(*OUT))


def _freshness_sql(src: str, table: str, ts: str, max_age_us: int) -> str:
    age = f"(epoch_us({AS_OF_SQL}) - epoch_us(max({ts})))"
    ok = f"coalesce(count(*) > 0 AND max({ts}) IS NOT NULL AND {age} <= {max_age_us}, false)"
    msg = (
        f"CASE WHEN count(*) > 0 THEN 'newest=' || coalesce({ts_text(f'max({ts})')}, 'NaT') || ' age=' || "
        f"coalesce({timedelta_text(age)}, 'NaT') ELSE 'empty or missing column ''{ts}''' END"
    )
    return (
        f"SELECT 'freshness' AS check_name, '{table}' AS \"table\", {ok} AS passed, {sev(ok, 'error')} AS severity, "
        f"{msg} AS message, {AS_OF_SQL} AS measured_at, CAST(NULL AS VARCHAR) AS segment FROM {src}"
    )


TWO_DAYS_US = 2 * 86_400 * 1_000_000


@register(
    "freshness",
    f"WITH repos AS ({b.REPOS_SQL}), stories AS ({b.STORIES_SQL})\n"
    + _freshness_sql("repos", "github_repos", "pushed_at", TWO_DAYS_US)
    + "\nUNION ALL\n"
    + _freshness_sql("stories", "hn_stories", "created_at", TWO_DAYS_US),
)
def freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Newest repo push and newest story against the 2-day SLA at the snapshot time."""
    repos = b.repos(b.table(spark, sf, "orders"))
    stories = b.stories(b.table(spark, sf, "events"))
    out = dq.freshness(repos, "github_repos", "pushed_at", dt.timedelta(days=2), as_of=AS_OF).unionByName(
        dq.freshness(stories, "hn_stories", "created_at", dt.timedelta(days=2), as_of=AS_OF)
    )
    return ntz(out.select(*OUT))


@register(
    "row_count_anomaly",
    f"""
WITH d AS (SELECT CAST(created_at AS DATE) AS day, count(*) AS n FROM ({b.STORIES_SQL}) GROUP BY 1),
last AS (SELECT max(day) AS day FROM d),
cur AS (SELECT coalesce(sum(n), 0) AS current FROM d WHERE day = (SELECT day FROM last)),
base AS (SELECT avg(n) AS mean, stddev_pop(n) AS std, count(n) AS nb FROM d WHERE day < (SELECT day FROM last)),
z AS (SELECT current, mean, nb, (current - mean) / CASE WHEN std IS NULL OR std = 0 THEN 1.0 ELSE std END AS z
      FROM cur, base)
SELECT 'row_count_anomaly' AS check_name, 'hn_stories' AS "table",
       CASE WHEN nb > 0 THEN abs(z) <= 3.0 ELSE true END AS passed,
       {sev("CASE WHEN nb > 0 THEN abs(z) <= 3.0 ELSE true END", "warning")} AS severity,
       CASE WHEN nb > 0 THEN 'current=' || CAST(current AS VARCHAR) || ' baseline_mean=' || {fmt("mean", 1)}
            || ' z=' || {fmt("z", 2)} ELSE 'no baseline yet; current=' || CAST(current AS VARCHAR) END AS message,
       {AS_OF_SQL} AS measured_at, CAST(NULL AS VARCHAR) AS segment
FROM z
""",
)
def row_count_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    """Story count of the last day vs the daily counts of every earlier day (3 sigma)."""
    stories = b.stories(b.table(spark, sf, "events"))
    daily = stories.groupBy(F.to_date("created_at").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    last = daily.agg(F.max("day").alias("last_day"))
    current_rows = stories.join(
        F.broadcast(last.select(F.col("last_day").alias("d"))), F.to_date("created_at") == F.col("d"), "left_semi"
    )
    # Earlier days: anti join against the (one-row) last day, then keep days before it.
    baseline = daily.join(F.broadcast(last.select(F.col("last_day").alias("day"))), "day", "left_anti").select("n")
    return ntz(dq.row_count_anomaly(current_rows, "hn_stories", baseline=baseline, as_of=AS_OF).select(*OUT))


def _suite_sql(src: str, table: str, ts: str, cols: list[str]) -> str:
    stats_cols = ", ".join(
        [f"count(*) AS n", f"max({ts}) AS newest"]
        + [f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS nn_{c}" for c in cols]
    )
    age = f"(epoch_us({AS_OF_SQL}) - epoch_us(newest))"
    ok = f"coalesce(coalesce(n, 0) > 0 AND newest IS NOT NULL AND {age} <= {TWO_DAYS_US}, false)"
    fr_msg = (
        f"CASE WHEN coalesce(n, 0) > 0 THEN 'newest=' || coalesce({ts_text('newest')}, 'NaT') || ' age=' || "
        f"coalesce({timedelta_text(age)}, 'NaT') ELSE 'empty or missing column ''{ts}''' END"
    )
    rows = [
        f"SELECT 'row_count_anomaly' AS check_name, '{table}' AS \"table\", true AS passed, 'info' AS severity, "
        f"'no baseline yet; current=' || CAST(coalesce(n, 0) AS VARCHAR) AS message, {AS_OF_SQL} AS measured_at, seg AS segment FROM j",
        f"SELECT 'freshness', '{table}', {ok}, {sev(ok, 'error')}, {fr_msg}, {AS_OF_SQL}, seg FROM j",
    ]
    for c in cols:
        rate = f"(CAST(nn_{c} AS DOUBLE) / n)"
        rows.append(
            f"SELECT 'null_rate[{c}]', '{table}', {rate} <= 0.5, {sev(f'{rate} <= 0.5', 'warning')}, "
            f"'null_rate=' || {fmt(rate, 3)} || ' threshold=0.5', {AS_OF_SQL}, seg FROM j WHERE coalesce(n, 0) > 0"
        )
    body = "\nUNION ALL\n".join(rows)
    return (
        f"(WITH s AS (SELECT {src}_grp AS seg, {stats_cols} FROM {src} WHERE {src}_grp IS NOT NULL GROUP BY 1),\n"
        f"j AS (SELECT t.org AS seg, s.* EXCLUDE (seg) FROM (SELECT DISTINCT org FROM tracked) t LEFT JOIN s ON t.org = s.seg)\n"
        f"{body})"
    )


@register(
    "dq_suite",
    f"""
WITH tracked AS ({b.TRACKED_SQL}),
repos AS (SELECT *, org AS repos_grp FROM ({b.REPOS_SQL})),
stories AS (SELECT *, company AS stories_grp FROM ({b.STORIES_SQL}))
{_suite_sql("repos", "github_repos", "pushed_at", REPO_NULL_COLS)}
UNION ALL
{_suite_sql("stories", "hn_stories", "created_at", STORY_NULL_COLS)}
""",
)
def dq_suite(spark: SparkSession, sf: str) -> DataFrame:
    """The daily suite for every tracked company: row count, null rate (0.5), freshness (2 days)."""
    return ntz(_suite(spark, sf))


def _suite(spark: SparkSession, sf: str) -> DataFrame:
    tracked = b.tracked(b.table(spark, sf, "customer"))
    repos = b.repos(b.table(spark, sf, "orders"))
    stories = b.stories(b.table(spark, sf, "events"))
    gh = dq.suite(repos, tracked, "github_repos", "org", "pushed_at", as_of=AS_OF,
                  columns=REPO_NULL_COLS)
    hn = dq.suite(stories, tracked, "hn_stories", "company", "created_at", as_of=AS_OF,
                  columns=STORY_NULL_COLS)
    return gh.unionByName(hn).select(*OUT)


@register(
    "recent_failures",
    f"""
WITH tracked AS ({b.TRACKED_SQL}),
repos AS (SELECT *, org AS repos_grp FROM ({b.REPOS_SQL})),
stories AS (SELECT *, company AS stories_grp FROM ({b.STORIES_SQL})),
res AS ({_suite_sql("repos", "github_repos", "pushed_at", REPO_NULL_COLS)}
        UNION ALL
        {_suite_sql("stories", "hn_stories", "created_at", STORY_NULL_COLS)})
SELECT check_name, "table", passed, severity, message, {ts_text("measured_at")} AS measured_at, segment
FROM res WHERE NOT passed
ORDER BY res.measured_at DESC, "table", segment, check_name LIMIT 20
""",
)
def recent_failures(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 newest failing checks, timestamps rendered as text for serving."""
    top = newest.recent_failures(_suite(spark, sf), limit=20)
    return top.select(*[timestamp_text("measured_at").alias(c) if c == "measured_at" else F.col(c) for c in OUT])


PROPS_EXPECTED = {"k": "bigint"}


def _payload_drift_sql() -> str:
    exp = ", ".join(f"('{k}', '{v}')" for k, v in sorted(PROPS_EXPECTED.items()))
    typ = ("CASE json_type(props, '$.\"' || k || '\"') WHEN 'UBIGINT' THEN 'bigint' WHEN 'BIGINT' THEN 'bigint' "
           "WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'BOOLEAN' THEN 'boolean' "
           "WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE 'null' END")
    return f"""
WITH kv AS (SELECT k AS col, {typ} AS typ
            FROM (SELECT props, unnest(json_keys(props)) AS k FROM events WHERE json_valid(props))),
obs AS (SELECT col, CASE WHEN count(DISTINCT typ) FILTER (WHERE typ <> 'null') = 0 THEN 'null'
                         WHEN count(DISTINCT typ) FILTER (WHERE typ <> 'null') = 1 THEN max(typ) FILTER (WHERE typ <> 'null')
                         WHEN bool_and(typ IN ('bigint', 'double', 'null')) THEN 'double'
                         ELSE 'variant' END AS typ
        FROM kv GROUP BY col),
exp AS (SELECT * FROM (VALUES {exp}) v(col, typ)),
a AS (SELECT 'added=[' || string_agg('''' || col || '''', ', ' ORDER BY col) || ']' AS m
      FROM obs WHERE col NOT IN (SELECT col FROM exp) HAVING count(*) > 0),
r AS (SELECT 'removed=[' || string_agg('''' || col || '''', ', ' ORDER BY col) || ']' AS m
      FROM exp WHERE col NOT IN (SELECT col FROM obs) HAVING count(*) > 0),
c AS (SELECT 'type_changed={{' || string_agg('''' || o.col || ''': (''' || e.typ || ''', ''' || o.typ || ''')', ', ' ORDER BY o.col) || '}}' AS m
      FROM obs o JOIN exp e ON o.col = e.col WHERE o.typ <> e.typ HAVING count(*) > 0),
msg AS (SELECT nullif(concat_ws('; ', (SELECT m FROM a), (SELECT m FROM r), (SELECT m FROM c)), '') AS m)
SELECT 'schema_drift' AS check_name, 'events.props' AS "table", m IS NULL AS passed,
       CASE WHEN m IS NULL THEN 'info' ELSE 'warning' END AS severity, coalesce(m, 'no drift') AS message,
       {AS_OF_SQL} AS measured_at, CAST(NULL AS VARCHAR) AS segment
FROM msg"""


@register("payload_schema_drift", _payload_drift_sql())
def payload_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Observed keys and value types of every event payload vs the declared payload schema."""
    ev = b.table(spark, sf, "events")
    return ntz(dq.payload_drift(ev, "props", PROPS_EXPECTED, "events.props", as_of=AS_OF).select(*OUT))
