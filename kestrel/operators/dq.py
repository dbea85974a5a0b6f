"""Data-quality checks as Spark aggregates.

Result rows follow ``schemas.DQ_RESULT``: check_name, table, passed, severity, message,
measured_at, plus ``segment`` (the company a grouped check ran for; null for whole-frame
checks). Severity is ``info`` when passed, else ``warning`` (row count, drift, null rate)
or ``error`` (freshness). Every comparison is inclusive on the passing side.

Single-frame checks (``row_count_anomaly``, ``freshness``, ``null_rate``) mirror the
one-frame-at-a-time functions. ``suite`` is the scale path: one grouped aggregate per
table, over the union of the tracked list, the rows and the count history, computes row
count, newest event, every column's null count and the baseline statistics for all
tracked companies at once - so a company without rows still gets its row-count and
freshness results, and no join is needed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel import schemas
from kestrel.functions.scalars import timestamp_text

RESULT_COLS = ["check_name", "table", "passed", "severity", "message", "measured_at", "segment"]

# Defaults of the checks (fixed values).
DEFAULT_SIGMA = 3.0
DEFAULT_MAX_NULL_RATE = 0.1
DAG_MAX_NULL_RATE = 0.5
DAG_FRESHNESS_SLA = dt.timedelta(days=2)


def _now(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def _sev(passed: Column, failing: str) -> Column:
    return F.when(passed, F.lit("info")).otherwise(F.lit(failing))


def _row(check: Column | str, table: str, passed: Column, failing: str, message: Column,
         measured_at: Column, segment: Column | None = None) -> Column:
    check_c = F.lit(check) if isinstance(check, str) else check
    return F.struct(
        check_c.alias("check_name"),
        F.lit(table).alias("table"),
        passed.alias("passed"),
        _sev(passed, failing).alias("severity"),
        message.alias("message"),
        measured_at.alias("measured_at"),
        (segment if segment is not None else F.lit(None).cast("string")).alias("segment"),
    )


def _py_float_text(x: float) -> str:
    """The threshold as Python prints it in an f-string (``0.1``, ``0.5``, ``1``)."""
    return str(x)


# --- null indicators (NaN counts as null for floating columns) --------------------------------
def is_missing(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def timedelta_text(micros: Column) -> Column:
    """Render a microsecond duration like Python's ``str(timedelta)``.

    ``5:00:00``, ``2 days, 0:00:00.000123``, ``-1 day, 23:55:00`` (days floor toward -inf).
    """
    day_us = F.lit(86_400_000_000)
    days = F.floor(micros / day_us)
    rem = micros - days * day_us
    h = F.floor(rem / F.lit(3_600_000_000))
    m = F.floor((rem % F.lit(3_600_000_000)) / F.lit(60_000_000))
    s = F.floor((rem % F.lit(60_000_000)) / F.lit(1_000_000))
    us = rem % F.lit(1_000_000)
    clock = F.format_string("%d:%02d:%02d", h, m, s)
    clock = F.when(us != 0, F.concat(clock, F.format_string(".%06d", us))).otherwise(clock)
    day_txt = F.when(days == 0, F.lit("")).otherwise(
        F.concat(days.cast("string"), F.when(F.abs(days) == 1, F.lit(" day, ")).otherwise(F.lit(" days, ")))
    )
    return F.when(micros.isNull(), F.lit(None)).otherwise(F.concat(day_txt, clock))


# --- DQ1 row count --------------------------------------------------------------------------
def _rowcount_fields(current: Column, mean: Column, std: Column, has_baseline: Column, sigma: float):
    std_eff = F.when(std.isNull() | (std == 0), F.lit(1.0)).otherwise(std)
    z = (current.cast("double") - mean) / std_eff
    passed = F.when(has_baseline, F.abs(z) <= F.lit(sigma)).otherwise(F.lit(True))
    msg = F.when(
        has_baseline,
        F.format_string("current=%d baseline_mean=%.1f z=%.2f", current, mean, z),
    ).otherwise(F.format_string("no baseline yet; current=%d", current))
    return passed, msg, z


def _baseline_frame(spark: SparkSession, baseline) -> DataFrame | None:
    if baseline is None:
        return None
    if isinstance(baseline, DataFrame):
        return baseline.select(F.col(baseline.columns[0]).cast("double").alias("n"))
    vals = list(baseline)
    return spark.createDataFrame([(float(v),) for v in vals], "n double")


def row_count_anomaly(df: DataFrame, table: str, baseline=None, sigma: float = DEFAULT_SIGMA,
                      as_of=None) -> DataFrame:
    """Current row count vs baseline mean and population std (std 0 -> 1); no baseline -> pass."""
    spark = df.sparkSession
    cur = df.agg(F.count(F.lit(1)).alias("current"))
    base = _baseline_frame(spark, baseline)
    if base is None:
        stats = cur.select("current", F.lit(None).cast("double").alias("mean"),
                           F.lit(None).cast("double").alias("std"), F.lit(0).cast("bigint").alias("nb"))
    else:
        b = base.agg(F.avg("n").alias("mean"), F.stddev_pop("n").alias("std"), F.count("n").alias("nb"))
        # Two one-row aggregates side by side: union them and take the one non-null value per column.
        both = cur.select("current", *[F.lit(None).cast(t).alias(c) for c, t in (("mean", "double"), ("std", "double"), ("nb", "bigint"))]) \
            .unionByName(b.select(F.lit(None).cast("bigint").alias("current"), "mean", "std", "nb"))
        stats = both.agg(*[F.max(c).alias(c) for c in ("current", "mean", "std", "nb")])
    passed, msg, _ = _rowcount_fields(F.col("current"), F.col("mean"), F.col("std"), F.col("nb") > 0, sigma)
    return stats.select(F.inline(F.array(_row("row_count_anomaly", table, passed, "warning", msg, _now(as_of)))))


# --- DQ2 freshness --------------------------------------------------------------------------
def _freshness_fields(newest: Column, n: Column, now: Column, max_age: dt.timedelta, ts_column: str):
    age_us = F.unix_micros(now) - F.unix_micros(newest)
    limit_us = int(max_age.total_seconds() * 1_000_000)
    ok = (n > 0) & newest.isNotNull() & (age_us <= F.lit(limit_us))
    passed = F.coalesce(ok, F.lit(False))
    msg = F.when(
        n > 0,
        F.concat(
            F.lit("newest="), F.coalesce(timestamp_text(newest), F.lit("NaT")),
            F.lit(" age="), F.coalesce(timedelta_text(age_us), F.lit("NaT")),
        ),
    ).otherwise(F.lit(f"empty or missing column '{ts_column}'"))
    return passed, msg


def freshness(df: DataFrame, table: str, ts_column: str, max_age: dt.timedelta, as_of=None) -> DataFrame:
    """Newest ``ts_column`` no older than ``max_age``; empty frame or missing column fails."""
    now = _now(as_of)
    if ts_column not in df.columns:
        row = _row("freshness", table, F.lit(False), "error", F.lit(f"empty or missing column '{ts_column}'"), now)
        return df.sparkSession.range(1).select(F.inline(F.array(row)))
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.col(ts_column).cast("timestamp")).alias("newest"))
    passed, msg = _freshness_fields(F.col("newest"), F.col("n"), now, max_age, ts_column)
    return stats.select(F.inline(F.array(_row("freshness", table, passed, "error", msg, now))))


# --- DQ3 schema drift -----------------------------------------------------------------------
def schema_of(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def _listed(items: Column) -> Column:
    """``['a', 'b']`` of an array of texts."""
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def _quoted(text: Column) -> Column:
    """The text in quotes: single ones, or double ones if it holds a single quote itself."""
    mark = F.when(F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"')), F.lit('"')).otherwise(F.lit("'"))
    return F.concat(mark, text, mark)


def _drift(observed: DataFrame, expected: dict[str, str], table: str, as_of) -> DataFrame:
    """Result row from the full join of two (column, type) sets."""
    declared = observed.sparkSession.createDataFrame(sorted(expected.items()), "column string, declared string")
    both = observed.join(declared, "column", "full")
    name, old, new = _quoted(F.col("column")), F.col("declared"), F.col("type")
    differs = old.isNotNull() & new.isNotNull() & (old != new)
    change = F.concat(name, F.lit(": ("), _quoted(old), F.lit(", "), _quoted(new), F.lit(")"))

    def found(test: Column, shown: Column) -> Column:
        pairs = F.sort_array(F.collect_list(F.when(test, F.struct(F.col("column").alias("c"), shown.alias("s")))))
        return F.transform(pairs, lambda x: x["s"])

    seen = both.agg(found(old.isNull(), name).alias("a"), found(new.isNull(), name).alias("r"), found(differs, change).alias("c"))
    some = lambda c: F.size(c) > 0
    parts = F.concat_ws(
        "; ",
        F.when(some("a"), F.concat(F.lit("added="), _listed(F.col("a")))),
        F.when(some("r"), F.concat(F.lit("removed="), _listed(F.col("r")))),
        F.when(some("c"), F.concat(F.lit("type_changed={"), F.array_join("c", ", "), F.lit("}"))),
    )
    told = seen.select(parts.alias("m"))
    passed = F.col("m") == ""
    message = F.when(passed, F.lit("no drift")).otherwise(F.col("m"))
    return told.select(F.inline(F.array(_row("schema_drift", table, passed, "warning", message, _now(as_of)))))


def schema_drift(spark: SparkSession, current: dict[str, str] | DataFrame, expected: dict[str, str],
                 table: str, as_of=None) -> DataFrame:
    """Added / removed / type-changed columns by name."""
    cur = schema_of(current) if isinstance(current, DataFrame) else dict(current)
    return _drift(spark.createDataFrame(sorted(cur.items()), "column string, type string"), expected, table, as_of)


# Observed JSON value types -> schema type names (fixed values).
_JSON_TYPES = {"BIGINT": "bigint", "INT": "bigint", "SMALLINT": "bigint", "TINYINT": "bigint", "DECIMAL": "double",
               "DOUBLE": "double", "FLOAT": "double", "STRING": "string", "BOOLEAN": "boolean", "OBJECT": "object",
               "ARRAY": "array", "VOID": "null"}


def observed_json_schema(df: DataFrame, column: str) -> DataFrame:
    """(column, type) of the top-level keys of a JSON text column, merged over all rows.

    Every key and its value's type are rows, collapsed before they are shuffled. Nulls yield to
    any type, numbers of two kinds are double, other mixtures are variant. Rows that are no
    JSON object are ignored.
    """
    parsed = df.select(F.try_parse_json(F.col(column)).alias("__v")).where(F.col("__v").isNotNull())
    parsed.createOrReplaceTempView("__json_rows")
    spark = df.sparkSession
    kv = spark.sql("SELECT e.key AS column, schema_of_variant(e.value) AS t FROM __json_rows, LATERAL variant_explode(__v) e WHERE e.key IS NOT NULL")
    spark.catalog.dropTempView("__json_rows")
    base = F.regexp_extract("t", "^[A-Z_]+", 0)
    names = F.create_map(*[F.lit(x) for pair in _JSON_TYPES.items() for x in pair])
    typed = kv.select("column", F.coalesce(names[base], F.lower(base)).alias("t")).distinct()
    kinds = typed.groupBy("column").agg(F.array_remove(F.collect_set("t"), "null").alias("k"))
    numbers = F.size(F.array_except("k", F.array(F.lit("bigint"), F.lit("double")))) == 0
    merged = F.when(F.size("k") == 0, F.lit("null")).when(F.size("k") == 1, F.col("k")[0]).when(numbers, F.lit("double")).otherwise(F.lit("variant"))
    return kinds.select("column", merged.alias("type"))


def payload_drift(df: DataFrame, column: str, expected: dict[str, str], table: str, as_of=None) -> DataFrame:
    """Schema drift of JSON payloads: observed keys/types vs the declared ones."""
    return _drift(observed_json_schema(df, column), expected, table, as_of)


# --- DQ4 null rate --------------------------------------------------------------------------
def _null_rows(fields: Sequence[T.StructField], n: Column, table: str, max_null_rate: float,
               now: Column, segment: Column | None, prefix: str = "__nulls_") -> Column:
    rows = []
    for f in fields:
        rate = F.col(f"`{prefix}{f.name}`").cast("double") / n.cast("double")
        passed = rate <= F.lit(max_null_rate)
        msg = F.format_string(f"null_rate=%.3f threshold={_py_float_text(max_null_rate)}", rate)
        rows.append(_row(f"null_rate[{f.name}]", table, passed, "warning", msg, now, segment))
    return F.array(*rows)


def batch_metrics(fields: Sequence[T.StructField], ts_column: str | None) -> list[Column]:
    """Rows, missing values per column and newest event time, as aggregates: for ``observe`` on a write."""
    counts = [F.sum(is_missing(f).cast("bigint")).alias(f"__nulls_{f.name}") for f in fields]
    newest = [F.max(F.col(ts_column).cast("timestamp")).alias("newest")] if ts_column else []
    return [F.count(F.lit(1)).alias("__n"), *counts, *newest]


def metric_results(spark: SparkSession, metrics: dict, fields: Sequence[T.StructField], table: str, max_null_rate: float,
                   ts_column: str | None, max_age: dt.timedelta, as_of=None) -> DataFrame:
    """The null-rate and freshness results that ``batch_metrics`` of one batch give (no rows: freshness only)."""
    names = ["__n", *[f"__nulls_{f.name}" for f in fields]]
    schema = ", ".join([*[f"`{c}` bigint" for c in names], "newest timestamp"])
    stats = spark.createDataFrame([(*[metrics.get(c) or 0 for c in names], metrics.get("newest"))], schema)
    now = _now(as_of)
    out = stats.where(F.col("__n") > 0).select(F.inline(_null_rows(fields, F.col("__n"), table, max_null_rate, now, None)))
    if ts_column:
        passed, msg = _freshness_fields(F.col("newest"), F.col("__n"), now, max_age, ts_column)
        out = out.unionByName(stats.select(F.inline(F.array(_row("freshness", table, passed, "error", msg, now)))))
    return out


def null_rate(df: DataFrame, table: str, max_null_rate: float = DEFAULT_MAX_NULL_RATE, as_of=None) -> DataFrame:
    """One result per column (``null_rate[col]``); an empty frame gives no results."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__n")] + [
        F.sum(is_missing(f).cast("bigint")).alias(f"__nulls_{f.name}") for f in fields
    ]
    stats = df.agg(*aggs).where(F.col("__n") > 0)
    return stats.select(F.inline(_null_rows(fields, F.col("__n"), table, max_null_rate, _now(as_of), None)))


# --- DQ5 grouped suite ----------------------------------------------------------------------
def suite(df: DataFrame, tracked: DataFrame, table: str, group: str, ts_column: str, *,
          tracked_key: str = "org",
          max_age: dt.timedelta = DAG_FRESHNESS_SLA, max_null_rate: float = DAG_MAX_NULL_RATE,
          sigma: float = DEFAULT_SIGMA, baseline: DataFrame | None = None, as_of=None,
          columns: Iterable[str] | None = None) -> DataFrame:
    """Row count, per-column null rate and freshness for every tracked company, one pass.

    All rows of ``df`` are checked; ``baseline`` is an optional history ``(segment, n)`` of
    earlier row counts per company. Tracked companies with no rows get row_count (pass
    without baseline) and a failing freshness row, and no null-rate rows.
    """
    now = _now(as_of)
    cols = list(columns) if columns is not None else df.columns
    fields = [df.schema[c] for c in cols]
    rows = df.select(*dict.fromkeys([*cols, group, ts_column])).where(F.col(group).isNotNull())
    # One aggregate over the union of the tracked list, the rows and the count history (each
    # part null in the others' columns): row count, newest event, null counts and baseline
    # statistics per company in a single shuffle of partial aggregates - no joins.
    seg_type = df.schema[group].dataType
    zero, one = F.lit(0), F.lit(1)
    null = {c: F.lit(None).cast(t) for c, t in (("b", "bigint"), ("d", "double"), ("t", "timestamp"))}
    parts = [
        rows.select(F.col(group).alias("__seg"), zero.alias("__t"), one.cast("bigint").alias("__one"),
                    F.col(ts_column).cast("timestamp").alias("__ts"),
                    *[is_missing(f).cast("bigint").alias(f"__z_{f.name}") for f in fields], null["d"].alias("__bn")),
        tracked.select(F.col(tracked_key).cast(seg_type).alias("__seg"), one.alias("__t"), null["b"].alias("__one"),
                       null["t"].alias("__ts"), *[null["b"].alias(f"__z_{f.name}") for f in fields],
                       null["d"].alias("__bn")),
    ]
    if baseline is not None:
        bcols = baseline.columns
        parts.append(baseline.select(
            F.col(bcols[0]).cast(seg_type).alias("__seg"), zero.alias("__t"), null["b"].alias("__one"),
            null["t"].alias("__ts"), *[null["b"].alias(f"__z_{f.name}") for f in fields],
            F.col(bcols[1]).cast("double").alias("__bn")))
    unioned = parts[0]
    for p in parts[1:]:
        unioned = unioned.unionByName(p)
    joined = unioned.where(F.col("__seg").isNotNull()).groupBy("__seg").agg(
        F.max("__t").alias("__tracked"), F.count("__one").alias("__n"), F.max("__ts").alias("__newest"),
        *[F.sum(f"__z_{f.name}").alias(f"__nulls_{f.name}") for f in fields],
        F.avg("__bn").alias("__mean"), F.stddev_pop("__bn").alias("__std"), F.count("__bn").alias("__nb"),
    ).where(F.col("__tracked") == 1)
    n = F.coalesce(F.col("__n"), F.lit(0)).cast("bigint")
    seg = F.col("__seg").cast("string")
    rc_passed, rc_msg, _ = _rowcount_fields(n, F.col("__mean"), F.col("__std"),
                                            F.coalesce(F.col("__nb"), F.lit(0)) > 0, sigma)
    rc = F.array(_row("row_count_anomaly", table, rc_passed, "warning", rc_msg, now, seg))
    nulls = F.when(n > 0, _null_rows(fields, n, table, max_null_rate, now, seg)).otherwise(
        F.array().cast(T.ArrayType(schemas.DQ_RESULT)))
    fr_passed, fr_msg = _freshness_fields(F.col("__newest"), n, now, max_age, ts_column)
    fr = F.array(_row("freshness", table, fr_passed, "error", fr_msg, now, seg))
    return joined.select(F.inline(F.concat(rc, nulls, fr)))


def failures(results: DataFrame) -> DataFrame:
    """Failing results only (``WHERE NOT passed``)."""
    return results.where(~F.col("passed"))


def failure_count(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if(~F.col("passed")).alias("failures"), F.count(F.lit(1)).alias("checks"))
