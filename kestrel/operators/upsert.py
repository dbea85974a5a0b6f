"""Keyed upserts with per-column conflict rules (insert-or-update on a primary key).

Rules per column on a key conflict:
  * kept      - value from the first insert survives (an existing null stays null);
  * refreshed - value from the newest batch row replaces the stored one;
  * stamp     - set to ``as_of`` on every row the batch touches.

A batch may hold the same key several times (rows are applied in arrival order ``seq``):
kept columns take the first row, refreshed the last. A row without ``seq`` counts as the earliest; rows of
one ``seq`` are ordered by their values. The batch is first collapsed per key with ``min_by`` / ``max_by``
(partial aggregates, skew-safe), so the merge, a full outer join on the key, sees unique keys on both sides.

``sinks.keyed`` applies a rule to stored tables, bucket by bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel import schemas


@dataclass(frozen=True)
class UpsertRule:
    table: str
    key: tuple[str, ...]
    kept: tuple[str, ...]
    refreshed: tuple[str, ...]
    stamp: str | None = "scraped_at"


# Conflict rules of the three keyed tables.
REPOS_RULE = UpsertRule(
    "github_repos", tuple(schemas.KEYS["github_repos"]), ("org", "name"),
    ("description", "language", "stars", "forks", "open_issues", "pushed_at"),
)
STORIES_RULE = UpsertRule(
    "hn_stories", tuple(schemas.KEYS["hn_stories"]), ("company", "title", "author", "created_at"),
    ("points", "num_comments"),
)
FACTS_RULE = UpsertRule(
    "wikipedia_companies", tuple(schemas.KEYS["wikipedia_companies"]), (),
    ("title", "summary", "description", "url", "thumbnail_url"),
)
RULES = {r.table: r for r in (REPOS_RULE, STORIES_RULE, FACTS_RULE)}


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def collapse_batch(batch: DataFrame, rule: UpsertRule, seq: str | None) -> DataFrame:
    """One row per key: kept columns from the first arrival, refreshed from the last.

    Rows with a null key are not applied (a primary key cannot be null).
    """
    keys = list(rule.key)
    for k in keys:
        batch = batch.where(F.col(k).isNotNull())
    if seq is None:
        # Without an order the outcome must still not depend on partitioning: the rows' own values order them.
        values = [*rule.kept, *rule.refreshed]
        one = batch.groupBy(*keys).agg(F.max(F.struct(*values)).alias("__v"))
        return one.select(*keys, *[F.col("__v")[c].alias(c) for c in values])
    aggs = []
    # Never null, so that no row is passed over: a row without a place in the order comes first.
    arrival = F.struct(F.col(seq).isNotNull(), F.col(seq), F.struct(*rule.kept, *rule.refreshed))
    if rule.kept:
        aggs.append(F.min_by(F.struct(*rule.kept), arrival).alias("__k"))
    if rule.refreshed:
        aggs.append(F.max_by(F.struct(*rule.refreshed), arrival).alias("__r"))
    out = batch.groupBy(*keys).agg(*aggs)
    return out.select(
        *keys,
        *[F.col("__k")[c].alias(c) for c in rule.kept],
        *[F.col("__r")[c].alias(c) for c in rule.refreshed],
    )


def upsert(target: DataFrame, batch: DataFrame, rule: UpsertRule, seq: str | None = None,
           as_of=None) -> DataFrame:
    """The new full state of the keyed table after applying ``batch`` to ``target``.

    A full outer join on the key; ``sinks.keyed`` runs it on the touched buckets of a stored table.
    """
    keys = list(rule.key)
    cols = keys + list(rule.kept) + list(rule.refreshed)
    stamp = rule.stamp
    s = collapse_batch(batch, rule, seq)
    s = s.select(*[F.col(c).alias(f"s__{c}") for c in cols], F.lit(True).alias("s__hit"))
    t_cols = cols + ([stamp] if stamp and stamp in target.columns else [])
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in t_cols], F.lit(True).alias("t__hit"))
    cond = [F.col(f"t__{k}") == F.col(f"s__{k}") for k in keys]

    def merged(df: DataFrame) -> DataFrame:
        s_hit = F.col("s__hit").isNotNull()
        t_hit = F.col("t__hit").isNotNull()
        out = [F.when(t_hit, F.col(f"t__{k}")).otherwise(F.col(f"s__{k}")).alias(k) for k in keys]
        out += [F.when(t_hit, F.col(f"t__{c}")).otherwise(F.col(f"s__{c}")).alias(c) for c in rule.kept]
        out += [F.when(s_hit, F.col(f"s__{c}")).otherwise(F.col(f"t__{c}")).alias(c) for c in rule.refreshed]
        if stamp:
            old = F.col(f"t__{stamp}") if stamp in target.columns else F.lit(None).cast(T.TimestampType())
            out.append(F.when(s_hit, _as_of(as_of)).otherwise(old).alias(stamp))
        return df.select(*out)

    return merged(t.join(s, on=cond, how="full"))


def empty_table(spark, name: str) -> DataFrame:
    """An empty frame with the declared schema of ``name`` (bootstrap of a keyed table)."""
    return spark.createDataFrame([], schemas.ENTITY_SCHEMAS[name])


def written_count(batch: DataFrame) -> int:
    """Rows handed to the store by one upsert call (the batch size; 0 when empty)."""
    return 0 if batch.isEmpty() else batch.count()


def merge_sql(rule: UpsertRule, target: str, source: str, as_of_sql: str = "current_timestamp()") -> str:
    """``MERGE INTO`` text applying ``rule`` for tables that support it (delta, iceberg).

    ``source`` must already hold one row per key (see ``collapse_batch``).
    """
    keys = list(rule.key)
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    sets = [f"t.`{c}` = s.`{c}`" for c in rule.refreshed]
    cols = keys + list(rule.kept) + list(rule.refreshed)
    ins_cols = [f"`{c}`" for c in cols]
    ins_vals = [f"s.`{c}`" for c in cols]
    if rule.stamp:
        sets.append(f"t.`{rule.stamp}` = {as_of_sql}")
        ins_cols.append(f"`{rule.stamp}`")
        ins_vals.append(as_of_sql)
    matched = f"WHEN MATCHED THEN UPDATE SET {', '.join(sets)}\n" if sets else ""
    return (
        f"MERGE INTO {target} t\nUSING {source} s\nON {on}\n{matched}"
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(ins_cols)}) VALUES ({', '.join(ins_vals)})"
    )


def merge_into(spark, target: str, batch: DataFrame, rule: UpsertRule, seq: str | None = None, as_of=None) -> None:
    """Upsert ``batch`` into a table that supports ``MERGE`` (e.g. ``delta.`/path```), in place."""
    import uuid

    view = f"kestrel_batch_{uuid.uuid4().hex[:8]}"
    collapse_batch(batch, rule, seq).createOrReplaceTempView(view)
    ts = "current_timestamp()" if as_of is None else f"TIMESTAMP '{as_of:%Y-%m-%d %H:%M:%S.%f}'"
    try:
        spark.sql(merge_sql(rule, target, view, ts))
    finally:
        spark.catalog.dropTempView(view)
