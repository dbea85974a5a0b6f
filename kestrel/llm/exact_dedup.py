"""Exact de-duplication by progressive refinement, in DataFrame operations only.

Texts are equal when they are identical after every run of ASCII white space is made one space.
Documents are grouped by length, those whose length another shares by a hash of their first
characters, and only those still sharing a group by the SHA-256 of their whole text.

One scan writes each text's length and prefix hash (12 bytes a row); the first two steps are
aggregates of that table. Lengths are counted in ``LENGTH_SLOTS`` slots, as there are few of them at
any size. Prefix hashes that two rows share are listed as they are, so a row of its own prefix is
never read in full, however large the table grows. Up to ``BROADCAST_KEYS`` of them (8 MB) the list is
broadcast and no text moves; beyond that it is joined by a shuffle, both sides being written
tables, so that a hash that a third of all rows share is split. Equal hashes merely let a row
through; equality rests on the last step alone.

Defined results: a null text is empty; empty texts are equal to each other; of equal texts the
smallest doc_id stays (a null id only if there is no other); of rows that repeat both id and text
exactly one stays; a very long text is one value, read whole; an empty table yields no rows; other
columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, text_or_empty

LENGTH_SLOTS = 1 << 16
#: Shared prefix hashes, of 8 bytes, that are broadcast at most.
BROADCAST_KEYS = 1 << 20
PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """Every run of ``[\\x20\\x09-\\x0D]`` as one space (a lone space is left as it stands)."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def shared_prefixes(docs: DataFrame, prefix_chars: int, length_slots: int) -> DataFrame:
    """Prefix hashes that more than one row has, among rows whose length another row has."""
    norm = docs.select(normalised(text_or_empty()).alias("norm"))
    keys = materialize(norm.select(F.length("norm").alias("length"), _prefix(prefix_chars).alias("prefix")), "dedup-keys")
    keys = keys.withColumn("slot", F.pmod("length", F.lit(length_slots)))
    lengths = keys.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("slot")
    counted = keys.join(F.broadcast(lengths), "slot", "left_semi").groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counted.filter("n > 1").select("prefix"), "dedup-prefixes")


def _prefix(chars: int) -> Column:
    return F.xxhash64(F.length("norm"), F.substring("norm", 1, chars))


def refine(docs: DataFrame, carry: list[str], prefix_chars: int = PREFIX_CHARS, length_slots: int = LENGTH_SLOTS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """doc (struct of the columns in ``carry``), norm, and full_hash, which is null where no other row can be equal."""
    shared = shared_prefixes(docs, prefix_chars, length_slots)
    small = shared.count() <= broadcast_keys
    shared = shared.withColumn("same_prefix", F.lit(True))
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"), normalised(text_or_empty()).alias("norm"))
    base = base.withColumn("prefix", _prefix(prefix_chars))
    if small:
        marked = base.join(F.broadcast(shared), "prefix", "left")
    elif "text" in carry:
        # The text moves once, inside doc.
        marked = base.drop("norm").join(shared.hint("merge"), "prefix", "left").withColumn("norm", normalised(text_or_empty("doc.text")))
    else:
        marked = base.join(shared.hint("merge"), "prefix", "left")
    return marked.select("doc", "norm", F.when(F.col("same_prefix"), F.sha2("norm", 256)).alias("full_hash"))


def dedup(docs: DataFrame, carry: list[str], digest: bool = False) -> DataFrame:
    """doc (struct of the columns in ``carry``, doc_id among them), keep_id, group_size, kept; with ``digest`` also text_sha256."""
    refined = refine(docs, carry)
    columns = [F.col("doc"), F.monotonically_increasing_id().alias("rid"), F.col("full_hash")]
    if digest:
        columns.append(F.coalesce("full_hash", F.sha2("norm", 256)).alias("text_sha256"))
    staged = materialize(refined.select(*columns), "dedup-rows")

    hashed = staged.filter(F.col("full_hash").isNotNull())
    first = F.min(F.struct(F.col("doc.doc_id").isNull().alias("no_id"), F.col("doc.doc_id").alias("doc_id"), "rid")).alias("first")
    groups = hashed.groupBy("full_hash").agg(first, F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    groups = materialize(groups.select("full_hash", F.col("first.doc_id").alias("keep_id"), F.col("first.rid").alias("keep_rid"), "size"), "dedup-groups")

    # Both sides are plain tables, so a hash that a third of all rows share is split at run time.
    out = ["doc", *(["text_sha256"] if digest else [])]
    joined = hashed.join(groups, "full_hash", "left").select(
        *out,
        F.when(F.col("size").isNull(), F.col("doc.doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("size").isNull() | (F.col("rid") == F.col("keep_rid"))).alias("kept"),
    )
    alone = staged.filter(F.col("full_hash").isNull()).select(
        *out, F.col("doc.doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    return joined.unionByName(alone)


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text an earlier id has."""
    return dedup(docs, docs.columns).filter("kept").select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


__all__ = ["normalised", "refine", "dedup", "keep_first"]
