"""Exact token counts from a length histogram.

Documents are encoded once and aggregated by encoded length; the histogram, one row per distinct
length, is all that is shuffled. Running and suffix sums over it answer, exactly and for every
context limit: how many documents are cut, the tokens kept when each is truncated at the limit,
the total, and the quantile a length stands at.

Defined results: a null text is empty and has length 0 (it is counted); repeated rows each
count; an empty table yields no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kestrel.llm.common import id_text, materialize
from kestrel.llm.encoders import SpacedEncoder, encoder

#: Neighbouring lengths whose sums are made together; the sums of these ranges are then added up.
RANGE = 256


def token_lengths(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and n_tokens of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(SpacedEncoder, path)
        for batch in batches:
            counts = [len(enc.encode(t.encode())) // 4 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    id_type = dict(docs.select("doc_id").dtypes)["doc_id"]
    return id_text(docs).mapInArrow(run, f"doc_id {id_type}, n_tokens long")


def length_histogram(lengths: DataFrame, col: str = "n_tokens") -> DataFrame:
    """n_tokens and n_docs: one row per distinct length."""
    return lengths.groupBy(F.col(col).alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(hist: DataFrame, span: int = RANGE) -> DataFrame:
    """Answers at every distinct length L as context limit.

    docs_within / docs_over: documents of at most / more than L tokens; tokens_within: tokens of
    the former; total_docs, total_tokens; truncated_total: tokens left when each document is cut
    at L; tokens_lost; quantile: the share of documents of at most L tokens.

    Sums run within ranges of ``span`` lengths, and range totals (one row per range, bounded by
    the longest text over ``span``) are added up in one small window.
    """
    # Written once: it is read twice below, and must not be encoded twice.
    hist = materialize(hist, "token-histogram")
    h = hist.select("n_tokens", "n_docs", F.floor(F.col("n_tokens") / span).alias("part"), (F.col("n_tokens") * F.col("n_docs")).alias("tokens"))
    sums = h.groupBy("part").agg(F.sum("n_docs").alias("part_docs"), F.sum("tokens").alias("part_tokens"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    zero = F.lit(0).cast("long")
    parts = sums.select(
        "part",
        F.coalesce(F.sum("part_docs").over(before), zero).alias("docs_before"),
        F.coalesce(F.sum("part_tokens").over(before), zero).alias("tokens_before"),
        F.sum("part_docs").over(everything).alias("total_docs"),
        F.sum("part_tokens").over(everything).alias("total_tokens"),
    )
    inside = W.partitionBy("part").orderBy("n_tokens").rowsBetween(W.unboundedPreceding, 0)
    run = h.join(parts, "part").select(
        "n_tokens", "n_docs", "total_docs", "total_tokens",
        (F.col("docs_before") + F.sum("n_docs").over(inside)).alias("docs_within"),
        (F.col("tokens_before") + F.sum("tokens").over(inside)).alias("tokens_within"),
    )
    over = F.col("total_docs") - F.col("docs_within")
    kept = F.col("tokens_within") + over * F.col("n_tokens")
    return run.select(
        "n_tokens", "n_docs", "docs_within", over.alias("docs_over"), "tokens_within", "total_docs", "total_tokens",
        kept.alias("truncated_total"), (F.col("total_tokens") - kept).alias("tokens_lost"),
        (F.col("docs_within") / F.col("total_docs")).alias("quantile"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """Truncated totals for stated limits: limit, docs_over, truncated_total. Limits may lie between lengths."""
    wanted = F.explode(F.array(*[F.lit(int(x)) for x in limits])).alias("limit")
    below = F.col("n_tokens") <= F.col("limit")

    def last(value: Column) -> Column:
        return F.max_by(F.when(below, value), F.when(below, F.col("n_tokens")))

    zero = F.lit(0).cast("long")
    return (
        sums.select("*", wanted).groupBy("limit")
        .agg(F.coalesce(last(F.col("docs_over")), F.max("total_docs")).alias("docs_over"), F.coalesce(last(F.col("tokens_within")), zero).alias("w"))
        .select("limit", "docs_over", (F.col("w") + F.col("docs_over") * F.col("limit")).alias("truncated_total"))
    )
