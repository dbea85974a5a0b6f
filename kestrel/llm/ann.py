"""Nearest neighbours by cosine: block matrix join on int8 tiles with exact recomputation.

Queries and candidates are dealt into blocks; every pair of a query block and a candidate block is
one tile, a task's unit of work. In a tile the unit vectors are rounded to int8, each with a scale
of its own; one product of the two matrices gives all approximate cosines, and the rounding gives a
bound on each one's error. A pair survives unless its upper bound is below the k-th best lower bound
of its query. Survivors are computed anew in double precision from the original vectors, and a
heap keeps each query's best k of the tile; the tiles' heaps are merged in the end. No candidate that
belongs to the result can be lost, so the recall is 1.

Defined results: vectors that are null, empty, of zero length, or hold a null or non-finite number
take no part; so do null ids; vectors are compared with those of their own dimension; repeated rows
are candidates each, except rows with the query's own id; an id is asked once for each number of components, with the smallest
of its vectors, compared component by component, if its rows differ; ties go to the smaller id; an empty table yields no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import materialize

#: Rows of a tile on either side.
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 8192
K = 5


def usable(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(vec, lambda x: x != 0)


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id and vec (doubles) of the rows that take part."""
    vec = F.col(vec_col).cast("array<double>")
    return df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).filter(F.col("id").isNotNull() & usable(F.col("vec")))


def _int8(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rounded rows (whole numbers up to 127, as float32 so that products are exact), scales, and the exact lengths of the rounded rows and of what rounding left."""
    scale = np.abs(unit).max(1) / 127
    whole = np.rint(unit / scale[:, None])
    back = whole * scale[:, None]
    return whole.astype(np.float32), scale, np.sqrt((back * back).sum(1)), np.sqrt(((unit - back) ** 2).sum(1))


def cosine(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row by row, in double precision: q.c / (|q| |c|). Powers of two are taken out first: exact, and no square overflows."""
    q, c = (np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1]) if len(x) else x for x in (q, c))
    return (q * c).sum(1) / (np.sqrt((q * q).sum(1)) * np.sqrt((c * c).sum(1)))


def tile_nearest(q_id: np.ndarray, q: np.ndarray, c_id: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, candidate, cosine) of the k best of the tile for each query. Rows of ``q`` and ``c`` are finite and not zero."""
    # Divided by the largest number first, so that no square leaves the range of doubles.
    qu, cu = (x / np.abs(x).max(1)[:, None] for x in (q, c))
    qu, cu = (x / np.sqrt((x * x).sum(1))[:, None] for x in (qu, cu))
    qw, qs, ql, qr = _int8(qu)
    cw, cs, cl, cr = _int8(cu)
    # Whole numbers below 2**24 are exact in float32; wide vectors are summed in slices of 512.
    product = sum((qw[:, i : i + 512] @ cw[:, i : i + 512].T).astype(np.float64) for i in range(0, q.shape[1], 512))
    near = product * qs[:, None] * cs[None, :]
    # |a.b - a'.b'| <= |a'| |b - b'| + |a - a'| (|b'| + |b - b'|), and a little for rounding.
    slack = ql[:, None] * cr[None, :] + qr[:, None] * (cl + cr)[None, :] + 1e-9
    low, high = near - slack, near + slack
    own = q_id[:, None] == c_id[None, :]
    low[own], high[own] = -np.inf, -np.inf
    at_least = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] >= k else np.full(len(q), -np.inf)
    rows, cols = np.nonzero((high >= at_least[:, None]) & ~own)
    out: list[tuple[int, int, float]] = []
    score = cosine(q[rows], c[cols])
    for i, (a, b) in enumerate(zip(*_runs(rows))):
        best = heapq.nsmallest(k, zip((-score[a:b]).tolist(), c_id[cols[a:b]].tolist()))
        out += [(int(q_id[rows[a]]), int(v), -s) for s, v in best]
    return out


def _runs(sorted_: np.ndarray) -> tuple[list[int], list[int]]:
    if not len(sorted_):
        return [], []
    cuts = (np.flatnonzero(np.diff(sorted_)) + 1).tolist()
    return [0, *cuts], [*cuts, len(sorted_)]


def nearest(queries: DataFrame, candidates: DataFrame, k: int = K, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score; both inputs have id and vec, as ``vectors`` returns them."""
    candidates = materialize(candidates.withColumn("dim", F.size("vec")), "ann-candidates")
    queries = materialize(queries.groupBy("id", F.size("vec").alias("dim")).agg(F.min("vec").alias("vec")), "ann-queries")
    q_blocks = max(1, -(-queries.count() // query_block))
    c_blocks = max(1, -(-candidates.count() // candidate_block))

    def laid(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        block = F.pmod(F.xxhash64("id", "vec"), F.lit(n)).cast("int").alias(own)
        return df.select("id", "vec", "dim", block, F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))

    at = ["dim", "qb", "cb"]
    left = laid(queries, "qb", q_blocks, "cb", c_blocks).groupBy(*at)
    right = laid(candidates, "cb", c_blocks, "qb", q_blocks).groupBy(*at)

    def tile(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, float]] = []
        # A block is the size aimed at on average; one that copies of a row overfill is taken in slices.
        for i in range(0, len(q), query_block):
            for j in range(0, len(c), candidate_block):
                qs, cs = q.iloc[i : i + query_block], c.iloc[j : j + candidate_block]
                found += tile_nearest(qs["id"].to_numpy(), np.stack(qs["vec"].to_list()), cs["id"].to_numpy(), np.stack(cs["vec"].to_list()), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    heaps = left.cogroup(right).applyInPandas(tile, "query_id long, vec_id long, score double")
    # One id with vectors of two dimensions: the nearest of both.
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))), 1, k)
    merged = heaps.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best"))
    return merged.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "col.vec_id", (-F.col("col.far")).alias("score"))


__all__ = ["usable", "vectors", "cosine", "tile_nearest", "nearest"]
