"""Hard negatives by anchor-clustered shared lists with certified termination.

A row's score for an anchor is the integer inner product of their vectors. The positives of an anchor are
its best rows of the same label; the hard negatives of a positive are the best rows of other labels whose
score lies between ``low`` and ``high`` percent of the positive's.

Anchors are put into clusters around centroids fitted to at most ``FIT_ROWS`` of them. For a cluster with centroid c
whose members lie within the angle r of it, no member's score for a row x can exceed

    |member| * |x| * cos(max(0, angle(x, c) - r)),

so each row has one upper bound per cluster. A cluster's rows form one list, sorted by that bound once,
which all its members walk together; a member stops at the first bound, times its own length, that is below
the score it still needs, which certifies that nothing further down can belong to its result. Two walks
are made: the first finds the positives; for the second, the positives tell what score a cluster's members
need at least, and rows whose bound is lower are not sent to the cluster at all.

At scale: anchors and rows are both spread. A list is cut into stripes of about ``STRIPE_NUMBERS`` numbers and a cluster
into parts of about ``PART`` anchors, both by row number, so hot vectors, labels or clusters are cut
too; a task holds one stripe and one part. At most ``CENTROIDS`` centroids are broadcast, with three numbers each.
Each (part, stripe) returns its best rows only, ranked again by a window that keeps the best before the shuffle.

Defined results: rows with a null id, label or vector, or with a null or non-finite component take no part,
nor do vectors whose squared length is 2**62 or more (their scores would leave 64 bits); empty and zero vectors score
0. Vectors are compared with those of their own number of components. Higher scores come first, ties by
smaller id. An anchor's "other" rows are those with another id. Repeated rows count one each; an anchor that is repeated with the
same label and vector is one anchor, one with another label or vector is an anchor of its own. A positive with a
negative score has no negatives. An empty table yields no rows; other columns are ignored and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from kestrel.llm.common import materialize

K_POSITIVES = K_NEGATIVES = 5
LOW, HIGH = 80, 100
FIT_ROWS, CENTROIDS, CLUSTER = 4096, 64, 256
PART, STRIPE_NUMBERS = 1024, 1 << 22
#: Added to angles and bounds, far above their rounding errors.
SLACK = 1e-6
_UNKNOWN = -1


def scaled(vec: Column, scale: int = 256) -> Column:
    """Components as floor(scale * x), in double precision; null if any is null or not finite."""
    whole = F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(F.coalesce(finite, F.lit(False)), whole)


def items(df: DataFrame, id_col: str, label: Column, vec: Column) -> DataFrame:
    """id, label, vec (whole numbers) and norm of the rows that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), vec.alias("vec"))
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = rows.filter("id is not null and label is not null").withColumn("norm", F.sqrt(square)).filter(F.col("norm") < 2.0**31)
    return rows.withColumn("vec", F.col("vec").cast("array<int>"))


def _matrix(column: pa.Array, dim: int, kind: type = np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), dim)


class Centroids:
    """Unit vectors by number of components; the first of a dimension has the number ``offset[dim]``."""

    def __init__(self, sample: pa.Table) -> None:
        self.units: dict[int, np.ndarray] = {}
        for batch in sample.combine_chunks().to_batches():
            for dim, at in _by_dim(batch):
                some = batch.take(pa.array(at))
                norm = some.column("norm").to_numpy()
                vecs = _matrix(some.column("vec"), dim, float)[norm > 0] / norm[norm > 0][:, None]
                if len(vecs) and len(self.units) < CENTROIDS:
                    self.units[dim] = _fit(vecs, max(1, min(CENTROIDS * len(vecs) // sample.num_rows, -(-len(vecs) // CLUSTER))))
        self.offset = dict(zip(self.units, np.cumsum([0, *[len(u) for u in self.units.values()]]).tolist()))

    def angles(self, vecs: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Angle of each row to each centroid of its dimension; a zero vector's is a right angle."""
        unit = vecs / np.where(norm > 0, norm, 1.0)[:, None]
        return np.arccos(np.clip(unit @ self.units[vecs.shape[1]].T, -1, 1))


def _fit(unit: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spaced rows."""
    centers = unit[np.linspace(0, len(unit) - 1, k).astype(int)]
    for _ in range(rounds):
        nearest = (unit @ centers.T).argmax(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, unit)
        length = np.sqrt((sums * sums).sum(1, keepdims=True))
        centers = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centers)
    return centers


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    dims = batch.column("vec").value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(dims).tolist():
        yield dim, np.flatnonzero(dims == dim)


def assign(anchors: DataFrame, centroids: Centroids) -> DataFrame:
    """``anchors`` with cluster and angle. Zero vectors and dimensions without a centroid form the cluster -1, of no angle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, angle = np.full(batch.num_rows, _UNKNOWN, np.int32), np.full(batch.num_rows, np.pi)
            for dim, at in _by_dim(batch):
                if dim in centroids.units:
                    part = batch.take(pa.array(at))
                    norm = part.column("norm").to_numpy()
                    angles = centroids.angles(_matrix(part.column("vec"), dim, float), norm)
                    best = angles.argmin(1)
                    good = norm > 0
                    cluster[at[good]] = centroids.offset[dim] + best[good]
                    angle[at[good]] = angles[np.arange(len(at)), best][good]
            yield batch.append_column("cluster", pa.array(cluster)).append_column("angle", pa.array(angle))

    added = [StructField("cluster", IntegerType()), StructField("angle", DoubleType())]
    return anchors.mapInArrow(run, StructType([*anchors.schema.fields, *added]))


def _lists(rows: DataFrame, centroids: Centroids, clusters: dict[int, tuple[float, int, float]], stripes: int) -> DataFrame:
    """id, label, vec, with cluster, part, stripe and bound: a row for each list the row may matter to.

    ``clusters``: widest angle, number of parts, and the least score per unit of member length that any member needs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at in _by_dim(batch):
                some = batch.take(pa.array(at))
                norm = some.column("norm").to_numpy()
                angles = centroids.angles(_matrix(some.column("vec"), dim, float), norm) if dim in centroids.units else None
                own = range(centroids.offset[dim], centroids.offset[dim] + angles.shape[1]) if angles is not None else ()
                for c, (widest, parts, least) in clusters.items():
                    if c != _UNKNOWN and c not in own:
                        continue
                    bound = norm * (1 if c == _UNKNOWN else np.cos(np.maximum(0, angles[:, c - own[0]] - widest - SLACK))) + SLACK * norm + SLACK
                    kept = np.flatnonzero(bound >= least)
                    if not len(kept):
                        continue
                    out = some.take(pa.array(kept))
                    stripe = out.column("rid").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
                    stripe = pa.array((stripe % np.uint64(stripes)).astype(np.int32))
                    for part in range(parts):
                        same = [pa.array(np.full(len(kept), x, np.int32)) for x in (dim, c, part)]
                        columns = [out.column("id"), out.column("label"), out.column("vec"), pa.array(bound[kept]), *same, stripe]
                        yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "vec", "bound", "dim", "cluster", "part", "stripe"])

    return rows.mapInArrow(run, "id long, label long, vec array<int>, bound double, dim int, cluster int, part int, stripe int")


class Walk:
    """Members walk one list; each keeps its best ``k`` rows that it may take."""

    def __init__(self, own_id: np.ndarray, own_label: np.ndarray, vecs: np.ndarray, norm: np.ndarray, floor: np.ndarray, cap: np.ndarray, same_label: bool, k: int) -> None:
        self.own_id, self.own_label, self.vecs, self.norm, self.same_label, self.k = own_id, own_label, vecs, norm, same_label, k
        self.floor, self.cap = floor, cap
        self.best = np.empty((0, 3), np.int64)  # member, score, id
        self.looked_at = 0

    def needs(self) -> np.ndarray:
        """The least score that could still enter each member's result."""
        needs = self.floor.copy()
        member, count = np.unique(self.best[:, 0], return_counts=True)
        full = member[count >= self.k]
        last = np.cumsum(count)[count >= self.k] - 1
        needs[full] = np.maximum(needs[full], self.best[last, 1])
        return needs

    def along(self, ids: np.ndarray, labels: np.ndarray, vecs: np.ndarray, bounds: np.ndarray, step: int = 1024) -> None:
        """``bounds`` fall; rows are looked at ``step`` at a time, by the members that have not stopped."""
        needs = self.needs()
        # Whole numbers below 2**53 are exact in doubles, whose products are much faster.
        largest = [float(np.abs(x).max(initial=0)) for x in (vecs, self.vecs)]
        exact = float if largest[0] * largest[1] * vecs.shape[1] < 2.0**53 else np.int64
        mine, rows = self.vecs.astype(exact), vecs.astype(exact)
        for i in range(0, len(ids), step):
            active = np.flatnonzero(bounds[i] * self.norm * (1 + SLACK) + SLACK >= needs)
            if not len(active):
                return
            self.looked_at += len(active) * len(ids[i : i + step])
            score = (mine[active] @ rows[i : i + step].T).astype(np.int64)
            fits = (score >= needs[active, None]) & (score <= self.cap[active, None]) & (self.own_id[active, None] != ids[None, i : i + step])
            fits &= (self.own_label[active, None] == labels[None, i : i + step]) == self.same_label
            m, c = np.nonzero(fits)
            if len(m):
                found = np.vstack([self.best, np.column_stack([active[m], score[m, c], ids[i + c]])])
                found = found[np.lexsort((found[:, 2], -found[:, 1], found[:, 0]))]
                member = found[:, 0]
                first = np.searchsorted(member, member, side="left")
                self.best = found[np.arange(len(found)) - first < self.k]
                needs = self.needs()


def _walk(members: DataFrame, lists: DataFrame, stripes: int, same_label: bool, k: int) -> DataFrame:
    """aid, slot, score, id: what each member takes from each stripe. Members: aid, slot, id, label, vec, norm, floor, cap, cluster, part, dim."""
    on = ["dim", "cluster", "part", "stripe"]
    every = members.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))

    def run(key: tuple, a: pa.Table, c: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        best, who = np.empty((0, 3), np.int64), np.empty(0, np.int64)
        if a.num_rows and c.num_rows:
            a, c = a.combine_chunks(), c.sort_by([("bound", "descending"), ("id", "ascending")]).combine_chunks()
            number = {n: a.column(n).to_numpy() for n in ("id", "label", "norm", "floor", "cap")}
            walk = Walk(number["id"], number["label"], _matrix(a.column("vec").combine_chunks(), dim), number["norm"], number["floor"], number["cap"], same_label, k)
            walk.along(c.column("id").to_numpy(), c.column("label").to_numpy(), _matrix(c.column("vec").combine_chunks(), dim), c.column("bound").to_numpy())
            best, who = walk.best, walk.best[:, 0]
        empty = np.empty(0, np.int64)
        aid, slot = (a.column(n).to_numpy()[who] if a.num_rows else empty for n in ("aid", "slot"))
        return pa.table({"aid": pa.array(aid, pa.int64()), "slot": pa.array(slot, pa.int32()), "score": pa.array(best[:, 1]), "id": pa.array(best[:, 2])})

    found = every.groupBy(*on).cogroup(lists.groupBy(*on)).applyInArrow(run, "aid long, slot int, score long, id long")
    rank = F.row_number().over(Window.partitionBy("aid", "slot").orderBy(F.col("score").desc(), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


_LEAST = -(2**62)
_MOST = 2**62


def mine(rows: DataFrame, is_anchor: Column, k_positives: int = K_POSITIVES, k_negatives: int = K_NEGATIVES, low: int = LOW, high: int = HIGH,
         part: int = PART, stripe_numbers: int = STRIPE_NUMBERS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``rows`` as ``items`` returns them."""
    rows = materialize(rows.withColumn("dim", F.size("vec")).withColumn("rid", F.monotonically_increasing_id()), "negatives-rows")
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("dim"), F.lit(0)).alias("numbers")).first()
    stripes = max(1, -(-size["numbers"] // stripe_numbers), -(-size["rows"] // stripe_numbers))

    anchors = rows.filter(is_anchor).groupBy("id", "label", "vec").agg(F.min("rid").alias("aid"), F.first("norm").alias("norm"), F.first("dim").alias("dim"))
    centroids = Centroids(anchors.orderBy(F.xxhash64("aid"), "aid").limit(FIT_ROWS).select("vec", "norm").toArrow())
    anchors = materialize(assign(anchors, centroids), "negatives-anchors")
    shape = {r["cluster"]: (r["angle"], max(1, -(-r["n"] // part))) for r in anchors.groupBy("cluster").agg(F.max("angle").alias("angle"), F.count(F.lit(1)).alias("n")).collect()}
    parts = F.create_map(*[F.lit(x) for c, (_, n) in shape.items() for x in (c, n)]) if shape else F.create_map(F.lit(_UNKNOWN), F.lit(1))
    members = anchors.withColumn("part", F.pmod(F.xxhash64("aid"), F.element_at(parts, F.col("cluster"))).cast("int"))

    first = members.select("*", F.lit(0).alias("slot"), F.lit(_LEAST).cast("long").alias("floor"), F.lit(_MOST).cast("long").alias("cap"))
    lists = _lists(rows, centroids, {c: (angle, n, -np.inf) for c, (angle, n) in shape.items()}, stripes)
    positives = _walk(first, lists, stripes, True, k_positives)
    positives = materialize(positives.select("aid", F.col("rank").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")

    # low * positive <= 100 * negative <= high * positive, in exact decimals.
    score = F.col("positive_score").cast("decimal(20,0)")
    floor, cap = F.ceil(score * F.lit(Decimal(low).scaleb(-2))), F.floor(score * F.lit(Decimal(high).scaleb(-2)))
    second = positives.withColumns({"floor": floor.cast("long"), "cap": cap.cast("long")}).filter("floor <= cap").join(members, "aid")
    second = materialize(second, "negatives-members")
    needs = F.min(F.when(F.col("norm") > 0, F.col("floor") / F.col("norm")).otherwise(F.lit(float("-inf"))))
    least = {r["cluster"]: r["least"] for r in second.groupBy("cluster").agg(needs.alias("least")).collect()}
    clusters = {c: (shape[c][0], shape[c][1], x - SLACK * (1 + abs(x))) for c, x in least.items()}
    negatives = _walk(second, _lists(rows, centroids, clusters, stripes), stripes, False, k_negatives)
    return negatives.join(second.select("aid", "slot", F.col("id").alias("anchor_id"), "positive_id", "positive_score"), ["aid", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


__all__ = ["scaled", "items", "mine", "Centroids", "Walk"]
