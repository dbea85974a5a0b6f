"""SimHash near-duplicates by tiled exact comparison.

Fingerprints link when at most ``radius`` of their 64 bits differ. Equal fingerprints are one row
from the start. The 64 bits are cut into four words of 16; two fingerprints within the radius have
population counts that differ, summed over the words, by at most the radius. So fingerprints are
laid out in cells by their four counts, cells in tiles of at most ``TILE`` rows, and only tiles of
cells whose counts are near enough are compared: all against all, with numpy exclusive-or and bit
counts. No other pair can link, so the comparison is exact.

A task holds one tile and streams the fingerprints that come to it from nearby cells. It joins
what it links on the spot and hands on one row per linked fingerprint, never the pairs. Classes
are then closed over all tiles by large-star and small-star rounds, each written to the shared folder.

Defined results: a null text is empty; a text without words has fingerprint zero and links like
any other; a text of fewer words than a shingle is one shingle; repeated rows are in one class; an
empty table yields no rows; of null ids, only if there is no other, null is the class's id; other
columns may have any name.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import id_text, materialize, text_or_empty

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Words the 64 bits are cut into for their population counts.
PARTS = 4
#: Fingerprints of one cell that a task holds at once.
TILE = 4096
#: A round is written in a file for each so many links, or in ``ROUND_FILES`` if that is more; never in more than a shuffle has tasks.
FILE_LINKS, ROUND_FILES = 100_000, 12

_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle of ``size`` words, repeats included; A-Z count as a-z."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    n = max(1, len(words) - size + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = [len(joined)] if len(words) <= size else ends[size - 1 :].tolist()
    return np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[:n], last)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes. Eight bits at a time are counted in byte lanes."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    at = np.arange(0, n, 255)  # a lane holds at most 255
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, at)
        counts[bit::8] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist()))


def fingerprints(docs: DataFrame, carry: list[str], size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """The columns in ``carry`` and fp: the fingerprint as a signed 64-bit number, last."""
    from pyspark.sql import types as T

    df = docs.select(*[F.col(f"`{c}`") for c in carry], text_or_empty().alias("simhash_text"))
    out = T.StructType([*df.schema.fields[:-1], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(shingle_hashes(t, size, seed)) for t in batch.column(len(carry)).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(fps.view(np.int64))], names=[*carry, "fp"])

    return df.mapInArrow(run, out)


def _cell(fp: Column) -> list[Column]:
    """Population counts of the four 16-bit words."""
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("int") for i in range(PARTS)]


def _nearby(radius: int) -> list[tuple[int, ...]]:
    """Steps to the cell itself and to one of every two opposite cells within the radius."""
    steps = (s for s in itertools.product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, s)) <= radius)
    return [s for s in steps if s >= (0,) * PARTS]


class _Joined:
    """Rows of a tile, joined into classes as matches come in; a row is named by its place."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        r = self.root[x]
        while True:
            up = self.root[r]
            if np.array_equal(up, r):
                return r
            r = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.find(a), self.find(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))


def tile_links(home: np.ndarray, visitors: Iterator[np.ndarray], radius: int = RADIUS, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Links (fp, other fp) that join all of ``home`` and the visitors that are within the radius of each other.

    Visitors are compared with ``home`` only. At most one link for every home row and two for every visitor.
    """
    same = _Joined(len(home))
    for i in range(0, len(home), block):
        for j in range(i, len(home), block):
            a, b = np.nonzero(np.bitwise_count(home[i : i + block, None] ^ home[None, j : j + block]) <= radius)
            same.join(a + i, b + j)
    left, right = [], []
    for visit in visitors:
        for i in range(0, len(visit), block):
            v = visit[i : i + block]
            first = np.full(len(v), -1)
            for j in range(0, len(home), block):
                a, b = np.nonzero(np.bitwise_count(v[:, None] ^ home[None, j : j + block]) <= radius)
                if len(a):
                    b = b + j
                    new = np.unique(a, return_index=True)
                    fresh = first[new[0]] < 0
                    first[new[0][fresh]] = b[new[1][fresh]]
                    same.join(first[a], b)
            hit = first >= 0
            left.append(v[hit])
            right.append(home[first[hit]])
    root = same.find(np.arange(len(home)))
    moved = root != np.arange(len(home))
    return np.concatenate([home[moved], *left]), np.concatenate([home[root[moved]], *right])


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to join all that are within the radius. ``fps`` has one row per fingerprint."""
    counts = _cell(F.col("fp"))
    cell = F.lit(0).cast("long")
    for c in counts:
        cell = cell * F.lit(32) + c
    laid = fps.select("fp", cell.alias("cell"))
    # At most 17**4 = 83,521 cells, so their sizes may be broadcast.
    tiles = laid.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    tiles = materialize(tiles, "simhash-cells")
    own = laid.join(F.broadcast(tiles), "cell").select("fp", "cell", F.pmod(F.xxhash64("fp"), "tiles").cast("int").alias("tile"))
    steps = [sum(x * 32 ** (PARTS - 1 - i) for i, x in enumerate(s)) for s in _nearby(radius)]
    sent = own.select("fp", "cell", "tile", F.explode(F.array(*[F.lit(s).cast("long") for s in steps])).alias("step"))
    near = F.broadcast(tiles.select(F.col("cell").alias("to_cell"), F.col("tiles").alias("to_tiles")))
    sent = sent.withColumn("to_cell", F.col("cell") + F.col("step")).join(near, "to_cell")
    sent = sent.withColumn("to_tile", F.explode(F.sequence(F.lit(0), F.col("to_tiles") - 1)))
    # Within a cell a tile visits the later tiles only.
    sent = sent.filter((F.col("step") != 0) | (F.col("to_tile") >= F.col("tile")))
    home = (F.col("step") == 0) & (F.col("to_tile") == F.col("tile"))
    # A cell's number and a tile's make one key; a home row sorts before all visitors.
    rows = sent.select((F.col("to_cell") * F.lit(1 << 32) + F.col("to_tile")).alias("at"), (~home).alias("visits"), "fp")
    rows = rows.repartition("at").sortWithinPartitions("at", "visits", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple[int, bool, np.ndarray]]:
            for batch in batches:
                at, visits = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
                fp = batch.column(2).to_numpy().view(np.uint64)
                cuts = np.flatnonzero((np.diff(at) != 0) | (np.diff(visits.astype(np.int8)) != 0)) + 1
                for a, b in itertools.pairwise([0, *cuts.tolist(), len(at)]):
                    if b > a:
                        yield int(at[a]), bool(visits[a]), fp[a:b]

        for _, group in itertools.groupby(parts(), key=lambda p: p[0]):
            own: list[np.ndarray] = []
            first: list[np.ndarray] = []
            for _, visits, fp in group:
                if visits:
                    first.append(fp)
                    break
                own.append(fp)
            rest = itertools.chain(first, (fp for _, _, fp in group))
            a, b = tile_links(np.concatenate(own) if own else np.empty(0, np.uint64), rest, radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node and root (the smallest node of its class) of every node that has a link.

    Large-star and small-star rounds (Kiveris et al., 2014): each node's larger neighbours, then its
    smaller ones, are hung on the smallest, until nothing moves. A round is written to the shared
    folder, in as many files as its links need (each local file costs the executor a process besides); a hub
    of many links is summed up before it is shuffled, and joined as a plain table.
    """

    def written(df: DataFrame, n: int, name: str) -> DataFrame:
        return materialize(df.coalesce(max(ROUND_FILES, -(-n // FILE_LINKS))), name)

    def star(links_: DataFrame, n: int, large: bool) -> DataFrame:
        both = links_.unionByName(links_.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links_
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        least = written(least, n, f"{name}-least")
        hung = both.join(least, "a")
        if large:
            return hung.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        up = hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.select("a", F.col("m").alias("b"))
        return up.unionByName(own).filter("a != b").distinct()

    # Every link points from the larger to the smaller node.
    down = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialize(down, name)
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("s")).first()
        if mark == before or mark["n"] == 0:
            break
        before = mark
        n = mark["n"]
        now = written(star(written(star(now, n, True), n, name), n, False), n, name)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def classes(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fp, class_id (smallest doc_id of its class), size (rows) and keep (the row that stays: doc_id and, if there, rid).

    ``rows`` has doc_id and fp, and may have rid.
    """
    order = ["doc_id", "rid"] if "rid" in rows.columns else ["doc_id"]
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), *order)
    distinct = materialize(rows.groupBy("fp").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    roots = materialize(components(links(distinct.select("fp"), radius), "simhash-links"), "simhash-roots")
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first", "n")
    rooted = materialize(rooted, "simhash-rooted")
    tops = materialize(rooted.groupBy("root").agg(F.min("first").alias("keep"), F.sum("n").alias("size")), "simhash-tops")
    return rooted.select("fp", "root").join(tops, "root").select("fp", F.col("keep.doc_id").alias("class_id"), "size", "keep")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, seed: int = SEED, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable over links) of every row."""
    rows = materialize(fingerprints(id_text(docs), ["doc_id"], size, seed), "simhash-rows")
    found = materialize(classes(rows, radius), "simhash-classes")
    return rows.join(found, "fp").select("doc_id", "fp", F.col("class_id").alias("component_id"))


def keep_one(docs: DataFrame, size: int = SHINGLE, seed: int = SEED, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of every class: that of the smallest doc_id."""
    columns = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col("doc_id"), F.col("text"), F.monotonically_increasing_id().alias("rid"))
    rows = materialize(fingerprints(packed, ["rid", "doc_id", "doc"], size, seed), "simhash-rows")
    found = classes(rows.select("rid", "doc_id", "fp"), radius).filter("size > 1")
    found = materialize(found.select("fp", F.col("keep.rid").alias("keep_rid")), "simhash-classes")
    dropped = rows.select("rid", "fp").join(found, "fp").filter("rid != keep_rid").select("rid")
    dropped = materialize(dropped, "simhash-dropped")
    return rows.join(dropped, "rid", "left_anti").select(*[F.col(f"doc.`{c}`").alias(c) for c in columns])


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
