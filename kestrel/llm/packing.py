"""Packing token sequences into fixed windows by Karmarkar-Karp multiway differencing.

``token_pieces`` encodes documents and cuts them at most ``capacity`` ids long. ``pack`` places
pieces: one that fills a window alone takes it; all others are dealt by a hash into sorted
partitions and, ``group`` pieces at a time, differenced into near-equal windows. The window
count of a group starts at the least that could hold it and rises whenever a window exceeds
the capacity. A task holds one group of lengths, never the ids of other pieces.

Defined results: a null text is empty; an empty text yields one piece that holds only the end
id; a null id stays null; repeated rows each get their own pieces; an empty table yields no
rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import BATCH_ROWS, id_text
from kestrel.llm.encoders import WordEncoder, encoder

CAPACITY = 4096
END_ID = 2
#: Pieces differenced together.
GROUP = 1024
#: Longest piece that shares a window. Shorter pieces balance better; a document is still cut
#: only where it exceeds this, into as few near-equal parts as that allows.
SHARED = 1024


def difference(lengths: np.ndarray, k: int) -> np.ndarray:
    """The window (0..k-1) of each length, by multiway differencing.

    Every length starts as a partition of its own with k sums, all but one zero. The two
    partitions of widest spread are merged, largest sums against smallest, until one is left.
    """
    n = len(lengths)
    if k <= 1 or n == 0:
        return np.zeros(n, np.int64)
    sums: list = []
    for x in lengths:
        s = np.zeros(k, np.int64)
        s[0] = x
        sums.append(s)
    merged: list = [None] * n
    heap = [(-int(x), i) for i, x in enumerate(lengths)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        total = sums[a] + sums[b][::-1]  # both fall, so opposite ends meet
        order = np.argsort(-total, kind="stable")
        total = total[order]
        total -= total[-1]  # only differences matter from here on
        sums[a] = sums[b] = None
        sums.append(total)
        merged.append((a, b, order))
        heapq.heappush(heap, (-int(total[0]), len(sums) - 1))
    window = np.zeros(n, np.int64)
    todo = [(heap[0][1], np.arange(k))]
    while todo:
        node, at = todo.pop()  # at: the final window of each of the node's sums
        if merged[node] is None:
            window[node] = at[0]
            continue
        a, b, order = merged[node]
        before = np.empty(k, np.int64)
        before[order] = at
        todo += [(a, before), (b, before[::-1])]
    return window


def windows(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """The window of each length and the number of windows; no window exceeds ``capacity``."""
    k = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        window = difference(lengths, k)
        if np.bincount(window, weights=lengths, minlength=k).max() <= capacity:
            return window, k
        k += 1


def cuts(n: int, capacity: int = CAPACITY, shared: int = SHARED) -> list[int]:
    """Where a document of ``n`` ids is cut: whole windows first, then near-equal parts of at most ``shared``."""
    full = n // capacity * capacity
    rest = n - full
    parts = -(-rest // shared)
    return [*range(0, full, capacity), *(full + rest * i // parts for i in range(parts)), n]


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, shared: int = SHARED, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens."""
    end = int(end_id).to_bytes(4, "little")
    id_type = dict(docs.select("doc_id").dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(WordEncoder, path)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            ids_col = batch.column(0)
            take = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = enc.encode(text) + end
                n = len(ids) // 4
                at = cuts(n, capacity, shared)
                for a, b in zip(at, at[1:]):
                    take.append(i)
                    for col, value in zip(rows, (None, a, b - a, ids[4 * a : 4 * b], n)):
                        col.append(value)
            yield pa.RecordBatch.from_arrays(
                [ids_col.take(pa.array(take, pa.int64())), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64()),
                 pa.array(rows[3], pa.binary()), pa.array(rows[4], pa.int64())],
                names=["doc_id", "start", "length", "ids", "doc_tokens"],
            )
        enc.forget()
        pa.default_memory_pool().release_unused()

    return id_text(docs).mapInArrow(run, f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long")


def pack(pieces: DataFrame, key: list[str], capacity: int = CAPACITY, group: int = GROUP, length: str = "length") -> DataFrame:
    """``pieces`` with sequence_id and offset. ``key`` orders the pieces, so that a repeated task packs alike.

    Partition p numbers its sequences p * 2**33 + 1, 2, ...; offsets in a sequence are gapless from 0.
    """
    names = pieces.columns
    at = names.index(length)
    if bad := {"sequence_id", "offset"} & {c.lower() for c in names}:
        raise ValueError(f"pieces already has {sorted(bad)}")

    def place(rows: pa.Table, first: int) -> tuple[pa.Table, int]:
        lengths = rows.column(at).to_numpy().astype(np.int64)
        alone = lengths >= capacity
        window = np.zeros(len(lengths), np.int64)
        window[alone] = np.arange(alone.sum())
        used = int(alone.sum())
        if not alone.all():
            own, k = windows(lengths[~alone], capacity)
            window[~alone] = own + used
            used += k
        order = np.argsort(window, kind="stable")
        run = np.cumsum(lengths[order]) - lengths[order]
        starts = np.flatnonzero(np.r_[True, np.diff(window[order]) != 0])
        offset = np.empty(len(lengths), np.int64)
        offset[order] = run - np.repeat(run[starts], np.diff(np.r_[starts, len(lengths)]))
        rows = rows.append_column("sequence_id", pa.array(first + window)).append_column("offset", pa.array(offset))
        return rows, first + used

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() * 2**33 + 1
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= group:
                table = pa.Table.from_batches(held)
                done, first = place(table.slice(0, group), first)
                yield from done.to_batches()
                held = table.slice(group).to_batches()
                n -= group
        if n:
            done, first = place(pa.Table.from_batches(held), first)
            yield from done.to_batches()

    dealt = pieces.repartition(F.xxhash64(*key)).sortWithinPartitions(*key)
    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    return dealt.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def assemble(packed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, length, ids (one binary); a sequence is bounded by the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("p"))
    return joined.select(
        "sequence_id",
        F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("length"),
        F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
    )


__all__ = ["difference", "windows", "cuts", "token_pieces", "pack", "assemble", "CAPACITY", "GROUP", "SHARED", "END_ID", "BATCH_ROWS"]
