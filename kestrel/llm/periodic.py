"""Runs: stretches of a text that repeat a root of ``period`` words at least three times.

A run is a stretch of at least max(``MIN_LENGTH``, ``MIN_TIMES`` * period) words whose smallest period
is ``period`` and which no neighbouring word extends. All runs of every text are found:

* Periods up to ``MIN_LENGTH // MIN_TIMES`` are too short for the windows below and are found by direct
  lag scans: words are compared with the words ``period`` places on.
* Longer periods are taken in scales [low, high] with high about 1.25 * low. A scale looks at grams of
  ``high`` words and keeps the minima of their hashes over windows of 2 * low - high + 1 grams. Windows
  that lie a period apart inside a run hold the same words, so the minima repeat at that distance;
  a gram as long as the root cannot occur in between. So every run of the scale gives a pair of
  neighbouring equal minima exactly one period apart. Each such pair is a seed, which is extended
  to both sides by comparing the words themselves.

Hashes say only where to look; what is reported has been compared word by word. (A run could be missed
only if two different grams of a text had one 64-bit hash.)

The texts of an Arrow batch are laid one after the other, longest first, so that a scale touches only
the texts that can hold its periods. A task holds one batch (4 MB of text at most, or one longer text):
about 60 bytes a word. The work is O(n log n) for each of about 3 * log2(n) scales.

Defined results: a null text holds no words; texts shorter than ``MIN_LENGTH`` words have no runs; very
long texts are searched whole; repeated rows are answered each; null ids stay; an empty table yields no
rows; other columns are ignored and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import id_text
from kestrel.llm.words import Laid, covered, mix

MIN_LENGTH, MIN_TIMES = 24, 3
Run = tuple[int, int, int]


def _slide(best: np.ufunc, a: np.ndarray, width: int) -> np.ndarray:
    """The best of every ``width`` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        a = best(a[:-span], a[span:])
        span *= 2
    return best(a[: len(a) - (width - span)], a[width - span :]) if span < width else a


def _minima(gram: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the minimum of some window of ``width`` grams, all ties included."""
    least = _slide(np.minimum, gram, width)
    edge = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(_slide(np.maximum, np.concatenate([edge, least, edge]), width) == gram)


def _matching(code: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The widest [a, b) around ``at`` in which every word equals the one ``period`` places on."""
    b, step = at, 64
    while True:
        there = code[b + period : b + period + step]
        differs = code[b : b + len(there)] != there
        if differs.any() or not len(there):
            b += int(differs.argmax()) if len(there) else 0
            break
        b, step = b + len(there), 2 * step
    a, step = at, 64
    while a > 0:
        low = max(0, a - step)
        differs = (code[low:a] != code[low + period : a + period])[::-1]
        if differs.any():
            a -= int(differs.argmax())
            break
        a, step = low, 2 * step
    return a, b


def _is_smallest(code: np.ndarray, start: int, period: int) -> bool:
    """Whether no proper divisor of ``period`` is a period too. (A smaller period of so long a run divides it.)"""
    root = code[start : start + period]
    left, factor = period, 2
    while left > 1:
        if factor * factor > left:
            factor = left
        if left % factor == 0:
            shorter = period // factor
            if np.array_equal(root, code[start + shorter : start + shorter + period]):
                return False
            while left % factor == 0:
                left //= factor
        factor += 1
    return True


def _short_periods(code: np.ndarray, longest: int) -> Iterator[Run]:
    for period in range(1, longest + 1):
        same = np.concatenate([[False], code[:-period] == code[period:], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        starts, ends = turns[::2], turns[1::2] + period
        for i in np.flatnonzero(ends - starts >= max(MIN_LENGTH, MIN_TIMES * period)):
            if _is_smallest(code, int(starts[i]), period):
                yield int(starts[i]), int(ends[i]), period


def _seeds(gram: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring equal minima ``low`` to ``high`` apart: positions and distances, by distance, then position."""
    at = _minima(gram, 2 * low - high + 1)
    order = np.argsort(gram[at], kind="stable")
    at, value = at[order], gram[at][order]
    distance = np.diff(at)
    found = np.flatnonzero((value[1:] == value[:-1]) & (distance >= low) & (distance <= high))
    at, distance = at[found], distance[found]
    order = np.lexsort((at, distance))
    return at[order], distance[order]


def _long_periods(laid: Laid, low: int) -> Iterator[Run]:
    """``laid`` holds the longest texts first."""
    code, whole, span = laid.code, laid.hashes(), 1
    while True:
        able = int(np.searchsorted(-laid.size, -max(MIN_LENGTH, MIN_TIMES * low), side="right"))
        if able == 0:
            return
        end = int(laid.first[able - 1] + laid.size[able - 1]) + 1
        high = low + low // 4
        whole = whole[:end]
        while 2 * span <= high:
            whole = mix(whole[:-span], whole[span:])
            span *= 2
        gram = mix(whole[: len(whole) - (high - span)], whole[high - span :]) if span < high else whole
        if len(gram) >= 2 * low - high + 1:
            last, until = 0, 0
            for at, period in zip(*(x.tolist() for x in _seeds(gram, low, high))):
                if period == last and at < until:
                    continue
                start, stop = _matching(code, at, period)
                last, until = period, stop
                if stop + period - start >= max(MIN_LENGTH, MIN_TIMES * period) and _is_smallest(code, start, period):
                    yield start, stop + period, period
        low = high + 1


def find_runs(texts: list[bytes]) -> tuple[Laid, np.ndarray]:
    """The texts laid longest first, and rows (start, end, period) in positions of ``Laid.code``."""
    laid = Laid(texts, longest_first=True)
    longest_short = MIN_LENGTH // MIN_TIMES
    runs = [*_short_periods(laid.code, longest_short), *_long_periods(laid, longest_short + 1)]
    return laid, np.array(sorted(runs), np.int64).reshape(-1, 3)


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _answer(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column(1).cast(pa.binary()).to_pylist()
    laid, found = find_runs(texts)
    start, end, period = found.T
    dropped = covered(start + period, end, len(laid.code))
    text_of = laid.text_of(start) if len(found) else start
    bounds = np.searchsorted(text_of, np.arange(len(texts) + 1))
    runs, collapsed, n_words = ([None] * len(texts) for _ in range(3))
    for i, place in enumerate(laid.place.tolist()):
        first, n, own = int(laid.first[i]), int(laid.size[i]), slice(bounds[i], bounds[i + 1])
        words = texts[place].split()
        if own.start < own.stop:
            words = compress(words, ~dropped[first : first + n])
        runs[place] = [{"start": s, "length": m, "period": p} for s, m, p in zip((start[own] - first).tolist(), (end[own] - start[own]).tolist(), period[own].tolist())]
        collapsed[place], n_words[place] = b" ".join(words), n
    columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(runs, RUNS), pa.array(collapsed, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (structs start, length, period in words, by start, then period), and collapsed: the words that no run repeats, joined by one space."""
    rows = id_text(docs, id_col, text_col)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _answer(batch)

    id_type = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(answer, f"doc_id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; the first of equal ones; null if there is none."""

    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)


__all__ = ["find_runs", "periodic_runs", "strongest"]
