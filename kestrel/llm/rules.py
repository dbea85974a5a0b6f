"""Quality rules as a short-circuit cascade.

``figures`` are counts every document gets. ``RULES`` are tests that reject a document; a document is kept
if no rule rejects it. Which documents are kept does not depend on the order of the rules, the
cost does: a document leaves the cascade at the first rule that rejects it. So each rule's cost (time of a
Python call, on a fresh document) and what it rejects are taken from a sample of about ``SAMPLE_ROWS`` rows,
measured inside Spark tasks, and the rules are ordered by rejections per cost. The next rule is always the
one with the best ratio over the sampled documents that the earlier ones let pass. The sample decides
the order only.

``repeat_words`` looks for windows of 8 words found twice: windows are compared by hash first, and those
whose hash occurs twice word by word.

Defined results: a null text is empty, with zero in every figure; very long texts are read whole
(an Arrow batch, or one longer text, in a task: about 60 bytes a word); repeated rows are judged each; null
ids stay; an empty table yields no rows; other columns are ignored and may have any name.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import id_text
from kestrel.llm.words import Laid, covered, mix

SAMPLE_ROWS = 1000
WINDOW = 8
# Characters counted as symbols, ASCII white space, and what ends a sentence.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
ELLIPSES = (b"...", "…".encode())


class Document:
    """One text, with what several rules need computed once."""

    def __init__(self, text: bytes, figures: dict[str, int]) -> None:
        self.text, self.figures = text, figures

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in (x.strip() for x in self.text.split(b"\n")) if line]

    @cached_property
    def commonest(self) -> int:
        return max(Counter(self.words).values(), default=0)


_CAPITALS = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))
_MARKS = b"!?"


def _count(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


@dataclass(frozen=True)
class Rule:
    """``rejects`` tells whether a document fails."""

    name: str
    rejects: Callable[[Document], bool]


#: Thresholds are whole numbers, so that every engine draws the same line.
RULES: tuple[Rule, ...] = (
    Rule("symbols_over_words", lambda d: 10 * d.figures["n_symbols"] > d.figures["n_words"]),
    Rule("short_words", lambda d: 10 * d.figures["word_chars"] < 25 * d.figures["n_words"]),
    Rule("long_words", lambda d: d.figures["word_chars"] > 15 * d.figures["n_words"]),
    Rule("equal_lines", lambda d: 10 * d.figures["n_dup_lines"] > 3 * len(d.lines)),
    Rule("ellipsis_lines", lambda d: 10 * sum(line.endswith(ELLIPSES) for line in d.lines) > 3 * len(d.lines)),
    Rule("capitals", lambda d: _count(d.text, _CAPITALS) > _count(d.text, _SMALL)),
    Rule("exclamations", lambda d: 5 * _count(d.text, _MARKS) > len(d.words)),
    Rule("one_word", lambda d: 10 * d.commonest > 3 * len(d.words)),
)


def repeat_words(laid: Laid) -> np.ndarray:
    """For each text, the words that lie in a window of ``WINDOW`` words found twice or more in it."""
    none = np.zeros(len(laid.size), np.int64)
    if len(laid.code) < WINDOW:
        return none
    gram, span = laid.hashes(), 1
    while span < WINDOW:
        gram, span = mix(gram[:-span], gram[span:]), 2 * span
    starts = np.flatnonzero(covered(laid.first, laid.first + np.maximum(laid.size - WINDOW + 1, 0), len(laid.code)))
    text_of = laid.text_of(starts)
    key = mix(gram[starts], text_of.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    twice = key[order[1:]] == key[order[:-1]]
    some = np.zeros(len(starts), bool)
    some[order[1:][twice]] = some[order[:-1][twice]] = True
    starts, text_of = starts[some], text_of[some]
    if not len(starts):
        return none
    # The few that are left are compared word by word.
    rows = np.column_stack([text_of, *[laid.code[starts + i] for i in range(WINDOW)]])
    _, same, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    starts = starts[count[same.ravel()] > 1]
    inside = np.concatenate([[0], np.cumsum(covered(starts, starts + WINDOW, len(laid.code)))])
    return inside[laid.first + laid.size] - inside[laid.first]


def _equal_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def batch_figures(texts: list[bytes]) -> list[np.ndarray]:
    """The ``FIGURES`` of each text."""
    laid = Laid(texts)
    chars = [_count(t, bytes(range(128)) + bytes(range(0xC0, 0x100))) - _count(t, SPACES) for t in texts]
    symbols = [_count(t, SYMBOLS) for t in texts]
    return [laid.size, np.array(chars, np.int64), np.array(symbols, np.int64), np.array([_equal_lines(t) for t in texts], np.int64), repeat_words(laid)]


def _documents(batch: pa.RecordBatch) -> tuple[list[np.ndarray], list[Document]]:
    texts = batch.column(1).cast(pa.binary()).to_pylist()
    figures = batch_figures(texts)
    return figures, [Document(t, dict(zip(FIGURES, row))) for t, row in zip(texts, zip(*(f.tolist() for f in figures)))]


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> tuple[list[float], dict[int, int]]:
    """Seconds each rule takes over the sample, and how many sampled documents each set of rules (bits) rejects.

    About ``sample_rows`` rows, picked by a hash of their place in the table; only sums reach the driver.
    """
    numbered = docs.withColumn("_place", F.monotonically_increasing_id())
    share = max(1, docs.count() // sample_rows)
    sample = numbered.filter(F.pmod(F.xxhash64("_place"), F.lit(share)) == 0).drop("_place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, sets = [0.0] * len(rules), Counter()
        for batch in batches:
            for document in _documents(batch)[1] if batch.num_rows else ():
                bits = 0
                for i, rule in enumerate(rules):
                    fresh = Document(document.text, document.figures)
                    began = time.perf_counter()
                    bits |= bool(rule.rejects(fresh)) << i
                    seconds[i] += time.perf_counter() - began
                sets[bits] += 1
        rows = [(-1 - i, s) for i, s in enumerate(seconds)] + [(k, float(v)) for k, v in sets.items()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array([v for _, v in rows], pa.float64())], names=["what", "value"])

    sums = {r["what"]: r["value"] for r in sample.mapInArrow(run, "what long, value double").groupBy("what").agg(F.sum("value").alias("value")).collect()}
    return [sums.get(-1 - i, 0.0) for i in range(len(rules))], {k: int(v) for k, v in sums.items() if k >= 0}


def order_rules(seconds: list[float], sets: dict[int, int]) -> list[int]:
    """Rule numbers by rejections per cost among the sampled documents that the rules before let pass."""
    left, order = dict(sets), []
    while len(order) < len(seconds):
        rest = [i for i in range(len(seconds)) if i not in order]
        caught = {i: sum(n for bits, n in left.items() if bits >> i & 1) for i in rest}
        best = max(rest, key=lambda i: (caught[i] / (seconds[i] + 1e-9), -seconds[i], -i))
        order.append(best)
        left = {bits: n for bits, n in left.items() if not bits >> best & 1}
    return order


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the ``FIGURES``, passed, rules_tried (how many rules were run) and failed_rule (the one that rejected; of several, the first in the order chosen)."""
    rows = id_text(docs, id_col, text_col)
    ordered = [rules[i] for i in order_rules(*measure(rows, rules, sample_rows))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            figures, documents = _documents(batch)
            tried, failed = [], []
            for document in documents:
                at = next((i for i, rule in enumerate(ordered) if rule.rejects(document)), None)
                tried.append(len(ordered) if at is None else at + 1)
                failed.append(None if at is None else ordered[at].name)
            columns = [batch.column(0), *[pa.array(f, pa.int64()) for f in figures], pa.array([f is None for f in failed]), pa.array(tried, pa.int32()), pa.array(failed, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *FIGURES, "passed", "rules_tried", "failed_rule"])

    id_type = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, ", ".join([f"doc_id {id_type}", *[f"{f} long" for f in FIGURES], "passed boolean, rules_tried int, failed_rule string"]))


__all__ = ["RULES", "FIGURES", "Rule", "Document", "batch_figures", "measure", "order_rules", "judge"]
