"""Text quality by a generalised additive model with pairwise interactions.

Each text is turned into a few counts and shares. Boosting goes round the features again and
again; each step fits one shallow tree to one feature's bins, and its leaves are added to that
feature's lookup table. Then the strongest pairs of features get tables of their own, from trees
with one cut on each axis. A score is the logistic of an intercept plus one looked-up number per
feature and pair.

The model is fitted on the driver from at most ``SAMPLE`` labelled rows (those whose ids hash
lowest); it is a few kilobytes. Everything else runs over all rows.

Defined results: a null text is empty; an empty text is scored like any other; labels that are
null or belong to no document are left out, repeated ones each count; without labels the score
is 0.5; an empty table yields no rows; other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import id_bucket, id_text, materialize, text_or_empty

#: Most labelled rows that a model is fitted on.
SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 32, 12, 6
ROUNDS, RATE = 200, 0.1
THRESHOLD = 0.7

FEATURES = (
    "log_bytes", "log_words", "upper", "digit", "stop_comma", "shout", "bar", "symbol", "other_mark", "newline", "beyond_ascii",
    "word_bytes", "distinct_words", "longest_word", "distinct_lines",
)


def _byte_classes() -> np.ndarray:
    table = np.full(256, 10, np.uint8)
    for code, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,", b"!?", b"|", b"#$%&*<>{}[]=_~^\\/@", b"\n", b" \t\r\x0b\x0c")):
        table[list(chars)] = code
    table[128:] = 9
    return table


_CLASSES = _byte_classes()


def text_features(text: str) -> list[float]:
    """The numbers a text is judged by, in the order of ``FEATURES``."""
    raw = text.encode()
    n = max(1, len(raw))
    c = np.bincount(_CLASSES[np.frombuffer(raw, np.uint8)], minlength=11)
    words = raw.split()
    count = max(1, len(words))
    lines = raw.split(b"\n")
    letters = max(1, int(c[0] + c[1] + c[9]))
    return [
        math.log1p(len(raw)), math.log1p(len(words)), c[1] / letters, c[2] / n, c[3] / count, c[4] / count, c[5] / count, c[6] / count,
        c[10] / count, c[7] / n, c[9] / n, sum(map(len, words)) / count, len(set(words)) / count,
        math.log1p(max(map(len, words), default=0)), len(set(lines)) / len(lines),
    ]


def features(docs: DataFrame) -> DataFrame:
    """doc_id and features (array of doubles) of every row."""
    id_type = dict(docs.select("doc_id").dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "features"])

    return id_text(docs).mapInArrow(run, f"doc_id {id_type}, features array<double>")


@dataclass
class Model:
    """Cut points and lookup tables; ``scores`` adds up one entry of each table."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (edge, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edge, x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.pair_edges[a], x[:, a], side="right"), np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(col: np.ndarray, bins: int) -> np.ndarray:
    """Cut points between equal shares of the values, halfway between neighbours so that none lies on a cut."""
    values = np.unique(col)
    if len(values) < 2:
        return np.empty(0)
    cuts = np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1])
    at = np.unique(np.clip(np.searchsorted(values, cuts, side="right"), 1, len(values) - 1))
    return (values[at - 1] + values[at]) / 2


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _leaf(g: float, h: float) -> float:
    return g / (h + 1.0)


def _split(g: np.ndarray, h: np.ndarray) -> int:
    """Where to cut a run of bins for the largest gain; 0 if there is nowhere to cut."""
    if len(g) < 2:
        return 0
    cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(cg, ch) + _gain(g.sum() - cg, h.sum() - ch)
    return int(np.argmax(gain)) + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value of every bin, from a tree of at most ``depth`` levels."""
    at = _split(g, h) if depth else 0
    if not at:
        return np.full(len(g), _leaf(g.sum(), h.sum()))
    return np.r_[_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)]


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf table of the best tree with one cut on each axis of a grid."""
    best, table = 0.0, np.zeros_like(g)
    cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    if min(g.shape) < 2:
        return best, table
    a, b = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")

    def quarters(c: np.ndarray) -> list[np.ndarray]:
        ll = c[a, b]
        lr, rl = c[a, -1] - ll, c[-1, b] - ll
        return [ll, lr, rl, c[-1, -1] - ll - lr - rl]

    qg, qh = quarters(cg), quarters(ch)
    gain = sum(_gain(x, y) for x, y in zip(qg, qh)) - _gain(cg[-1, -1], ch[-1, -1])
    i, j = np.unravel_index(np.argmax(gain), gain.shape)
    leaf = [float(_leaf(x[i, j], y[i, j])) for x, y in zip(qg, qh)]
    table[: i + 1, : j + 1], table[: i + 1, j + 1 :], table[i + 1 :, : j + 1], table[i + 1 :, j + 1 :] = leaf
    return float(gain[i, j]), table


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, pairs: int = PAIRS) -> Model:
    """Cyclic boosting of the logistic loss."""
    k = x.shape[1]
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = math.log(share / (1 - share))
    edges = [_edges(x[:, j], BINS) if len(y) else np.empty(0) for j in range(k)]
    pair_edges = [_edges(x[:, j], PAIR_BINS) if len(y) else np.empty(0) for j in range(k)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = Model(start, edges, tables, [], pair_edges, [])
    if not len(y) or y.min() == y.max():
        return model
    binned = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    margin = np.full(len(y), start)

    def step() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(k):
            if len(edges[j]):
                g, h = (np.bincount(binned[j], weights=w, minlength=len(tables[j])) for w in step())
                add = rate * _tree(g, h)
                tables[j] += add
                margin += add[binned[j]]

    grid = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(pair_edges)]

    def sums(a: int, b: int, weights: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        shape = (len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)
        at = grid[a] * shape[1] + grid[b]
        return [np.bincount(at, weights=w, minlength=shape[0] * shape[1]).reshape(shape) for w in weights]

    now = step()
    gains = sorted(((-_cross(*sums(a, b, now))[0], a, b) for a in range(k) for b in range(a)), key=lambda t: t)
    model.pairs += [(a, b) for gain, a, b in gains[:pairs] if gain < 0]
    model.pair_tables += [np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)) for a, b in model.pairs]
    for _ in range(rounds // 4):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            add = rate * _cross(*sums(a, b, step()))[1]
            table += add
            margin += add[grid[a], grid[b]]
    return model


def learn(feats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the features and ``labels.quality``; the rows of bucket 2 of 4 are held out."""
    known = labels.filter((id_bucket(4) != 2) & F.col("quality").isNotNull()).select("doc_id", F.col("quality").cast("double").alias("y"))
    rows = feats.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample).select("features", "y").toArrow()
    x = np.array(rows.column("features").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, rows.column("y").to_numpy())


def score(feats: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted."""
    id_type = dict(feats.select("doc_id").dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            s = model.scores(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return feats.select("doc_id", "features").mapInArrow(run, f"doc_id {id_type}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every row, by a model learnt from ``labels``."""
    feats = materialize(features(docs), "quality-features")
    return score(feats, learn(feats, labels), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score below the threshold."""
    known = labels.filter(F.col("quality").isNotNull()).select("doc_id").distinct()
    model = learn(features(docs).join(known, "doc_id", "left_semi"), labels)
    columns = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), text_or_empty().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([text_features(t) for t in batch.column(1).to_pylist()]).reshape(-1, len(FEATURES))
            yield batch.select([0]).filter(pa.array(model.scores(x) >= threshold))

    kept = packed.mapInArrow(run, packed.select("doc").schema)
    return kept.select(*[F.col(f"doc.`{c}`").alias(c) for c in columns])
