"""Language-model scores from a probabilistic suffix tree over words.

The tokens of a text are its lower-cased words and one end. A word that occurs often enough in training is
a symbol of its own; the others share ``ENDINGS`` symbols by their last two bytes. A context is the last few symbols, the
start of the text included; contexts of up to ``DEPTH`` symbols that occur often enough are candidates.
"Often enough" is ``WORD_SHARE`` or ``CONTEXT_SHARE`` of the tokens in a corpus of ``SHARE_TOKENS``, and grows with the 2/3 power
of the corpus beyond (see ``least_count``): the tree grows with the corpus, by its cube root at the least, to at most
(tokens / SHARE_TOKENS)^(1/3) / CONTEXT_SHARE candidates of each length. Next symbols seen once after a context are left to
smoothing. A candidate is retained if its next-symbol counts diverge from those of the context
one symbol shorter by more bits than its own table costs (``COST`` * log2 of the corpus for each next
symbol), or if a longer context that ends in it is retained. A state's next-symbol distribution is
smoothed with that of the state one symbol shorter, by as many pseudo-counts as it has distinct next
symbols; a symbol is predicted from the longest retained context.

    P(word | context) = (1 - u) * P(symbol | context) * P(word | symbol)      u: a word not seen in training
    P(word | symbol) = (c + 0.5) / sum of (c + 0.5) over the words of the symbol

u is estimated from the words seen once; as in the base score, "not seen" is one event.

The corpus is read once: documents are taken in blocks, each with a dictionary of its words, which is
cut into parts by a hash of the word. The parts of one hash bucket meet in one task, where each word's
counts are summed, and every part gets the totals of its words back; there are as many buckets as
blocks, so a bucket holds about as many words as a block. Contexts are counted block by block
before anything is shuffled.

Defined results: a null text is empty and scored as its end alone; repeated rows are each counted
and scored; without training rows every word is unknown; an empty table yields no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, text_or_empty

DEPTH = 3
#: Least share of ``SHARE_TOKENS`` training tokens for a word to be a symbol of its own, and for a context to be a candidate.
WORD_SHARE, CONTEXT_SHARE = 2e-4, 5e-4
SHARE_TOKENS = 150_000
#: Bits that a state must save for each of its next symbols, times the bits of a corpus position.
COST = 0.5
#: Symbols that all other words share, by how they end.
ENDINGS = 1021
#: A block ends at this many documents or characters, whichever comes first.
BLOCK_ROWS, BLOCK_CHARS = 1000, 4_000_000
#: Writer options of the staged blocks.
BY_BLOCK = {"parquet.block.size": str(1 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.row.count.limit": "1"}
#: Places of a block that are looked at together: a task holds a few arrays of this length, not of the block's.
PIECE = 1 << 16

START, END, FIRST_ENDING = 0, 1, 2
_ROOT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def least_count(tokens: int, share: float) -> float:
    """How often a word or context must occur: ``share`` of a small corpus, growing with the 2/3 power of a larger one."""
    return max(2.0, share * tokens * min(1.0, (SHARE_TOKENS / max(tokens, 1)) ** (1 / 3)))


class _Index(dict):
    """Word -> its number in the order of first sight."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def words_of(text: str) -> list[bytes]:
    """Words as UTF-8, A-Z lower-cased."""
    return text.encode().lower().split()


def blocks(docs: DataFrame, held_out: Column, buckets: int = 16) -> DataFrame:
    """One row per block: ids, which are held out, tokens per document, all tokens as word numbers, and the dictionary.

    The dictionary is in parts, one per bucket that occurs: bucket, words (joined by spaces) and their
    training counts. Words are numbered through all parts.
    """
    df = docs.select("doc_id", text_or_empty().alias("text"), held_out.alias("held_out"))
    id_type = dict(df.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids: list = []
        held: list[bool] = []
        sizes: list[int] = []
        tokens, index, seen = array("I"), _Index(), 0

        def flush() -> pa.RecordBatch:
            words = list(index)
            bucket = np.fromiter((crc32(w) % buckets for w in words), np.int32, len(words))
            order = np.argsort(bucket, kind="stable")
            number_of = np.empty(len(words), np.uint32)
            number_of[order] = np.arange(len(words), dtype=np.uint32)
            at = number_of[np.frombuffer(tokens, np.uint32)]
            counts = np.bincount(at[np.repeat(~np.array(held, bool), sizes)], minlength=len(words)).astype("<u4")
            cuts = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(words)] if words else [0]
            spans = list(zip(cuts, cuts[1:]))
            one = [
                pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids, id_arrow)),
                pa.array([held], pa.list_(pa.bool_())), pa.array([sizes], pa.list_(pa.int64())), pa.array([at.astype("<u4").tobytes()], pa.binary()),
                pa.array([[int(bucket[order[a]]) for a, _ in spans]], pa.list_(pa.int32())),
                pa.array([[b" ".join([words[k] for k in order[a:b]]) for a, b in spans]], pa.list_(pa.binary())),
                pa.array([[counts[a:b].tobytes() for a, b in spans]], pa.list_(pa.binary())),
            ]
            return pa.RecordBatch.from_arrays(one, names=["block", "ids", "held", "sizes", "tokens", "bucket", "words", "counts"])

        id_arrow = None
        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for doc, text, out in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                ids.append(doc)
                held.append(out)
                sizes.append(len(words))
                tokens.extend(map(index.__getitem__, words))
                seen += len(text)
                if len(ids) >= BLOCK_ROWS or seen >= BLOCK_CHARS:
                    yield flush()
                    number += 1
                    ids, held, sizes, tokens, index, seen = [], [], [], array("I"), _Index(), 0
        if ids:
            yield flush()

    return df.mapInArrow(run, f"block long, ids array<{id_type}>, held array<boolean>, sizes array<long>, tokens binary, bucket array<int>, words array<binary>, counts array<binary>")


def _split(words: bytes) -> list[bytes]:
    return words.split(b" ") if words else []


def word_totals(staged: DataFrame) -> DataFrame:
    """Training counts summed over all blocks, in two kinds of rows.

    With a block: bucket and counts, the totals of that part's words in order. Without one: words
    and counts, all words of a bucket with their totals.
    """
    parts = staged.select("block", F.explode(F.arrays_zip("bucket", "words", "counts")).alias("p")).select("block", "p.*")

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total: Counter = Counter()
        for words, counts in zip(pdf["words"], pdf["counts"]):
            for w, c in zip(_split(words), np.frombuffer(counts, "<u4").tolist()):
                total[w] += c
        back = [np.fromiter(map(total.__getitem__, _split(w)), "<u8").tobytes() for w in pdf["words"]]
        every = np.fromiter(total.values(), "<u8", len(total)).tobytes()
        return pd.DataFrame({
            "block": pd.array([*pdf["block"], None], "Int64"), "bucket": [*pdf["bucket"], int(pdf["bucket"].iloc[0])],
            "words": [*[None] * len(pdf), b" ".join(total)], "counts": [*back, every],
        })

    return parts.groupBy("bucket").applyInPandas(add, "block long, bucket int, words binary, counts binary")


def _ending(word: bytes) -> int:
    return FIRST_ENDING + (word[-1] * 257 + (word[-2] if len(word) > 1 else 0)) % ENDINGS


def _endings(words: list[bytes]) -> np.ndarray:
    """``_ending`` of every word."""
    text = np.frombuffer(b"  " + b" ".join(words) + b" ", np.uint8).astype(np.int64)
    after = np.flatnonzero(text == 32)[2:] if words else np.empty(0, np.int64)
    before = np.where(text[after - 2] == 32, 0, text[after - 2])
    return FIRST_ENDING + (text[after - 1] * 257 + before) % ENDINGS


def _deeper(key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Key of the context that has one more, older symbol."""
    key = (key ^ (np.asarray(symbol).astype(np.uint64) + np.uint64(1))) * _MIX
    return key ^ (key >> np.uint64(31))


def _entry(key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Key of a context and a next symbol."""
    key = (key + np.asarray(symbol).astype(np.uint64) + np.uint64(7)) * _ROOT
    return key ^ (key >> np.uint64(29))


def context_key(symbols: tuple[int, ...]) -> np.uint64:
    """Key of a context, its symbols in the order of the text."""
    key = np.array([_ROOT])
    for s in reversed(symbols):
        key = _deeper(key, np.array([s]))
    return key[0]


def _place(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted key stands in the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


@dataclass
class Level:
    """Contexts of one length: sorted keys, occurrences, distinct next symbols; and counts by sorted entry key."""

    keys: np.ndarray
    total: np.ndarray
    kinds: np.ndarray
    entries: np.ndarray
    counts: np.ndarray


@dataclass
class Tree:
    """``root``: probability of every symbol without context, the symbols of ``own`` words among them."""

    own: dict[bytes, int]
    root: np.ndarray
    levels: list[Level]

    def symbols(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.own.get, words, repeat(0)), np.int64, len(words))
        return np.where(found > 0, found, _endings(words))

    def predict(self, flat: np.ndarray, at: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Probability of the symbol at each of the places ``at``, each of which may look ``back`` so far."""
        p = self.root[flat[at]]
        key = np.full(len(at), _ROOT)
        live = np.arange(len(at))
        for depth, level in enumerate(self.levels, 1):
            live = live[back[live] >= depth]
            key[live] = _deeper(key[live], flat[at[live] - depth])
            found = _place(level.keys, key[live])
            live, found = live[found >= 0], found[found >= 0]
            if not len(live):
                break
            entry = _place(level.entries, _entry(key[live], flat[at[live]]))
            kinds = level.kinds[found]
            p[live] = (np.where(entry >= 0, level.counts[entry], 0) + kinds * p[live]) / (level.total[found] + kinds)
        return p


def _laid(symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents one after the other as START, symbols, END; the places to predict (all but START); how far each may look back."""
    ends = np.cumsum(sizes + 2)
    starts = ends - sizes - 2
    flat = np.empty(int((sizes + 2).sum()), np.int32)
    inner = np.ones(len(flat), bool)
    inner[starts] = inner[ends - 1] = False
    flat[starts], flat[ends - 1], flat[inner] = START, END, symbols
    place = np.arange(len(flat), dtype=np.int32) - np.repeat(starts.astype(np.int32), sizes + 2)
    at = np.flatnonzero(place > 0)
    return flat, at, place[at]


def _pieces(n: int) -> Iterator[slice]:
    return (slice(a, a + PIECE) for a in range(0, n, PIECE))


def _of_block(batch: pa.RecordBatch, i: int, *names: str) -> list:
    out: list = []
    for name in names:
        col = batch.column(batch.schema.get_field_index(name)).slice(i, 1)
        if name == "tokens":
            out.append(np.frombuffer(col[0].as_py(), "<u4"))
        elif name == "words":
            out.append(_split(b" ".join(col[0].as_py())))
        elif name == "totals":
            out.append(np.frombuffer(b"".join(col[0].as_py() or []), "<u8"))
        else:
            out.append(col.flatten().to_numpy(zero_copy_only=False))
    return out


def next_counts(staged: DataFrame, tree: Tree, contexts: list[tuple[int, ...]]) -> dict[tuple[int, ...], dict[int, int]]:
    """Next-symbol counts, from two up, of these contexts, all of one length, over the training documents."""
    depth = len(contexts[0])
    by_key = {int(np.int64(context_key(c))): c for c in contexts}
    keys = np.sort(np.array(list(by_key), np.int64).view(np.uint64))
    sent = staged.sparkSession.sparkContext.broadcast((tree.own, keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, wanted = sent.value
        mapped = Tree(own, np.empty(0), [])
        for batch in batches:
            for i in range(batch.num_rows):
                held, sizes, tokens, words = _of_block(batch, i, "held", "sizes", "tokens", "words")
                train = ~held.astype(bool)
                symbols = mapped.symbols(words)[tokens[np.repeat(train, sizes)]]
                flat, at, back = _laid(symbols, sizes[train])
                at = at[back >= depth]
                del back
                found = []
                for piece in _pieces(len(at)):
                    near = at[piece]
                    key = np.full(len(near), _ROOT)
                    for d in range(1, depth + 1):
                        key = _deeper(key, flat[near - d])
                    hit = _place(wanted, key) >= 0
                    key, symbol = key[hit], flat[near[hit]]
                    entry, one, n = np.unique(_entry(key, symbol), return_index=True, return_counts=True)
                    found.append((entry, key[one], symbol[one], n))
                if found:
                    entry, key, symbol, n = (np.concatenate(x) for x in zip(*found))
                    order = np.argsort(entry, kind="stable")
                    first = np.flatnonzero(np.diff(entry[order], prepend=~entry[order[:1]]))
                    one, n = order[first], np.add.reduceat(n[order], first) if len(first) else n
                    yield pa.RecordBatch.from_arrays([pa.array(key[one].view(np.int64)), pa.array(symbol[one]), pa.array(n)], names=["context", "symbol", "n"])

    rows = staged.select("held", "sizes", "tokens", "words").mapInArrow(run, "context long, symbol int, n long")
    table = rows.groupBy("context", "symbol").agg(F.sum("n").alias("n")).filter("n >= 2").toArrow()
    out: dict[tuple[int, ...], dict[int, int]] = {}
    for context, symbol, n in zip(*(table.column(c).to_pylist() for c in ("context", "symbol", "n"))):
        out.setdefault(by_key[context], {})[symbol] = n
    return out


def _level(kept: dict[tuple[int, ...], dict[int, int]]) -> Level:
    order = sorted(kept, key=context_key)
    keys = np.array([context_key(c) for c in order], np.uint64)
    entries = [(_entry(np.full(len(kept[c]), k), np.array(list(kept[c]))), np.array(list(kept[c].values()), float)) for c, k in zip(order, keys)]
    entry, count = (np.concatenate(x) for x in zip(*entries)) if entries else (np.empty(0, np.uint64), np.empty(0))
    by = np.argsort(entry)
    return Level(keys, np.array([sum(kept[c].values()) for c in order], float), np.array([len(kept[c]) for c in order], float), entry[by], count[by])


def grow(staged: DataFrame, own: dict[bytes, int], root: np.ndarray, symbol_counts: np.ndarray, tokens: int, depth: int = DEPTH, share: float = CONTEXT_SHARE, cost: float = COST) -> Tree:
    """Candidates length by length, each from the next-symbol counts of shorter ones; then the divergence test from the longest down."""
    least = least_count(tokens, share)
    bits = cost * math.log2(max(tokens, 2))
    tree = Tree(own, root, [])
    contexts: list[tuple[int, ...]] = [(int(s),) for s in np.flatnonzero(symbol_counts >= least) if s != END]
    counted: list[dict[tuple[int, ...], dict[int, int]]] = []
    while contexts and len(counted) < depth:
        counted.append(next_counts(staged, tree, contexts))
        contexts = [(*c, s) for c, after in counted[-1].items() for s, n in after.items() if n >= least and s != END]
    needed: set[tuple[int, ...]] = set()
    for at in range(len(counted) - 1, -1, -1):
        kept = {}
        for context, after in counted[at].items():
            total = sum(after.values())
            shorter = counted[at - 1][context[1:]] if at else None
            if shorter is None:
                before = [root[s] for s in after]
            else:
                whole = sum(shorter.values())
                before = [shorter[s] / whole for s in after]
            gain = sum(n * math.log2(n / total / q) for n, q in zip(after.values(), before))
            if gain >= bits * len(after) or context in needed:
                kept[context] = after
                needed.add(context[1:])
        tree.levels.insert(0, _level(kept))
    return tree


def bucket_count(docs: DataFrame) -> int:
    """As many buckets as blocks, by whichever of a block's bounds gives more."""
    size = docs.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.length(text_or_empty()).cast("long")), F.lit(0).cast("long")).alias("chars")).first()
    return max(1, -(-size["rows"] // BLOCK_ROWS), -(-size["chars"] // BLOCK_CHARS))


def score(docs: DataFrame, held_out: Column, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    id_type = dict(docs.select("doc_id").dtypes)["doc_id"]
    # A row group for each block: what is read, and held outside the heap, at a time is one block's column, not a file's.
    staged = materialize(blocks(docs, held_out, bucket_count(docs)), "suffix-blocks", **BY_BLOCK)
    totals = materialize(word_totals(staged), "suffix-totals")
    words = totals.filter("block is null").select("words", "counts")
    zero = F.lit(0).cast("long")

    def sizes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = np.concatenate([np.empty(0, "<u8"), *[np.frombuffer(x, "<u8") for x in batch.column(1).to_pylist()]])
            yield pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in (c.sum(), (c > 0).sum(), (c == 1).sum())], names=["n", "v", "once"])

    sums = words.mapInArrow(sizes_of, "n long, v long, once long").agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("n", "v", "once")]).first()
    ends = staged.agg(F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), zero).alias("n")).first()["n"]
    n, v = sums["n"] + ends, sums["v"] + (ends > 0)
    below = n + 0.5 * (v + 1)
    unseen = (sums["once"] + 0.5) / (n + 1.0)

    # At most (n / SHARE_TOKENS)^(1/3) / WORD_SHARE words.
    least = least_count(n, WORD_SHARE)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keep = np.flatnonzero(np.frombuffer(c, "<u8") >= least).tolist()
                if keep:
                    part = _split(w)
                    yield pa.RecordBatch.from_arrays([pa.array([part[k] for k in keep], pa.binary())], names=["word"])

    often = words.mapInArrow(frequent, "word binary").orderBy("word").toArrow()
    own = {w: FIRST_ENDING + ENDINGS + i for i, w in enumerate(often.column("word").to_pylist())}
    alone = Tree(own, np.empty(0), [])
    sent_own = docs.sparkSession.sparkContext.broadcast(alone)

    def by_symbol(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c_sum, kinds = (np.zeros(FIRST_ENDING + ENDINGS + len(sent_own.value.own), np.int64) for _ in range(2))
        for batch in batches:
            for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                count = np.frombuffer(c, "<u8").astype(np.int64)
                symbol = sent_own.value.symbols(_split(w))
                np.add.at(c_sum, symbol, count)
                np.add.at(kinds, symbol, (count > 0).astype(np.int64))
        some = np.flatnonzero(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(c_sum[some]), pa.array(kinds[some])], names=["symbol", "c", "kinds"])

    per_symbol = words.mapInArrow(by_symbol, "symbol long, c long, kinds long").groupBy("symbol").agg(F.sum("c").alias("c"), F.sum("kinds").alias("kinds")).toArrow()
    counts, mass = (np.zeros(FIRST_ENDING + ENDINGS + len(own)) for _ in range(2))
    at = per_symbol.column("symbol").to_numpy()
    counts[at] = per_symbol.column("c").to_numpy()
    mass[at] = counts[at] + 0.5 * per_symbol.column("kinds").to_numpy()
    counts[START] = counts[END] = ends
    mass[END] = ends + 0.5
    tree = grow(staged, own, mass / mass.sum(), counts, n, depth)
    # Bounded by the cube root of the corpus, see the module's first paragraph.
    sent = docs.sparkSession.sparkContext.broadcast((tree, mass))

    parts = F.transform(F.sort_array(F.collect_list(F.struct("bucket", "counts"))), lambda x: x["counts"])
    per_block = totals.filter("block is not null").groupBy("block").agg(parts.alias("totals"))
    joined = staged.select("block", "ids", "held", "sizes", "tokens", "words").join(per_block, "block", "left")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, mass = sent.value
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column(batch.schema.get_field_index("ids")).slice(i, 1).flatten()
                held = batch.column(batch.schema.get_field_index("held")).slice(i, 1).flatten()
                sizes, tokens, words, c = _of_block(batch, i, "sizes", "tokens", "words", "totals")
                symbol = tree.symbols(words)
                flat, at, back = _laid(symbol[tokens], sizes)
                known = c > 0
                base_of = np.log10((c.astype(float) + 0.5) / below)
                share_of = np.where(known, np.log10(np.where(known, (c + 0.5) / np.maximum(mass[symbol], 0.5), 1)), 0)
                values, words_before = np.empty((len(at), 3)), 0
                for piece in _pieces(len(at)):
                    near = at[piece]
                    is_end = flat[near] == END
                    token = tokens[words_before:words_before + int((~is_end).sum())]
                    words_before += len(token)
                    seen = np.ones(len(near))
                    base = np.full(len(near), math.log10((ends + 0.5) / below))
                    inner = np.zeros(len(near))
                    seen[~is_end], base[~is_end], inner[~is_end] = known[token], base_of[token], share_of[token]
                    seen[is_end] = ends > 0
                    word = (seen > 0) | is_end
                    log = np.full(len(near), math.log10(unseen))
                    log[word] = (np.log10(tree.predict(flat, near[word], back[piece][word])) + inner[word]) + math.log10(1 - unseen)
                    values[piece] = np.c_[seen, base, log]
                firsts = np.cumsum(sizes + 1) - sizes - 1
                run = np.add.reduceat(values, firsts, axis=0)
                yield pa.RecordBatch.from_arrays(
                    [ids, held, pa.array(sizes + 1), pa.array(run[:, 0].astype(np.int64)), pa.array(np.full(len(sizes), n, np.int64)), pa.array(run[:, 1]), pa.array(run[:, 2])],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return joined.mapInArrow(add_up, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
