"""Byte-level BPE with content-defined chunk reuse.

A rolling hash over the last ``WINDOW`` bytes cuts texts where their own content says so, so the
same passage yields the same chunks in every document that holds it. A worker encodes a chunk
once and keeps its ids. Ids of neighbouring chunks need not be those of the joined text, so every
join is repaired: the end of the left and the start of the right chunk are re-encoded together,
out to the nearest places where both encodings must agree with that of the whole text (a safe
space, where the splitting pattern always starts a new piece); a chunk without such a place is
taken into the repair as a whole, and the repair goes on into the next chunk.

Chunks are shared per Python worker, in a store of two bounded generations, instead of through a
shuffle: moving each distinct chunk's text and ids would cost more than encoding it again.

Defined results: a null text is empty; an empty text has no ids and decodes to the empty string;
repeated rows each yield a row; an empty table yields no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kestrel.llm.common import id_text
from kestrel.llm.encoders import SpacedEncoder, _Memo, encoder

#: Bytes the rolling hash sees, and the mask that makes chunks about 512 bytes long on average.
WINDOW = 16
MASK = np.uint64(511)
_FACTOR = 0x9E3779B97F4A7C15 | 1


def _weights(window: int) -> np.ndarray:
    out = np.ones(window, np.uint64)
    for i in range(1, window):
        out[i] = np.uint64(int(out[i - 1]) * _FACTOR % 2**64)
    return out


_WEIGHTS = _weights(WINDOW)


def cut_points(raw: np.ndarray, mask: np.uint64 = MASK) -> np.ndarray:
    """Positions in UTF-8 ``raw`` at which a new chunk starts (0 left out), each the start of a character."""
    if len(raw) <= WINDOW:
        return np.empty(0, np.int64)
    wide = raw.astype(np.uint64) + np.uint64(1)
    n = len(raw) - WINDOW
    rolling = np.zeros(n, np.uint64)
    for i, w in enumerate(_WEIGHTS):
        rolling += wide[i : i + n] * w
    rolling ^= rolling >> np.uint64(29)
    rolling *= np.uint64(0xBF58476D1CE4E5B9)
    at = np.flatnonzero((rolling >> np.uint64(32)) & mask == 0) + WINDOW
    return at[(raw[at] & 0xC0) != 0x80]


class ChunkEncoder:
    """Encodes texts chunk by chunk; equal chunks are encoded once while they stay in the store."""

    #: Chunks in one generation of the store (about 3 kB each).
    STORE = 12_000

    def __init__(self, enc: SpacedEncoder, mask: np.uint64 = MASK):
        self.enc = enc
        self.mask = mask
        self.store = _Memo(self._chunk, self.STORE)
        self.encoded = self.used = 0

    def _chunk(self, raw: bytes) -> tuple:
        """(head, middle ids, tail): head ends and tail starts at a safe space; (raw, None, b"") if there is none."""
        self.encoded += 1
        pieces = self.enc.pieces(raw)
        # The last byte decides nothing about a space before it, but a space at the very end could still go either way.
        if raw[:1] == b" " and not self.enc.UNSAFE.match(raw):
            pieces = [b"", *pieces]
        if len(pieces) < 2:
            return raw, None, b""
        return pieces[0], b"".join(map(self.enc.memo.__getitem__, pieces[1:-1])), pieces[-1]

    def encode(self, raw: bytes) -> bytes:
        if self.enc.SPECIAL in raw:
            return self.enc.encode(raw)
        at = [0, *cut_points(np.frombuffer(raw, np.uint8), self.mask).tolist(), len(raw)]
        out: list[bytes] = []
        open_ = b""  # what still waits for the next safe space
        for a, b in zip(at, at[1:]):
            self.used += 1
            head, middle, tail = self.store[raw[a:b]]
            open_ += head
            if middle is not None:
                out.append(self.enc.encode(open_))
                out.append(middle)
                open_ = tail
        out.append(self.enc.encode(open_))
        return b"".join(out)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and decoded (text of those ids)."""
    id_type = dict(docs.select("doc_id").dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(SpacedEncoder, path)
        chunks = enc.__dict__.setdefault("chunks", ChunkEncoder(enc))
        for batch in batches:
            ids = [chunks.encode(t.encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([enc.decode(x) for x in ids], pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    return id_text(docs).mapInArrow(run, f"doc_id {id_type}, n_tokens long, ids binary, decoded string")
