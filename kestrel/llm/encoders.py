"""Exact, memoised encoding with the public tokenizers.

Both encoders cut a text where the tokenizer itself can never join two sides, look every piece up
in a bounded memo, and ask the ``tokenizers`` library only for pieces not met before. A forgotten piece is encoded again.
"""

from __future__ import annotations

import re
import sys
from array import array

import numpy as np

#: Entries in one generation of a memo (about 200 bytes each); a Python worker holds two generations for each vocabulary.
MEMO_ENTRIES = 200_000

_ENCODERS: dict = {}


def default_path(name: str) -> str:
    """Where the installed vocabulary ``name`` lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_chars() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte.

    Printable Latin-1 bytes stand for themselves; the others, in order, for U+0100 and up.
    """
    own = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


BYTE_CHARS = _byte_chars()


def _load(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _as_level(text: str) -> str:
    return "".join(BYTE_CHARS[b] for b in text.encode())


class _Memo(dict):
    """A bounded memo of two generations: a full one becomes the old one, whose entries come back when used."""

    def __init__(self, make, entries: int | None = None):
        super().__init__()
        self.make = make
        self.entries = entries or MEMO_ENTRIES
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.old = {}


def _pack(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _Encoder:
    """Pieces of plain Latin letters with full stops or commas go to the merge model run by run; all others take the whole tokenizer.

    A run of letters is a piece itself, so one memo holds both.
    """

    MARKS = ".,"

    def __init__(self, path: str):
        self.tokenizer = _load(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.marks = {m: self._run(m) for m in self.MARKS}
        self.memo = _Memo(self._piece)

    def forget(self) -> None:
        """Empties the memo: a Python worker outlives its tasks, and would hold it beside all later stages."""
        self.memo.forget()

    def _run(self, run: str) -> bytes:
        level = run.replace(" ", BYTE_CHARS[32]).replace("\n", BYTE_CHARS[10]) if run.isascii() else _as_level(run)
        return _pack([t.id for t in self.tokenize(level)])

    def _whole(self, text: str) -> bytes:
        return _pack(self.tokenizer.encode(text, add_special_tokens=False).ids)


class WordEncoder(_Encoder):
    """Text -> ids of ``word_bpe_49k.json``.

    That tokenizer drops white space and never joins characters across it (its special tokens
    hold none either), so the ids of a text are the ids of its words in a row.
    """

    _LETTERS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")

    def _piece(self, word: bytes) -> bytes:
        text = word.decode()
        if m := self._LETTERS.fullmatch(text):
            run = m[1].lower()
            ids = self._run(run) if run == text else self.memo[run.encode()]
            return ids + self.marks[m[2]] if m[2] else ids
        return self._whole(text)

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, text.encode().split()))


class SpacedEncoder(_Encoder):
    """UTF-8 -> ids of ``byte_bpe_50k.json``, and back.

    Its splitting pattern always starts a new piece at a space that is followed by a character
    that is not white space, whatever stands before it; ``pieces`` cuts only there. A text that
    holds the special token's string is encoded whole, as the library first cuts it there.
    """

    #: A space that may not start a piece: the next byte is missing, white space, a control
    #: character, or leads a character that may be white space (U+0085, U+00A0, U+1680, U+2000.., U+3000).
    UNSAFE = re.compile(rb" (?![!-~\xc3-\xdf\xe4-\xf4])")
    SPECIAL = b"<|endoftext|>"
    MARKS = ".,\n"
    _LINES = re.compile("(?: ?[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?)(?:\n[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?)*")
    _RUNS = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+|[.,\n]")

    def __init__(self, path: str):
        super().__init__(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        level = {c: b for b, c in enumerate(BYTE_CHARS)}
        self.token_bytes = {i: bytes(level[c] for c in s) for s, i in vocab.items()}
        self.token_bytes |= {i: t.content.encode() for i, t in self.tokenizer.get_added_tokens_decoder().items()}

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode()
        if self._LINES.fullmatch(text):
            runs = self._RUNS.findall(text)
            if len(runs) == 1:
                return self._run(text)
            return b"".join([self.marks[r] if r in self.marks else self.memo[r.encode()] for r in runs])
        return self._whole(text)

    def pieces(self, raw: bytes) -> list[bytes]:
        """``raw`` cut at every safe space; the pieces join to ``raw``."""
        parts = raw.split(b" ")
        out = [parts[0], *[b" " + p for p in parts[1:]]]
        if self.UNSAFE.search(raw):
            whole: list[list[bytes]] = []
            for p in out:
                if whole and self.UNSAFE.match(p):
                    whole[-1].append(p)
                else:
                    whole.append([p])
            out = [b"".join(x) for x in whole]
        return out[1:] if not out[0] else out

    def encode(self, raw: bytes) -> bytes:
        """Ids of ``raw`` as little-endian unsigned 32-bit integers."""
        if self.SPECIAL in raw:
            return self._whole(raw.decode())
        return b"".join(map(self.memo.__getitem__, self.pieces(raw)))

    def decode(self, ids: bytes) -> str:
        """Text of packed ids, special tokens written out; broken UTF-8 shows as U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def encoder(kind: type[_Encoder], path: str):
    """The worker's encoder of this kind for this vocabulary file; it lives as long as the Python worker."""
    if (kind, path) not in _ENCODERS:
        _ENCODERS[kind, path] = kind(path)
    return _ENCODERS[kind, path]
