"""Byte-level BPE ids of whole texts, with a bounded memo of pieces.

The ids are those of the ``tokenizers`` library for a byte-level BPE file (default
special-token handling, no truncation or padding); tests hold them against that
library. A file whose merges are in the order of its ids is the same as a table of
ranks, so the ranks are read from the file and pieces are encoded by ``tiktoken``,
which costs far less per call.

A text is cut before every run of white space. No pre-token of the byte-level
pattern reaches from a non-space into the white space after it, so the ids of
the pieces, joined, are the ids of the text. Pieces repeat, so their counts are
kept in two generations of a bounded memo. Texts with U+001C..U+001F, on which
white-space definitions differ, are encoded whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

#: pieces held by each generation of the memo
MEMO_PIECES = 150_000

_PIECE = re.compile(r"\s*\S+|\s+")
_ODD = re.compile("[\x1c-\x1f]")
_encoders: dict[str, "PieceEncoder"] = {}


def byte_chars() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {b: chr(b) for b in plain}
    out |= {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in out)}
    return [out[b] for b in range(256)]


class Memo(dict):
    """Bounded memo of two generations: what was used lately survives a turn."""

    def __init__(self, make: Callable[[str], object], limit: int) -> None:
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key: str):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        if (value := self.old.get(key)) is None:
            value = self.make(key)
        self[key] = value
        return value


class PieceEncoder:
    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        ids = [vocab[a + b] for a, b in merges]
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"] or sorted(ids) != ids:
            raise ValueError(f"{path}: not a byte-level BPE whose ids follow its merges")
        of = {c: b for b, c in enumerate(byte_chars())}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(of[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.bpe = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.special)
        self.counts = Memo(lambda piece: len(self.ids(piece)), memo_pieces)

    def ids(self, text: str | None) -> list[int]:
        """Ids of a whole text, encoded at once."""
        if not text:
            return []
        if any(s in text for s in self.special):
            return self.bpe.encode(text, allowed_special="all")
        return self.bpe.encode_ordinary(text)

    def pieces(self, text: str | None) -> list[str]:
        """The text cut before every run of white space."""
        if not text:
            return []
        return [text] if _ODD.search(text) else _PIECE.findall(text)

    def piece_counts(self, pieces: list[str]) -> list[int]:
        """Number of ids of each piece."""
        return list(map(self.counts.__getitem__, pieces))


def encoder(path: str) -> PieceEncoder:
    """The encoder of this Python worker for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def public_path(name: str) -> str:
    """Place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
