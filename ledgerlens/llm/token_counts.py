"""Edit-aware token counts: one segment tree over the pre-tokens of each document.

Method: a document is cut into pieces (a run of white space with the word after
it) that no pre-token crosses. A segment tree per document holds the characters
and the token count of every piece, with subtree sums. An edit replaces the
characters ``[start, stop)``: the tree is descended by character sums to the
pieces it touches, one more piece on either side is taken as boundary context,
only that region's text is cut and encoded anew, and the sums above it are
updated. Untouched pieces keep their counts, so work per edit is
``O(region + log pieces)``.

Each document is worked on alone inside its input split: no shuffle, no state
between rows, memory bounded by one text.

Defined cases: null or empty text has no pieces and no tokens; an edit on it only
inserts. Edits are given in the coordinates of the original text and are clipped to
it. Of edits that overlap the one that begins first holds, of those that begin
together the longest, then the one given first; the others are left out and not
counted. Insertions at one place are made in the order given, before an edit that
begins there. A null edit list means none. Repeated rows are counted once per row.
Columns other than those named are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import slices
from ledgerlens.llm.tokens import PieceEncoder, encoder, public_path

EDITS = "array<struct<start:int,stop:int,text:string>>"
SCHEMA = ("doc_id long, n_edits long, n_tokens_before long, n_tokens long, "
          "n_pieces long, pieces_reencoded long, n_chars long")
_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])


class PieceTree:
    """Segment tree over pieces; a leaf may come to hold several pieces or none."""

    def __init__(self, enc: PieceEncoder, text: str) -> None:
        self.enc = enc
        pieces = enc.pieces(text)
        self.leaves = [[p] for p in pieces]
        n = max(1, len(pieces))
        self.size = 1 << (n - 1).bit_length()
        self.sums = np.zeros((2, 2 * self.size), np.int64)  # characters, tokens
        self.sums[0, self.size:self.size + len(pieces)] = list(map(len, pieces))
        self.sums[1, self.size:self.size + len(pieces)] = enc.piece_counts(pieces)
        if not pieces:
            self.leaves = [[]]
        low = self.size
        while low > 1:
            self.sums[:, low // 2:low] = self.sums[:, low:2 * low:2] + self.sums[:, low + 1:2 * low:2]
            low //= 2
        self.reencoded = 0

    def count(self) -> int:
        return int(self.sums[1, 1])

    def n_pieces(self) -> int:
        return sum(map(len, self.leaves))

    def n_chars(self) -> int:
        return int(self.sums[0, 1])

    def locate(self, char: int) -> tuple[int, int]:
        """Leaf that holds the character, and the character its text begins at."""
        at, begin = 1, 0
        while at < self.size:
            at *= 2
            if begin + self.sums[0, at] <= char:
                begin += int(self.sums[0, at])
                at += 1
        return min(at - self.size, len(self.leaves) - 1), begin

    def _neighbour(self, leaf: int, step: int) -> int:
        """The next leaf in a direction that holds text (or the last leaf there is)."""
        at = leaf + step
        while 0 < at < len(self.leaves) - 1 and not self.leaves[at]:
            at += step
        return min(max(at, 0), len(self.leaves) - 1)

    def _set(self, leaf: int, pieces: list[str], counts: list[int]) -> None:
        self.leaves[leaf] = pieces
        at = self.size + leaf
        self.sums[:, at] = sum(map(len, pieces)), sum(counts)
        while at > 1:
            at //= 2
            self.sums[:, at] = self.sums[:, 2 * at] + self.sums[:, 2 * at + 1]

    def replace(self, start: int, stop: int, text: str) -> None:
        """Replace the characters [start, stop) and recount what that touches."""
        total = self.n_chars()
        start = min(max(start, 0), total)
        stop = min(max(stop, start), total)
        first, _ = self.locate(min(start, max(total - 1, 0)))
        last, _ = self.locate(min(max(stop - 1, start), max(total - 1, 0)))
        first, last = self._neighbour(first, -1), self._neighbour(max(first, last), 1)
        begin = self._begin(first)
        old = "".join(p for leaf in self.leaves[first:last + 1] for p in leaf)
        region = old[:start - begin] + text + old[stop - begin:]
        pieces = self.enc.pieces(region)
        counts = self.enc.piece_counts(pieces)
        self.reencoded += len(pieces)
        self._set(first, pieces, counts)
        for leaf in range(first + 1, last + 1):
            if self.leaves[leaf]:
                self._set(leaf, [], [])

    def _begin(self, leaf: int) -> int:
        at, begin = self.size + leaf, 0
        while at > 1:
            if at & 1:
                begin += int(self.sums[0, at - 1])
            at //= 2
        return begin


def resolved(edits: list[dict] | None, n_chars: int) -> list[tuple[int, int, str]]:
    """Edits as (start, stop, text) in order, clipped to the text and without overlaps."""
    spans = []
    for at, e in enumerate(edits or ()):
        if e is not None:
            start = min(max(e["start"] or 0, 0), n_chars)
            stop = start if e["stop"] is None else min(max(e["stop"], start), n_chars)
            spans.append((start, stop > start, -stop, at, e["text"] or ""))
    out, free = [], 0
    for start, replaces, stop, _, text in sorted(spans):  # insertions first, then the longest
        if start >= free:
            out.append((start, -stop, text))
            free = -stop if replaces else free
    return out


def edited_counts(enc: PieceEncoder, text: str | None, edits: list[dict] | None) -> tuple[int, ...]:
    """(edits, tokens before, tokens after, pieces, pieces encoded anew, characters)."""
    tree = PieceTree(enc, text or "")
    before = tree.count()
    todo = resolved(edits, len(text or ""))
    for start, stop, new in reversed(todo):  # from the end, so that earlier coordinates stay as they are
        tree.replace(start, stop, new)
    return len(todo), before, tree.count(), tree.n_pieces(), tree.reencoded, tree.n_chars()


def redaction_edits(text: str | None, pattern: re.Pattern, placeholder: str) -> list[dict]:
    """One edit for every match of a pattern."""
    return [{"start": m.start(), "stop": m.end(), "text": placeholder} for m in pattern.finditer(text or "")]


_SPACES = re.compile(r"[^\S\n]*\n\s*\n\s*|[^\S\n]{2,}|[\t\r\x0b\x0c]")
_HYPHEN = re.compile(r"(?<=\w)-\n(?=\w)")
_DIGITS = re.compile(r"[0-9]{3,}")
_LINE = re.compile(r"[^\n]*\S[^\n]*\n?")


def cleaning_edits(text: str | None, placeholder: str = "[NUMBER]", sentence_words: int = 12) -> list[dict]:
    """What a cleaning step does to a text, as edits that may overlap.

    Lines equal to an earlier one go; words broken over two lines are joined; runs of
    white space become one blank or one empty line; runs of three digits or more
    become a placeholder; a text that does not begin with a heading gets one, made of
    its first ``sentence_words`` words, and one that does not end a line gets a line end.
    """
    text = text or ""
    out, seen = [], set()
    words = text.split(None, sentence_words)[:sentence_words]
    if words and not text.startswith("#"):
        out.append((0, 0, "# " + " ".join(words) + "\n\n"))
    if text and not text.endswith("\n"):
        out.append((len(text), len(text), "\n"))
    for m in _LINE.finditer(text):
        line = m.group().strip()
        if line in seen:
            out.append((m.start(), m.end(), ""))
        seen.add(line)
    out += [(m.start(), m.end(), "") for m in _HYPHEN.finditer(text)]
    out += [(m.start(), m.end(), "\n\n" if m.group().count("\n") > 1 else " ") for m in _SPACES.finditer(text)]
    out += [(m.start(), m.end(), placeholder) for m in _DIGITS.finditer(text)]
    return [{"start": a, "stop": b, "text": t} for a, b, t in out]


def _count_task(tokenizer: str, edits_of: Callable[[str | None], list[dict]] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(public_path(tokenizer))
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                edits = [edits_of(t) for t in texts] if edits_of else part.column("edits").to_pylist()
                rows = [edited_counts(enc, t, e) for t, e in zip(texts, edits, strict=True)]
                cols = [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays(cols, schema=_ARROW)

    return run


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def count_tokens(docs: DataFrame, edits_col: str = "edits", tokenizer: str = "byte_bpe_50k.json",
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token counts of every document before and after its edits.

    ``edits_col`` is an array of (start, stop, text) in code points of the text.
    """
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         F.col(edits_col).cast(EDITS).alias("edits"))
    return picked.mapInArrow(_count_task(tokenizer, None), SCHEMA)


def count_redacted(docs: DataFrame, pattern: str = r"[0-9]{3,}", placeholder: str = "[NUMBER]",
                   tokenizer: str = "byte_bpe_50k.json", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token counts of every document before and after replacing each match of a pattern."""
    match = re.compile(pattern)
    return _picked(docs, id_col, text_col).mapInArrow(
        _count_task(tokenizer, lambda text: redaction_edits(text, match, placeholder)), SCHEMA)


def count_cleaned(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Token counts of every document before and after its cleaning edits."""
    return _picked(docs, id_col, text_col).mapInArrow(_count_task(tokenizer, cleaning_edits), SCHEMA)
