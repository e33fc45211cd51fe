"""Packing of tokenised documents into fixed-size training sequences.

Method: best-fit decreasing. Documents longer than the window are first cut into
full windows, each a sequence of its own; what remains is placed, longest first,
into the open window with the least room that still holds it. A segment tree over
the remaining capacities (a count of open windows per capacity) finds that window
in ``log2(window)`` steps.

Packing needs no neighbour outside a task: each task packs the documents of its
own input split, in blocks of at most ``block`` remainders, so nothing is
shuffled, memory is bounded and a lost task is redone to the same result.

Defined cases: null or empty text is a document holding only the end id; repeated
rows and repeated ids are packed once per row; an empty table gives no rows;
columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.tokens import encoder, public_path

WINDOW = 1024
END_ID = 0
#: remainders packed together by one task
BLOCK = 200_000
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long, padded_tokens long")
_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])


class CapacityTree:
    """Segment tree over capacities 0..window: how many open windows have each."""

    def __init__(self, window: int) -> None:
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, window_no: int) -> None:
        self.open[capacity].append(window_no)
        self._bump(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (window, capacity) of the tightest window with room for ``need``."""
        count, at = self.count, need + self.size
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if count[2 * at] else 2 * at + 1
        capacity = at - self.size
        self._bump(capacity, -1)
        return self.open[capacity].pop(), capacity

    def _bump(self, capacity: int, by: int) -> None:
        at = capacity + self.size
        while at:
            self.count[at] += by
            at >>= 1


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """Window number and offset of every piece (in input order), and the number of windows."""
    tree, used = CapacityTree(window), 0
    place, offset = [0] * len(lengths), [0] * len(lengths)
    for i in np.argsort(-np.asarray(lengths, np.int64), kind="stable").tolist():
        need = lengths[i]
        if (found := tree.take(need)) is None:
            found = used, window
            used += 1
        place[i], offset[i] = found[0], window - found[1]
        if found[1] > need:
            tree.add(found[1] - need, found[0])
    return place, offset, used


def padded(total: np.ndarray, window: int) -> np.ndarray:
    """Length after padding: the window, but a power of two stays as it is."""
    return np.where(total & (total - 1) == 0, total, window)


def _emit(rows: list[tuple], sequences: list[int], offsets: list[int], window: int) -> pa.RecordBatch:
    table = np.array(rows, np.int64).reshape(-1, 5)
    seq, off = np.array(sequences, np.int64), np.array(offsets, np.int64)
    low = int(seq.min()) if len(seq) else 0
    total = np.bincount(seq - low, weights=table[:, 2]).astype(np.int64)[seq - low] if len(seq) else seq
    cols = [*table.T, seq, off, total, padded(total, window)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=_ARROW)


def _pack_task(tokenizer: str, window: int, end_id: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(public_path(tokenizer))
        base, used = TaskContext.get().partitionId() << 32, 0
        rest: list[tuple] = []

        def close() -> pa.RecordBatch:
            nonlocal used
            place, offset, n = best_fit_decreasing([r[2] for r in rest], window)
            out = _emit(rest, [base + used + p for p in place], offset, window)
            used += n
            rest.clear()
            return out

        for batch in batches:
            full, full_seq = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*enc.ids(text), end_id], "<u4").tobytes()
                n = len(ids) // 4
                for start in range(0, n, window):
                    part = ids[4 * start:4 * (start + window)]
                    row = (doc_id, start, len(part) // 4, zlib.crc32(part), n)
                    if row[2] == window:
                        full.append(row)
                        full_seq.append(base + used)
                        used += 1
                    else:
                        rest.append(row)
            if full:
                yield _emit(full, full_seq, [0] * len(full), window)
            if len(rest) >= block:
                yield close()
        if rest:
            yield close()

    return run


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", window: int = WINDOW,
         end_id: int = END_ID, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with the sequence and the offset each is packed at.

    Besides the piece, ``sequence_tokens`` is what the sequence holds and
    ``padded_tokens`` its length after padding. Rows with a null id are packed
    under id -1.
    """
    picked = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("doc_id"),
                         F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(_pack_task(tokenizer, window, end_id, block), SCHEMA)
