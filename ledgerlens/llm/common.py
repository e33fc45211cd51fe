"""Shared helpers of the llm operators: Arrow batches, word hashes, small models.

Words are maximal runs of characters other than space and U+0009..U+000D. Those
separators are single ASCII bytes, so words are found on the UTF-8 bytes of an
Arrow string column without decoding it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.session import ensure_checkpoint_dir, scratch_path

#: texts of one Arrow batch are worked on in slices of about this many bytes
SLICE_BYTES = 2 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POLY = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_POLY_INV = pow(_POLY, -1, 1 << 64)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    if _scopes:
        _scopes[-1].paths.append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


class _Scope:
    def __init__(self) -> None:
        self.paths: list[str] = []
        self.kept: set[str] = set()

    def keep(self, *tables: DataFrame) -> None:
        """Tables that what is returned still reads."""
        self.kept |= {t._scratch_path for t in tables}


_scopes: list[_Scope] = []


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[_Scope]:
    """Tables that ``written`` writes inside are removed at the end, but for those kept.

    Kept tables belong to the enclosing block, if there is one.
    """
    scope = _Scope()
    _scopes.append(scope)
    try:
        yield scope
    finally:
        _scopes.remove(scope)
        for path in scope.paths:
            if path not in scope.kept:
                target = spark._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
            elif _scopes:
                _scopes[-1].paths.append(path)


def free_names(taken: Iterable[str], *names: str) -> list[str]:
    """``names``, each with underscores added until it meets none of ``taken`` (in any case) and none before it."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64 (the splitmix64 output function)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    return mix64(x + np.uint64((int(_GOLDEN) * (seed + 1)) & 0xFFFFFFFFFFFFFFFF))


_BYTE_WEIGHT = mix64(np.arange(1, 257, dtype=np.uint64) * _GOLDEN) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_LOWER_WEIGHT = _BYTE_WEIGHT[_LOWER]
#: letters, digits and all bytes of other characters than ASCII
IS_LETTER = np.zeros(256, dtype=bool)
IS_LETTER[48:58] = IS_LETTER[65:91] = IS_LETTER[97:123] = IS_LETTER[128:] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16, 2 * len(_powers[0]))
        for k, base in enumerate((_POLY, _POLY_INV)):
            p = np.full(size, np.uint64(base), np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the n+1 offsets of its rows (null: empty)."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if buffers[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word_byte: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes) and row of every word; words never cross rows."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    is_word = is_word_byte[data]
    first = np.empty(len(data), bool)
    first[0] = True
    np.logical_not(is_word[:-1], out=first[1:])
    row_start = offsets[:-1]
    row_start = row_start[row_start < len(data)]
    first[row_start] = True
    starts = np.flatnonzero(is_word & first)
    last = np.empty(len(data), bool)
    last[-1] = True
    np.logical_not(is_word[1:], out=last[:-1])
    last[row_start[row_start > 0] - 1] = True
    ends = np.flatnonzero(is_word & last) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of every word; ``lower`` folds A-Z first."""
    up, down = _power_tables(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER_WEIGHT if lower else _BYTE_WEIGHT)[data] * up[:len(data)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch where the bytes of ``column`` exceed SLICE_BYTES (one row at least)."""
    _, offsets = text_bytes(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield batch.slice(at, to - at)
        at = to
