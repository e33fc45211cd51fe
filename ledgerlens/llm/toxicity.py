"""Toxicity by compression distance with zstandard dictionaries.

Method: two dictionaries are trained, one on windows of ordinary labelled text, one
on windows of toxic labelled text. A window is one word, written as a fixed 16-byte
code of its lower-cased letters, so that every word costs the same without a
dictionary and a short word a dictionary holds is shortened as much as a long one.
A window speaks for toxicity if the toxic dictionary shortens it by ``MARGIN`` bytes
more than the ordinary one does. Windows that toxic text holds ``RATIO`` times as
often as ordinary text are left out of the ordinary dictionary's training, and the
toxic dictionary is trained on those that the ordinary one does not shorten. The number and the rate of speaking windows of
a document give its score by a logistic curve, calibrated on labelled rows that
no dictionary saw.

Training reads a bounded sample: ``TOXIC_ROWS`` and ``ORDINARY_ROWS`` labelled rows
with the smallest hash of their id and at most ``SAMPLE_CHARS`` characters. Scoring
reads every whole text; rows are independent, nothing is shuffled, and the model
(some 60 KB) goes to the tasks with the function.

Defined cases: null or empty text has no windows and gets the score of a text
without speaking windows; without both classes in the sample every score is the
share of toxic rows (0 if there are none); repeated rows get equal scores; an empty
table gives no rows. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import IS_LETTER, mix64, slices, text_bytes, word_hashes, word_spans

TOXIC_ROWS = 1500
ORDINARY_ROWS = 3000
SAMPLE_CHARS = 20_000
ORDINARY_BYTES = 128 << 10
TOXIC_BYTES = 16384
MARGIN = 2
LEVEL = 3
#: a toxic window stays if it is this many times as frequent as in ordinary text
RATIO = 8.0
STEM_BYTES = 4
_WIDTH = 16
_STEM_MARK = np.uint64(0x5555AAAA5555AAAA)
_FRAME = {"format": zstd.FORMAT_ZSTD1_MAGICLESS, "write_checksum": False, "write_content_size": False,
          "write_dict_id": False}


def window_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the windows of a string column, in the order of their rows, and the row of each."""
    data, offsets = text_bytes(column)
    starts, ends, rows = word_spans(data, offsets, IS_LETTER)
    words = word_hashes(data, starts, ends, lower=True)
    stems = word_hashes(data, starts, np.minimum(ends, starts + STEM_BYTES), lower=True) ^ _STEM_MARK
    return np.stack([words, stems], axis=1).reshape(-1), np.repeat(rows, 2)


def _windows(codes: np.ndarray) -> bytes:
    return np.stack([codes, mix64(codes)], axis=1).astype("<u8").tobytes()


class Dictionary:
    """A zstandard dictionary and the compressed length it gives windows."""

    def __init__(self, raw: bytes) -> None:
        parameters = zstd.ZstdCompressionParameters.from_level(LEVEL, **_FRAME)
        held = zstd.ZstdCompressionDict(raw)
        held.precompute_compress(compression_params=parameters)
        self.compressor = zstd.ZstdCompressor(dict_data=held, compression_params=parameters)

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        if not len(codes):
            return np.zeros(0, np.int64)
        at = np.arange(len(codes), dtype="<u8") * _WIDTH
        spans = np.stack([at, np.full(len(codes), _WIDTH, "<u8")], axis=1).astype("<u8").tobytes()
        out = self.compressor.multi_compress_to_buffer(zstd.BufferWithSegments(_windows(codes), spans), threads=1)
        return np.fromiter((len(out[i]) for i in range(len(out))), np.int64, len(out))


def train_dictionary(codes: np.ndarray, size: int, per_sample: int) -> bytes:
    raw, step = _windows(codes), _WIDTH * per_sample
    samples = [raw[i:i + step] for i in range(0, len(raw), step)]
    return zstd.train_dictionary(size, samples, d=8, k=_WIDTH).as_bytes()


@dataclass
class Model:
    """Trained dictionaries and calibration; ``weights`` apply to (1, log speaking, log rate)."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, float, float]
    base: float

    def score(self, spoke: np.ndarray, total: np.ndarray) -> np.ndarray:
        if not self.toxic:
            return np.full(len(total), self.base)
        z = _features(spoke, total) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _features(spoke: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(total)), np.log1p(spoke), np.log((spoke + 0.1) / (total + 20.0)) + 5], axis=1)


def speaking(ordinary: Dictionary, toxic: Dictionary, codes: np.ndarray) -> np.ndarray:
    """Which windows the toxic dictionary shortens by the margin more than the ordinary one."""
    by_toxic = toxic.lengths(codes)
    out = np.zeros(len(codes), bool)
    at = np.flatnonzero(by_toxic < _raw_length(toxic))  # a window it does not shorten cannot speak
    out[at] = ordinary.lengths(codes[at]) - by_toxic[at] >= MARGIN
    return out


def _raw_length(held: Dictionary) -> int:
    return int(held.lengths(mix64(np.arange(7, 23, dtype=np.uint64))).max())


def _rates(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    value, count = np.unique(codes, return_counts=True)
    return value, count / max(1, len(codes))


def fit(toxic: list[np.ndarray], ordinary: list[np.ndarray]) -> Model:
    """Train on documents given as arrays of window codes."""
    base = len(toxic) / max(1, len(toxic) + len(ordinary))
    nothing = Model(b"", b"", (0.0, 0.0, 0.0), base)
    learn_t, learn_o = ([d for i, d in enumerate(x) if i % 3] for x in (toxic, ordinary))
    if len(learn_t) < 4 or len(learn_o) < 4:
        return nothing
    # copies of a document say no more than one
    learn_t, learn_o = ([*{d.tobytes(): d for d in x}.values()] for x in (learn_t, learn_o))
    codes_t, codes_o = np.concatenate(learn_t), np.concatenate(learn_o)
    try:
        value_o, rate_o = _rates(codes_o)
        value_t, rate_t = _rates(codes_t)
        at = np.searchsorted(value_o, value_t).clip(max=len(value_o) - 1)
        known = np.where(value_o[at] == value_t, rate_o[at], 0.0) + 1 / len(codes_o)
        own = value_t[rate_t >= RATIO * known]
        # a word of one document only is no sign: it must come from three at least
        seen = np.bincount(np.searchsorted(own, np.concatenate([np.intersect1d(own, d) for d in learn_t])),
                           minlength=len(own)) if len(own) else np.zeros(0, int)
        own = own[seen >= 3]
        raw_o = train_dictionary(codes_o[~np.isin(codes_o, own)], ORDINARY_BYTES, 8)
        held_o = Dictionary(raw_o)
        left = codes_t[np.isin(codes_t, own)]
        left = left[held_o.lengths(left) >= _raw_length(held_o)]
        if not len(left):
            return nothing
        raw_t = train_dictionary(np.resize(left, max(len(left), 512)), TOXIC_BYTES, 4)
    except zstd.ZstdError:  # too little text to train on
        return nothing
    held_t = Dictionary(raw_t)
    spoke = [[int(speaking(held_o, held_t, d).sum()) for i, d in enumerate(x) if not i % 3] for x in (toxic, ordinary)]
    total = [[len(d) for i, d in enumerate(x) if not i % 3] for x in (toxic, ordinary)]
    x = _features(np.array(spoke[0] + spoke[1], float), np.array(total[0] + total[1], float))
    y = np.array([1.0] * len(spoke[0]) + [0.0] * len(spoke[1]))
    return Model(raw_o, raw_t, tuple(_logistic(x, y).tolist()), base)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 30) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression (Newton steps; no penalty on the first)."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)),
                               x.T @ (y - p) - penalty @ w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return w


def _codes_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            codes, rows = window_codes(part.column("text"))
            at = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=part.num_rows))])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("toxic"),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(codes.view(np.int64)))],
                names=["doc_id", "toxic", "codes"])


def held_out():
    """Whether crc32 of the id as text leaves 0 modulo 5; such rows are never learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS) -> Model:
    """Fit on a bounded sample of labelled rows outside the held-out fold."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = (known.where("toxic = 1").orderBy(*order).limit(toxic_rows)
              .union(known.where("toxic = 0").orderBy(*order).limit(ordinary_rows)))
    sample = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .where(F.length("text") <= SAMPLE_CHARS)
              .join(F.broadcast(chosen), "doc_id")  # at most toxic_rows + ordinary_rows ids
              .select("doc_id", "toxic", "text")
              .mapInArrow(_codes_task, "doc_id long, toxic int, codes array<long>")
              .groupBy("doc_id", "toxic").agg(F.min("codes").alias("codes"))  # one row for a repeated id
              .toArrow())
    rows = sorted(zip(sample.column("doc_id").to_pylist(), sample.column("toxic").to_pylist(),
                      range(sample.num_rows), strict=True))
    column = sample.column("codes").combine_chunks()
    by = {1: {}, 0: {}}
    for doc_id, toxic, i in rows:
        by[toxic][doc_id] = column[i].values.to_numpy().view(np.uint64)
    return fit(list(by[1].values()), list(by[0].values()))


_models: dict[bytes, tuple[Dictionary, Dictionary]] = {}


def _dictionaries(model: Model) -> tuple[Dictionary, Dictionary]:
    if model.toxic not in _models:
        _models.clear()
        _models[model.toxic] = Dictionary(model.ordinary), Dictionary(model.toxic)
    return _models[model.toxic]


def batch_scores(model: Model, column: pa.Array) -> np.ndarray:
    """Score of every text of a string column."""
    n = len(column)
    if not model.toxic:
        return np.full(n, model.base)
    codes, rows = window_codes(column)
    spoke = speaking(*_dictionaries(model), codes)
    return model.score(np.bincount(rows[spoke], minlength=n).astype(float), np.bincount(rows, minlength=n).astype(float))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(batch_scores(model, part.column("text")))], schema=schema)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose text scores below the threshold, with all their columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(batch_scores(model, part.column(text_col)) < threshold))

    return docs.mapInArrow(run, docs.schema)
