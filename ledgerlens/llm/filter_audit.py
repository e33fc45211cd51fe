"""Interaction of quality filters: what each removes in every order of application.

Filters A to E (too few words, too few distinct words, too many capitals, odd
characters, copy of an earlier document) give a document a mask of five bits. All
counts of all 120 orders follow from the number of documents per part and mask.

Copies are found in radix tries. One pass cuts the input into runs of bounded size,
keeps each text of a run once with its smallest id and writes rows and texts. The
sorted texts of a run give prefixes at even distances in bytes, each just long
enough to part two neighbours: short where texts differ early, long where many
share a beginning. From the prefixes of all runs the borders of the ranges are
chosen so that ranges hold about ``RANGE_BYTES``. The task of a range inserts its
full texts into a compressed trie whose terminals hold the smallest id; a walk over
the terminals tells every run the smallest id of texts that occur more than once.
Masks are then counted; only counts are left.

A text that many documents share reaches its range once per run, not once per
document. Prefixes over ``PREFIX_BYTES`` are no borders (ranges get larger, nothing
is lost). Distinct words are counted by 64-bit hashes; texts are compared in full.

Defined cases: a null text is empty, a null part the empty string; a document with a
null id is never a copy and makes none; rows of one id and text are no copies of
each other; a label counts if any label row of the id has it, null labels and ids
do not; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import permutations
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import slices, temporary_tables, text_bytes, word_hashes, word_spans, written
from ledgerlens.operators.ranks import global_running_sum

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITALS_PERCENT = 200, 50, 3
ODD_CHARACTERS = b"#$%&*|"
COPY = 1 << FILTERS.index("E")
#: bytes and rows of a run, bytes between two prefixes of a run, bytes of a range
RUN_BYTES, RUN_ROWS, STEP_BYTES, RANGE_BYTES = 16 << 20, 100_000, 1 << 20, 8 << 20
#: ranges grow beyond RANGE_BYTES when there would be more than this
MAX_RANGES = 1 << 17
PREFIX_BYTES = 4096
_ROWS = "run long, no int, doc_id long, part string, mask int, text string, least long, copies long, border binary"
_NO_ID = np.iinfo(np.int64).max


def masks(texts: pa.Array) -> np.ndarray:
    """Bits of filters A to D for every text."""
    data, offsets = text_bytes(texts)
    n = len(texts)
    starts, ends, rows = word_spans(data, offsets)
    words = np.bincount(rows, minlength=n)
    hashes = word_hashes(data, starts, ends, lower=False) if len(starts) else np.zeros(0, np.uint64)
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    distinct = np.bincount(r[new], minlength=n)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(flags))[offsets])
    chars = per_text((data & 0xC0) != 0x80)
    capitals = per_text((data >= 65) & (data <= 90))
    odd = np.zeros(256, bool)
    odd[list(ODD_CHARACTERS)] = True
    tests = (words < MIN_WORDS, 100 * distinct < MIN_DISTINCT_PERCENT * words,
             100 * capitals > MAX_CAPITALS_PERCENT * chars, per_text(odd[data]) > 0)
    return sum(t.astype(np.int64) << bit for bit, t in enumerate(tests))


def _borders(texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """(index in sorted ``texts``, prefix that parts it from the one before) about every STEP_BYTES."""
    passed, step = 0, 0
    for i, text in enumerate(texts):
        if passed // STEP_BYTES > step:
            step = passed // STEP_BYTES
            border = text[:len(commonprefix((texts[i - 1], text))) + 1]
            if len(border) <= PREFIX_BYTES:
                yield i, border
        passed += len(text) + 1


def _run(run: int, batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of one run; a text stands in its first row, with its smallest id and its number of rows."""
    coded = batch.column("text").fill_null("").dictionary_encode()
    texts = coded.dictionary
    by_text = pc.sort_indices(texts).to_numpy()
    rank = np.empty(len(texts), np.int64)
    rank[by_text] = np.arange(len(texts))
    no = rank[coded.indices.to_numpy()]
    ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy()
    least = np.full(len(texts), _NO_ID)
    np.minimum.at(least, no, ids)
    ordered = texts.take(pa.array(by_text))
    raw = ordered.cast(pa.binary()).to_pylist()
    mask = np.concatenate([masks(p.column(0)) for p in slices(pa.RecordBatch.from_arrays([ordered], ["text"]), "text")])
    first = np.zeros(len(no), bool)
    first[np.unique(no, return_index=True)[1]] = True
    borders = dict(_borders(raw))
    n, shown = len(no), ~first
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, run)), pa.array(no.astype(np.int32)), batch.column("doc_id"),
        batch.column("part"), pa.array(mask[no].astype(np.int32)),
        pc.if_else(pa.array(first), ordered.take(pa.array(no)), pa.scalar(None, pa.string())),
        pa.array(least[no], mask=shown | (least[no] == _NO_ID)), pa.array(np.bincount(no)[no], mask=shown),
        pa.array([borders.get(i) if f else None for i, f in zip(no.tolist(), first.tolist())], pa.binary()),
    ], [c.split()[0] for c in _ROWS.split(", ")])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = rows = 0
    for batch in batches:
        for part in slices(batch, "text"):
            held.append(part)
            size, rows = size + part.column("text").nbytes, rows + part.num_rows
            if size >= RUN_BYTES or rows >= RUN_ROWS:
                yield _run(run, pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                run, held, size, rows = run + 1, [], 0, 0
    if held:
        yield _run(run, pa.Table.from_batches(held).combine_chunks().to_batches()[0])


class Trie:
    """Compressed trie over bytes; a terminal holds the smallest id and who brought the text."""

    __slots__ = ("edge", "children", "least", "copies", "runs")

    def __init__(self, edge: bytes = b"") -> None:
        self.edge, self.children = edge, {}
        self.least, self.copies, self.runs = _NO_ID, 0, None

    def insert(self, text: bytes, least: int, copies: int, run: tuple[int, int]) -> None:
        node, at, end = self, 0, len(text)
        while at < end:
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Trie(text[at:])
                at = end
            elif text.startswith(child.edge, at):
                at += len(child.edge)
            else:  # the edge is parted where the text leaves it
                shared = len(commonprefix((child.edge, text[at:at + len(child.edge)])))
                middle = Trie(child.edge[:shared])
                child.edge = child.edge[shared:]
                middle.children[child.edge[0]] = child
                node.children[text[at]] = child = middle
                at += shared
            node = child
        node.least, node.copies = min(node.least, least), node.copies + copies
        if node.runs is None:
            node.runs = []
        node.runs.append(run)

    def terminals(self) -> Iterator["Trie"]:
        stack = [self]
        while stack:
            node = stack.pop()
            if node.runs is not None:
                yield node
            stack.extend(node.children.values())


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, no, least) of every text with more than one row in the range."""
    root = Trie()
    for batch in batches:
        runs, nos = batch.column("run").to_pylist(), batch.column("no").to_pylist()
        least, copies = batch.column("least").fill_null(_NO_ID).to_pylist(), batch.column("copies").to_pylist()
        texts = batch.column("text").cast(pa.binary())
        for i, text in enumerate(texts):
            root.insert(text.as_py(), least[i], copies[i], (runs[i], nos[i]))
    found = [(run, no, node.least) for node in root.terminals() if node.copies > 1 and node.least != _NO_ID
             for run, no in node.runs]
    if found:
        yield pa.RecordBatch.from_pydict(
            {"run": [f[0] for f in found], "no": pa.array([f[1] for f in found], pa.int32()), "least": [f[2] for f in found]})


def _ranges(rows: DataFrame) -> list[bytes]:
    """Borders of the ranges: prefixes about every RANGE_BYTES."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    steps = max(1, -(-max(RANGE_BYTES, total // MAX_RANGES) // STEP_BYTES))
    found = rows.filter(F.col("border").isNotNull()).groupBy("border").agg(F.count(F.lit(1)).alias("n"))
    run = global_running_sum(found, ["border"], "n")
    passed = F.floor(F.col("running") / steps) > F.floor((F.col("running") - F.col("n")) / steps)
    return sorted(bytes(r[0]) for r in run.filter(passed).select("border").toLocalIterator())


def copies(rows: DataFrame) -> DataFrame:
    """(run, no, least): the smallest id of every text that more than one row holds."""
    borders = _ranges(rows)
    held = rows.sparkSession.sparkContext.broadcast(borders)  # MAX_RANGES prefixes of PREFIX_BYTES at most

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                ranges = pa.array([bisect_right(held.value, t) for t in texts], pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns, ranges], [*part.schema.names, "range"])
    entries = rows.filter(F.col("text").isNotNull()).select("run", "no", "least", "copies", "text")
    return (entries.mapInArrow(deal, "run long, no int, least long, copies long, text string, range int")
            .repartitionById(len(borders) + 1, "range").mapInArrow(_walk, "run long, no int, least long"))


def document_masks(docs: DataFrame, id_col: str = "doc_id", part_col: str = "lang", text_col: str = "text") -> DataFrame:
    """doc_id, part and mask (bits of A to E, set where the document fails) of every row."""
    rows = written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).cast("string").alias("text")).mapInArrow(_runs, _ROWS), "audit-rows")
    later = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return (rows.select("run", "no", "doc_id", "part", "mask")
            .join(copies(rows).withColumnRenamed("least", "first_id"), ["run", "no"], "left")
            .select("doc_id", "part", (F.col("mask") + F.when(later, COPY).otherwise(0)).alias("mask")))


def orders() -> list[tuple[str, int, int, int]]:
    """(order, step, bits applied before, bit of the step) of all orders."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            out.append(("".join(order), step, before, bit))
            before |= bit
    return out


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", part_col: str = "lang",
          text_col: str = "text") -> DataFrame:
    """One row per part, order of the filters and step, with all its counts."""
    spark = docs.sparkSession
    marked = (labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
              .filter((F.col("good") == 1) | (F.col("bad") == 1)))
    with temporary_tables(spark) as tables:
        counted = written(
            document_masks(docs, id_col, part_col, text_col).join(marked, "doc_id", "left").groupBy("part", "mask")
            .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                 F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "audit-masks")
        tables.keep(counted)
    steps = spark.createDataFrame([(i, *o) for i, o in enumerate(orders())],
                                  "step_no int, filter_order string, step int, before int, bit int")
    mask, before, bit = F.col("mask"), F.col("before"), F.col("bit")
    fresh, fails = mask.bitwiseAND(before) == 0, mask.bitwiseAND(bit) != 0

    def total(what: str, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0))
    # a part has 32 masks at most, each meets the 600 steps
    table = (counted.withColumn("step_no", F.explode(F.sequence(F.lit(0), F.lit(len(orders()) - 1))))
             .join(F.broadcast(steps), "step_no")
             .groupBy("part", "filter_order", "step", "bit")
             .agg(total("n", fresh & ~fails).alias("kept"), total("n", fresh & fails).alias("removed"),
                  total("n", ~fresh & fails).alias("redundant"), total("n", mask == bit).alias("unique_fails"),
                  total("good", fresh & fails).alias("good_lost"), total("bad", fresh & fails).alias("toxic_lost")))
    return table.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                        "toxic_lost", F.sum("removed").over(Window.partitionBy("part", "bit")).alias("shapley"))
