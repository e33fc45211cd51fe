"""Ranked lexical search by NRA (threshold reading without random access).

Each document becomes one posting row: its id, its number of terms and, for terms
that the items ask for, how often they occur. A block of posting rows is an index
shard: a task turns it into one list per term, sorted by impact, and reads the
lists of an item in step, highest impacts first. After every round a document's
score lies between what was read of it (lower end) and that plus the next unread
impact of each list it has not been met in (upper end). A document whose upper
end is below the k-th lower end is out; reading goes on until every document that
is left has a closed interval, so membership, ties and scores are final. The k-th
score a task has reached carries over to its next shard. The tasks' best k per
item are merged by a salted top-k and a last one.

No list is built for the whole corpus, so a term that every document holds is
spread over all shards. Terms reach the tasks as 64-bit hashes of their lower-cased
bytes. Items are worked off in blocks of bounded size; which documents' terms are
kept is decided by a bitmap of fixed size.

Defined cases: a null or empty text (document or item) has no terms; such items and
items no document matches give no rows. Rows of one item id are one item with all
their terms. Every document row is a document: repeated ids each take a rank; equal
scores are ranked by id, a null id last. Empty tables give no rows. Columns other
than ids and texts are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import IS_LETTER, slices, text_bytes, word_hashes, word_spans, written

#: bits of the map of wanted terms
TERM_BITS = 1 << 20
#: item terms and items worked off together
BLOCK_TERMS, BLOCK_ITEMS = 1_000_000, 20_000
#: entries of each list read in the first round; each round reads four times as deep
FIRST_READ = 64
SALTS = 64
_LAST_ID = np.iinfo(np.int64).max


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every term."""
    data, offsets = text_bytes(column)
    starts, ends, rows = word_spans(data, offsets, IS_LETTER)
    return rows, word_hashes(data, starts, ends, lower=True) if len(starts) else np.zeros(0, np.uint64)


def _counted(rows: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) in order, with their counts."""
    order = np.lexsort((terms, rows))
    rows, terms = rows[order], terms[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (terms[1:] != terms[:-1])
    at = np.flatnonzero(first)
    return rows[at], terms[at], np.diff(np.append(at, len(rows)))


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item_id, term)."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows, terms, _ = _counted(*_terms(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("item_id").take(pa.array(rows)), pa.array(terms.view(np.int64))], ["item_id", "term"])
    return (items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(split, "item_id long, term long").distinct())


def postings(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (terms with repeats) and the terms and counts that pass the map of wanted terms."""
    bits = wanted.select(F.col("term").bitwiseAND(F.lit(TERM_BITS - 1)).alias("bit")).distinct().toArrow()
    seen = np.zeros(TERM_BITS, bool)
    seen[bits.column("bit").to_numpy()] = True
    packed = np.packbits(seen)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = np.unpackbits(packed).astype(bool)
        for batch in batches:
            for part in slices(batch, "text"):
                rows, terms = _terms(part.column("text"))
                n = np.bincount(rows, minlength=part.num_rows)
                asked = want[(terms & np.uint64(TERM_BITS - 1)).astype(np.int64)]
                rows, terms, tf = _counted(rows[asked], terms[asked])
                ends = pa.array(np.append(0, np.cumsum(np.bincount(rows, minlength=part.num_rows))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n.astype(np.int64)),
                     pa.ListArray.from_arrays(ends, pa.array(terms.view(np.int64))),
                     pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int64)))], ["doc_id", "n", "terms", "tf"])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(count, "doc_id long, n long, terms array<long>, tf array<long>"))


def _sums(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of integers by row."""
    if float(values.sum(dtype=np.float64)) < 2.0 ** 52:
        return np.bincount(rows, weights=values, minlength=n).astype(np.int64)
    out = np.zeros(n, np.int64)
    np.add.at(out, rows, values)
    return out


def nra(starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray, impacts: np.ndarray, n: int, k: int,
        floor: int = 0, first_read: int = FIRST_READ) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows and final scores of all documents that may be among the best k, and the entries read.

    List j is ``rows[starts[j]:starts[j] + sizes[j]]`` with falling ``impacts``; documents
    below ``floor`` (or 1) are of no interest.
    """
    depth = first_read
    while True:
        read = np.minimum(sizes, depth)
        at = np.repeat(starts - (np.cumsum(read) - read), read) + np.arange(read.sum())
        met = rows[at]
        lower = _sums(met, impacts[at], n)
        more = sizes > read
        ahead = np.zeros(len(sizes), np.int64)  # what an unread entry of each list can add at most
        ahead[more] = impacts[(starts + read)[more]]
        upper = lower + ahead.sum() - _sums(met, np.repeat(ahead, read), n)
        least = max(floor, 1)
        if n >= k:
            least = max(least, int(np.partition(lower, n - k)[n - k]))
        left = np.flatnonzero(upper >= least)
        if not more.any() or (upper[left] == lower[left]).all():
            return left, lower[left], int(read.sum())
        depth *= 4


def _search(batches: Iterator[pa.RecordBatch], items: pa.Table, n_docs: int, n_terms: int, k: int) -> Iterator[pa.RecordBatch]:
    known, of_item = np.unique(items.column("term").to_numpy(), return_inverse=True)
    weight = np.zeros(len(known), np.int64)
    weight[of_item] = items.column("w").to_numpy()
    names, item_no = np.unique(items.column("item_no").to_numpy(), return_inverse=True)
    order = np.argsort(item_no, kind="stable")
    of_item = of_item[order]
    bounds = np.searchsorted(item_no[order], np.arange(len(names) + 1))
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * len(names)
    for batch in batches:
        size = batch.num_rows
        n = batch.column("n").to_numpy()
        ids = batch.column("doc_id")
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(_LAST_ID).to_numpy()
        lists = batch.column("terms")
        rows = np.repeat(np.arange(size), np.diff(lists.offsets.to_numpy()))
        term = lists.flatten().to_numpy()
        tf = batch.column("tf").flatten().to_numpy()
        no = np.minimum(np.searchsorted(known, term), len(known) - 1)
        held = known[no] == term
        rows, no, tf = rows[held], no[held], tf[held]
        m = 100 - 50 + (50 * n * n_docs) // n_terms
        impact = weight[no] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[rows]))
        by = np.lexsort((-impact, no))
        rows, no, impact = rows[by], no[by], impact[by]
        at = np.searchsorted(no, np.arange(len(known) + 1))
        for i in range(len(names)):
            mine = of_item[bounds[i]:bounds[i + 1]]
            starts, sizes = at[mine], at[mine + 1] - at[mine]
            if not sizes.any():
                continue
            score, doc, null = best[i]
            left, found, _ = nra(starts, sizes, rows, impact, size, k, int(score[-1]) if len(score) == k else 0)
            score, doc, null = np.append(score, found), np.append(doc, ids[left]), np.append(null, missing[left])
            top = np.lexsort((null, doc, -score))[:k]
            best[i] = score[top], doc[top], null[top]
    for i, (score, doc, null) in enumerate(best):
        if len(score):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(score), names[i])), pa.array(doc, mask=null), pa.array(score)],
                ["item_no", "doc_id", "score"])


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_col: str = "doc_id", item_col: str = "item_id",
           text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score of the best ``k`` documents of every item."""
    spark = docs.sparkSession
    wanted = written(item_terms(items, item_col, text_col), "search-items")
    index = written(postings(docs, wanted, doc_col, text_col), "search-postings")
    n_docs, n_terms = index.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    df = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ids = Window.orderBy("item_id")  # one row per item id of a block
    sizes = wanted.agg(F.count(F.lit(1)), F.count_distinct(F.coalesce("item_id", F.lit(0)))).first()
    blocks = max(1, -(-sizes[0] // BLOCK_TERMS), -(-sizes[1] // BLOCK_ITEMS))
    weighed = written(
        wanted.join(df, "term").withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
        .withColumn("w", F.floor(1000 * F.log(F.lit(2.0 * (n_docs or 0) + 2) / (2 * F.col("df") + 1))).cast("long"))
        .drop("df"), "search-weights")
    out = []
    for block in range(blocks):
        mine = weighed.filter(F.col("block") == block)
        names = written(mine.select("item_id").distinct().withColumn("item_no", F.row_number().over(ids).cast("long")),
                        "search-names")
        table = (mine.join(names, mine["item_id"].eqNullSafe(names["item_id"]))
                 .select("item_no", "term", "w").toArrow())  # a block: bounded by BLOCK_TERMS on average
        if not table.num_rows:
            continue
        held = spark.sparkContext.broadcast(table)

        def task(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            return _search(batches, held.value, n_docs, n_terms, k)
        found = index.mapInArrow(task, "item_no long, doc_id long, score long")
        out.append(found.join(names, "item_no").drop("item_no"))
    if not out:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = out[0]
    for more in out[1:]:
        found = found.union(more)
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = Window.partitionBy("item_id", "salt").orderBy(*best)
    whole = Window.partitionBy("item_id").orderBy(*best)
    return (found.withColumn("salt", F.pmod(F.hash("doc_id", "score"), F.lit(SALTS)))
            .withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= k)
            .withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
