"""Near-duplicate groups by SuperMinHash, banding, exact verification and union-find.

A document's set holds its distinct word shingles (A-Z lower-cased; a text with
fewer words than a shingle has them all as one). Two documents are linked if
``100 * |A and B| >= percent * |A or B|``. Steps:

1. Sketch. Every task hashes the shingles of its split. SuperMinHash: an element
   draws a random permutation of the signature slots, one slot per round; in round j
   its value there is ``j + fraction``, and a slot keeps its least value. Values of a
   later round cannot beat those of an earlier one, so a document stops after the
   round in which its last slot was filled. Bands of the signature are hashed.
2. Documents with the same set (128-bit sum and size) are one node, numbered in the
   order of their smallest ids, so that the smallest node of a group has its smallest id.
3. Nodes that share a band meet at the smallest node of the band's bucket (hub). Pairs
   whose sizes rule a link out, or whose signatures agree in fewer slots than any
   linked pair plausibly would, go; the rest is verified on the full shingle sets.
4. Verified links are joined into components: union-find inside each task leaves a
   forest, and rounds of hooking to the smallest neighbour finish it.
5. Buckets in which documents of different components remain are compared across
   components, large ones block by block with the sets at hand, so that a task
   returns links and no candidate pairs. Every pair that shares a band is then
   linked, tested or in one component, and step 4 runs again. No bucket is capped.

Only hashes, ids and the sets of candidate documents are shuffled. Which documents
are candidates is told to the scan of the texts by a Bloom filter of bounded size;
its false positives cost work but change nothing.

Defined cases: null or empty texts have no shingles and are linked with nothing; a
null id is taken as -1; different texts under one id are different documents, so two
groups may have the same ``component_id``, the id of each one's representative;
repeated rows are copies of each other and each is returned; an empty table gives no
rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import (
    free_names, seeded, slices, temporary_tables, text_bytes, word_hashes, word_spans, written)

SHINGLE = 5
PERCENT = 80
#: 40 bands of 6: a pair of similarity 0.8 shares none with a probability of 5e-6,
#: one of similarity 0.05 shares one with 6e-7
SLOTS = 240
BAND_ROWS = 6
#: share of equal signature slots under which a pair is not verified (a pair of
#: similarity 0.8 has 192 of 240 with a deviation of 6.2; 0.62 is 149)
LEAST_AGREEMENT = 0.62
BLOOM_BITS = (1 << 20, 1 << 26)
#: shingles of the documents of one block of a bucket (on average)
BLOCK_SHINGLES = 100_000
#: buckets up to this size are compared by a plain self-join
SMALL_BUCKET = 16
_BLOOM_SEEDS = (101, 102)
#: what tells documents of one id apart
SET_OF_ID = ["doc_id", "f1", "f2", "n"]


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, and the n+1 offsets of the rows."""
    n_rows = len(offsets) - 1
    starts, ends, rows = word_spans(data, offsets)
    words = word_hashes(data, starts, ends, lower=True)
    count = np.bincount(rows, minlength=n_rows)
    value = np.zeros(len(words), np.uint64)
    for j in range(k):  # a word takes part as number j of the shingle that begins j words earlier
        shifted = np.zeros(len(words), np.uint64)
        if j < len(words):
            same = np.zeros(len(words), bool)
            same[:len(words) - j] = rows[j:] == rows[:len(words) - j]
            shifted[:len(words) - j] = seeded(words[j:], j)
            shifted[~same] = 0
        value = seeded(value + shifted, 31)
    first = np.concatenate([[0], np.cumsum(count)[:-1]]) if n_rows else np.zeros(0, np.int64)
    within = np.arange(len(words)) - first[rows]
    keep = within < np.maximum(count[rows] - k + 1, 1)
    value, rows = value[keep], rows[keep]
    order = np.lexsort((value, rows))
    value, rows = value[order], rows[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
    value, rows = value[new], rows[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n_rows))]).astype(np.int64)


def superminhash(values: np.ndarray, offsets: np.ndarray, slots: int) -> np.ndarray:
    """Signatures (rows x slots, uint64: round in the high half, fraction in the low) of element hashes.

    The slot an element draws in round j is what a Fisher-Yates shuffle of the slots
    would put at place j; it is found by tracing the earlier swaps backwards.
    """
    n_rows = len(offsets) - 1
    empty = np.iinfo(np.uint64).max
    sig = np.full((n_rows, slots), empty, np.uint64)
    rows = np.repeat(np.arange(n_rows), np.diff(offsets))
    swaps: list[np.ndarray] = []  # per round, the place each element swapped with
    for j in range(slots):
        if not len(values):
            break
        h = seeded(values, j)
        swap = (((h >> np.uint64(32)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int16) + np.int16(j)
        slot = swap
        for i in range(j - 1, -1, -1):
            slot = np.where(slot == swaps[i], np.int16(i), slot)
        swaps.append(swap)
        np.minimum.at(sig.reshape(-1), rows * slots + slot,
                      (np.uint64(j) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF)))
        more = (sig == empty).any(axis=1)[rows]  # early stop: later rounds cannot improve a full signature
        if not more.all():
            values, rows = values[more], rows[more]
            swaps = [x[more] for x in swaps]
    return sig


def signature_bands(sig: np.ndarray, band_rows: int) -> np.ndarray:
    """One 64-bit key per band (rows x bands); equal only for the same band."""
    n, slots = sig.shape
    out = np.zeros((n, slots // band_rows), np.uint64)
    for band in range(slots // band_rows):
        key = np.full(n, np.uint64(band), np.uint64)
        for c in range(band * band_rows, (band + 1) * band_rows):
            key = seeded(key + sig[:, c], 7)
        out[:, band] = key
    return out


def _set_sums(values: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """Two 64-bit sums over the hashed set of every row; with its size they stand for the set."""
    sums = []
    for seed in (201, 202):
        total = np.concatenate([[np.uint64(0)], np.cumsum(seeded(values, seed), dtype=np.uint64)])
        sums.append(pa.array((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64)))
    return sums


def _sketch_task(k: int, slots: int, band_rows: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
                        ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, offsets = shingle_hashes(*text_bytes(part.column("text")), k)
                sizes = np.diff(offsets)
                sig = superminhash(values, offsets, slots)
                bands = signature_bands(sig, band_rows)
                # only whether values are equal matters; a byte of chance raises agreement by 1/256
                short = (seeded(sig, 9) >> np.uint64(56)).astype(np.uint8)
                at = np.arange(len(sizes) + 1, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(sizes, pa.int64()), *_set_sums(values, offsets),
                    pa.array([r.tobytes() for r in short], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(at * bands.shape[1], pa.int32()),
                                             pa.array(bands.reshape(-1).view(np.int64)))], schema=schema)

    return run


def _agree_task(slots: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, slots)
                    for c in ("sig_a", "sig_b"))
            keep = (a == b).sum(axis=1) >= least * slots
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _verify_task(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets_task(k: int, bits: np.ndarray, n_bits: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
                        ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = _in_bloom(batch.column("doc_id"), bits, n_bits)
            if not keep.any():
                continue
            for part in slices(batch.filter(pa.array(keep)), "text"):
                values, offsets = shingle_hashes(*text_bytes(part.column("text")), k)
                raw = values.tobytes()
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), *_set_sums(values, offsets),
                    pa.array([raw[8 * i:8 * j] for i, j in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())],
                    schema=schema)

    return run


def _bloom_task(n_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            at = np.concatenate([seeded(ids, s) & np.uint64(n_bits - 1) for s in _BLOOM_SEEDS])
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(5)).astype(np.int64)),
                 pa.array((np.uint64(1) << (at & np.uint64(31))).astype(np.int64))], names=["word", "bit"])

    return run


def _bloom(ids: DataFrame) -> tuple[np.ndarray, int]:
    """Bloom filter over ``doc_id`` as words of 32 bits: of bounded size, whatever the number of ids."""
    low, high = BLOOM_BITS
    n_bits = min(high, max(low, 1 << (16 * max(1, ids.count())).bit_length()))
    words = (ids.mapInArrow(_bloom_task(n_bits), "word long, bit long")
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas())  # at most n_bits / 32 rows
    bits = np.zeros(n_bits // 32, np.uint64)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return bits, n_bits


def _in_bloom(column: pa.Array, bits: np.ndarray, n_bits: int) -> np.ndarray:
    ids = column.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    out = np.ones(len(ids), bool)
    for seed in _BLOOM_SEEDS:
        at = seeded(ids, seed) & np.uint64(n_bits - 1)
        out &= (bits[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)) & np.uint64(1)) == 1
    return out


def _candidate_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, f1, f2, shingles) of the documents with a wanted id, and perhaps of a few others."""
    return docs.mapInArrow(_sets_task(k, *_bloom(ids)), "doc_id long, n long, f1 long, f2 long, shingles binary")


class _UnionFind:
    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.setdefault(root, root)) != root:
            root = up
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _forest_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find inside a task: every node once, with the smallest node it is joined to."""
    for batch in batches:
        uf = _UnionFind()
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            uf.union(a, b)
        pairs = [(uf.find(x), x) for x in uf.parent if uf.find(x) != x]
        if pairs:
            a, b = zip(*pairs, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _edge_state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    Each task first reduces its links to a forest by union-find. Then large-star and
    small-star rounds alternate: every node ties its larger neighbours, then its
    smaller ones, to its smallest neighbour, until the links stay as they are: one
    from each node to its component.
    """
    def star(edges: DataFrame, key: str, other: str, name: str) -> tuple[DataFrame, DataFrame]:
        least = written(edges.groupBy(key).agg(F.min(other).alias("root")), name)
        return least, edges.join(least, key)

    links = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .mapInArrow(_forest_task, "a long, b long").distinct(), "links")
    state = _edge_state(links)
    while state[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        _, tied = star(both, "a", "b", "least")
        large = written(tied.where("b > a").select(F.least("a", "root").alias("a"), "b").distinct(), "links")
        least, tied = star(large, "b", "a", "least")
        links = written(least.select(F.col("root").alias("a"), "b").union(
            tied.where("a <> root").select(F.col("root").alias("a"), F.col("a").alias("b"))).distinct(), "links")
        before, state = state, _edge_state(links)
        if state == before:
            break
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def _blocks_task(percent: int, least: float):
    """Links between different components inside one cell: a block of all documents of a
    bucket beside a block of those outside the component of its hub.

    Two documents outside it meet in two cells; the one with the smaller node asks.
    A pair is looked at only in the first bucket that both documents share, and
    its full sets are compared if the signatures agree enough.
    """
    def run(table: pa.Table) -> pa.Table:
        def wide(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(name).to_pylist()), kind).reshape(table.num_rows, -1)

        node, comp, outside = (table.column(c).to_numpy(zero_copy_only=False) for c in ("node", "comp", "outside"))
        sig = wide("sig", np.uint8)
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        size = np.array([len(x) for x in sets])
        key, main = (table.column(c)[0].as_py() for c in ("key", "main"))
        ask, told = np.flatnonzero(outside), np.flatnonzero(~outside)
        here = int(np.flatnonzero(bands[0] == key)[0])
        out_a, out_b = [], []
        for x in ask.tolist():
            other = told[(comp[told] != comp[x]) & ((comp[told] == main) | (node[told] > node[x]))]
            other = other[100 * np.minimum(size[other], size[x]) >= percent * np.maximum(size[other], size[x])]
            other = other[(sig[other] == sig[x]).sum(axis=1) >= least * sig.shape[1]]
            other = other[(bands[other, :here] != bands[x, :here]).all(axis=1)]
            if not len(other):
                continue
            values = np.concatenate([sets[i] for i in other.tolist()])
            at = np.searchsorted(sets[x], values).clip(max=size[x] - 1)
            common = np.bincount(np.repeat(np.arange(len(other)), size[other]),
                                 weights=sets[x][at] == values, minlength=len(other)).astype(np.int64)
            other = other[100 * common >= percent * (size[x] + size[other] - common)]
            out_a += [int(node[x])] * len(other)
            out_b += node[other].tolist()
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return run


class NearDuplicates:
    """The tables of one run over (doc_id, text); every table is written to the shared folder."""

    def __init__(self, docs: DataFrame, shingle: int, percent: int) -> None:
        self.docs, self.shingle, self.percent = docs, shingle, percent
        self.sketch = written(docs.mapInArrow(
            _sketch_task(shingle, SLOTS, BAND_ROWS),
            "doc_id long, n long, f1 long, f2 long, sig binary, bands array<long>"), "sketch")
        self.same = self._same_set()

    def _same_set(self) -> DataFrame:
        """(f1, f2, n, doc_id, node): the smallest id and the number of every shingle set, both in one order."""
        least = self.sketch.where("n > 0").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("doc_id"))
        return written(least.orderBy("doc_id", "f1", "f2", "n").withColumn("node", F.monotonically_increasing_id()), "sets")

    def _agreeing(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """Pairs whose sizes and signatures allow a link."""
        info = nodes.select("node", "n", "sig")
        a = info.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a"))
        b = info.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"))
        return (pairs.join(b, "b").join(a, "a")
                .where(100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b"))
                .select("a", "b", "sig_a", "sig_b").mapInArrow(_agree_task(SLOTS, LEAST_AGREEMENT), "a long, b long"))

    def _sets(self, nodes: DataFrame) -> DataFrame:
        """(node, shingles) of the wanted nodes."""
        wanted = written(nodes.join(self.same, "node"), "wanted")
        return written(_candidate_sets(self.docs, wanted.select("doc_id"), self.shingle).join(wanted, SET_OF_ID)
                       .dropDuplicates(SET_OF_ID).select("node", "shingles"), "shingles")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs that the full shingle sets confirm."""
        sets = self._sets(written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted"))
        return written(
            pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
            .select("a", "b", "set_a", "set_b").mapInArrow(_verify_task(self.percent), "a long, b long"), "linked")

    def _across(self, entries: DataFrame, joined: DataFrame, nodes: DataFrame) -> DataFrame:
        """Links inside buckets between different components (hub pairs are tested already)."""
        held = written(entries.join(joined, "node", "left")
                       .select("key", "hub", "node", "n", F.coalesce("component", "node").alias("comp")), "held")
        # per component first, so that the hub's and what is outside it are told apart without a join
        of_hub = F.col("hub_here") == 1
        mixed = written(held.groupBy("key", "comp").agg(
            F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"),
            F.max((F.col("node") == F.col("hub")).cast("int")).alias("hub_here"))
            .groupBy("key").agg(F.sum("size").alias("size"), F.sum("shingles").alias("shingles"), F.count(F.lit(1)).alias("comps"),
                                F.max(F.when(of_hub, F.col("comp"))).alias("main"),
                                F.sum(F.when(of_hub, 0).otherwise(F.col("shingles"))).alias("asked"))
            .where("comps > 1 and size > 2").drop("comps"), "mixed")
        held = written(held.where("node <> hub").join(mixed, "key").select("key", "node", "comp", "size", "shingles", "asked", "main"),
                       "held")
        small = held.where(F.col("size") <= SMALL_BUCKET).select("key", "node", "comp")
        pairs = (small.select("key", F.col("node").alias("a"), F.col("comp").alias("comp_a"))
                 .join(small.select("key", F.col("node").alias("b"), F.col("comp").alias("comp_b")), "key")
                 .where("a < b and comp_a <> comp_b").select("a", "b").distinct())
        links = self._verified(written(self._agreeing(pairs, nodes), "near"))
        large = held.where(F.col("size") > SMALL_BUCKET)
        if large.isEmpty():
            return links
        whole = (self._sets(written(large.select("node").distinct(), "wanted"))
                 .join(nodes.select("node", "sig", "bands"), "node"))
        # every pair of different components has a document outside the hub's: those meet all others
        large = large.select(
            "key", "node", "comp", "main", *[F.greatest(F.lit(1), F.ceil(F.col(c) / BLOCK_SHINGLES)).cast("int").alias(p)
                                             for c, p in (("asked", "blocks_i"), ("shingles", "blocks_j"))])

        def dealt(rows: DataFrame, own: str, other: str, outside: bool) -> DataFrame:
            """Rows in their own block, once for every block of the other side."""
            return (rows.withColumn(own, F.pmod(F.xxhash64("node"), F.col(f"blocks_{own}")).cast("int"))
                    .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"blocks_{other}") - 1)))
                    .select("key", "i", "j", "node", "comp", "main", F.lit(outside).alias("outside")))
        cells = dealt(large, "j", "i", False).union(dealt(large.where(F.col("comp") != F.col("main")), "i", "j", True))
        found = (cells.join(whole, "node").groupBy("key", "i", "j")
                 .applyInArrow(_blocks_task(self.percent, LEAST_AGREEMENT), "a long, b long")
                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        return written(links.union(found).distinct(), "linked")

    def groups(self) -> DataFrame:
        """(doc_id, n_shingles, component_id, kept, f1, f2) of every row, read from two tables that stay."""
        with temporary_tables(self.docs.sparkSession) as tables:
            sets = self._set_components()
            tables.keep(sets)
        own = F.coalesce("component_id", "doc_id")
        return self.sketch.select("doc_id", "n", "f1", "f2").join(sets, ["f1", "f2", "n"], "left").select(
            "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"),
            (F.coalesce("root", F.lit(True)) & (F.col("doc_id") == own)).alias("kept"), "f1", "f2")

    def _set_components(self) -> DataFrame:
        """(f1, f2, n, component_id, root) of every shingle set."""
        same = self.same
        nodes = written(self.sketch.join(same, SET_OF_ID).dropDuplicates(SET_OF_ID).select("node", "n", "sig", "bands"),
                        "nodes")
        entries = nodes.select("node", "n", F.explode("bands").alias("key"))
        hubs = written(entries.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size"))
                       .where("size > 1").select("key", "hub"), "hubs")
        entries = written(entries.join(hubs, "key"), "entries")
        near = written(self._agreeing(entries.where("node <> hub").select(
            F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), nodes), "near")
        links = self._verified(near)
        joined = written(components(links), "joined")
        extra = self._across(entries, joined, nodes)
        if not extra.isEmpty():
            joined = written(components(links.union(extra)), "joined")
        roots = same.select(F.col("node").alias("component"), F.col("doc_id").alias("component_id"))
        sets = same.join(joined.join(roots, "component"), "node", "left").select(
            "f1", "f2", "n", F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce(F.col("component") == F.col("node"), F.lit(True)).alias("root"))
        return written(sets, "set-components")


def _groups(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    picked = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("doc_id"),
                         F.col(text_col).cast("string").alias("text"))
    return NearDuplicates(picked, shingle, percent).groups()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Kept are the rows that have the group's smallest id (``component_id``) and, if
    the group has several sets under that id, the first of these sets.
    """
    return _groups(docs, shingle, percent, id_col, text_col).drop("f1", "f2")


def keep_representatives(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The rows of one document of every group, its smallest id, with all their columns.

    Rows that repeat both the id and the set (the text, if it has no shingles) are
    told apart by nothing else, so one of them stays. A Bloom filter over the ids
    that are dropped, and one over those that are repeated, let all other rows pass
    where they are read; only the rows they hold are shuffled to the exact joins,
    those of repeated ids by id and set.
    """
    with temporary_tables(docs.sparkSession) as tables:
        found = written(_groups(docs, shingle, percent, id_col, text_col).withColumnRenamed("n_shingles", "n"), "groups")
        tables.keep(found)
    touched = written(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max("kept").alias("kept"))
                      .where("rows > 1 or not kept"), "touched")
    names = docs.columns
    gone_id, row_id, bare, n, f1, f2 = free_names(names, "_dropped", "_id", "_bare", "_n", "_f1", "_f2")
    dropped = touched.where("not kept").select(F.col("doc_id").alias(gone_id))
    repeated = touched.where("rows > 1 and kept").select("doc_id")
    drops, again = _bloom(dropped.withColumnRenamed(gone_id, "doc_id")), _bloom(repeated)

    def rows(held: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(id_col).cast(pa.int64())
                twice, gone = _in_bloom(ids, *again), _in_bloom(ids, *drops)
                yield batch.filter(pa.array({"repeated": twice, "dropped": gone & ~twice, "none": ~gone & ~twice}[held]))

        return docs.mapInArrow(run, docs.schema)

    own_id = F.coalesce(F.col(id_col).cast("long"), F.lit(-1))
    left = rows("none").union(rows("dropped").join(dropped, own_id == F.col(gone_id), "left_anti"))
    if repeated.isEmpty():
        return left

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                values, offsets = shingle_hashes(*text_bytes(part.column(text_col)), shingle)
                sums = [pa.array(np.diff(offsets), pa.int64()), *_set_sums(values, offsets)]
                yield pa.RecordBatch.from_arrays([*part.columns, *sums], names=[*part.schema.names, n, f1, f2])

    fields = [T.StructField(c, T.LongType()) for c in (n, f1, f2)]
    maybe = (rows("repeated").mapInArrow(with_sets, T.StructType([*docs.schema.fields, *fields]))
             .withColumn(row_id, own_id).withColumn(bare, F.when(F.col(n) == 0, F.col(text_col))))
    maybe = maybe.dropDuplicates([row_id, f1, f2, n, bare])
    wanted = free_names([*names, row_id, bare, n, f1, f2], *[f"_kept_{c}" for c in SET_OF_ID])
    keys = found.where("kept").select(*[F.col(c).alias(k) for c, k in zip(SET_OF_ID, wanted)]).distinct()
    same = [F.col(a) == F.col(k) for a, k in zip((row_id, f1, f2, n), wanted, strict=True)]
    return left.union(maybe.join(keys, same, "left_semi").select(*[F.col(f"`{c}`") for c in names]))
