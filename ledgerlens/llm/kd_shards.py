"""Sharding by a k-d tree over document metadata.

Every text is a point whose coordinates are its metadata: labels (their first bytes
after what all labels share, as an integer) and numbers. A node that is to hold
several shards is cut along the dimension in which it is widest (against the width
of the whole table) at its weighted median, where the weight of a row is its bytes;
a node of an odd number of shards is cut in proportion. Rows of one coordinate are
ordered by a hash of their text, then by row, so that a cut exists inside any hot
value.

The medians are found without sorting: all nodes of a level are searched together,
each round sums the bytes of equal-width bins of what is left of every node's range
and goes on inside the bin that holds the median, until the cut is within ``SLACK``
of the wanted place or between two rows. Only these sums (``BINS`` a level, one row
per bin) and the cuts reach the driver; the rows are read from a narrow table and
meet the cuts of their node, a few a shard, in a broadcast join.

Copies of a text get the smallest value their group has in each dimension, so that
a group is one point; a group no heavier than ``GROUP`` of a shard or than the heaviest
row is never cut.

Defined cases: a null text has one byte (like an empty one) and the checksum of no
bytes; null labels and numbers sort before all others; rows that repeat, and ids
that do, are rows of their own; more shards than rows leave shards empty; an empty
table gives no rows. Columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import temporary_tables, written

#: part of a shard's bytes by which a cut may miss the median without further search
SLACK = 1 / 256
#: part of a shard's bytes up to which copies of one text stay together
GROUP = 1 / 32
#: a group of copies is hot from HOT_COPIES rows, or the MAX_HOT-th part of all rows, on
HOT_COPIES, MAX_HOT = 64, 100_000
#: bins of a round, shared by the nodes of a level (each has MIN_BINS at least)
BINS, MIN_BINS = 32768, 16
#: bytes of a label that make its coordinate
LABEL_BYTES = 7
_CUTS = "node long, dim int, cv long, ch long, cr long"
_OPEN = "node long, dim int, stage int, v long, h long, lo long, hi long, width long"


def _label_coordinates(docs: DataFrame, labels: Sequence[str]) -> list[Column]:
    """Order-preserving integers of the bytes after the beginning that all labels share."""
    if not labels:
        return []
    ends = docs.agg(*[f(F.encode(F.col(c).cast("string"), "utf-8")).alias(f"{f.__name__}{i}")
                      for i, c in enumerate(labels) for f in (F.min, F.max)]).first()
    out = []
    for i, c in enumerate(labels):
        low, high = bytes(ends[2 * i] or b""), bytes(ends[2 * i + 1] or b"")
        shared = next((n for n, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        part = F.hex(F.substring(F.encode(F.col(c).cast("string"), "utf-8"), shared + 1, LABEL_BYTES))
        out.append(F.coalesce(F.conv(F.rpad(part, 2 * LABEL_BYTES, "0"), 16, 10).cast("long"), F.lit(-1)))
    return out


def points(docs: DataFrame, labels: Sequence[str], numbers: Sequence[Column], id_col: str = "doc_id",
           text_col: str = "text") -> tuple[DataFrame, int]:
    """The narrow table (doc_id, size, text_crc32, h, row, node 1, c0, c1, ...) and its number of dimensions."""
    raw = F.coalesce(F.encode(F.col(text_col).cast("string"), "utf-8"), F.lit(b""))
    least = F.lit(-(1 << 62))
    dims = _label_coordinates(docs, labels) + [F.coalesce(x.cast("long"), least) for x in numbers]
    names = [f"c{i}" for i in range(len(dims))]
    rows = written(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.shiftrightunsigned(F.xxhash64(raw), 1).alias("h"),
        F.monotonically_increasing_id().alias("row"), *[d.alias(n) for n, d in zip(names, dims)]), "kd-rows")
    key, own = ["h", "size", "text_crc32"], [F.col(n) for n in names]
    differ = reduce(lambda a, b: a | b, [F.col(f"g_{n}") != F.col(f"x_{n}") for n in names], F.lit(False))
    hot = F.col("copies") >= max(HOT_COPIES, rows.count() // MAX_HOT)
    groups = written(rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("copies"), *[F.min(n).alias(f"g_{n}") for n in names],
        *[F.max(n).alias(f"x_{n}") for n in names]).filter(hot | differ)
        .select(*key, *[f"g_{n}" for n in names], hot.alias("hot")), "kd-groups")
    # MAX_HOT groups at most are hot; their rows meet them without a shuffle, all others are small groups
    known = rows.join(F.broadcast(groups.filter("hot")), key, "left")
    rest = known.filter(F.col("hot").isNull()).select(*rows.columns).join(groups.filter(~F.col("hot")), key, "left")
    kept = [*[F.col(c) for c in ("doc_id", "size", "text_crc32", "h", "row")], F.lit(1).cast("long").alias("node")]
    both = known.filter("hot").select(*kept, *[F.col(f"g_{n}").alias(n) for n in names]).union(
        rest.select(*kept, *[F.coalesce(F.col(f"g_{n}"), c).alias(n) for n, c in zip(names, own)]))
    return written(both, "kd-points"), len(names)


def _placed(at: DataFrame, cuts: DataFrame, dims: int) -> DataFrame:
    """Rows of the cut nodes move to the left (2 node) or the right child (2 node + 1)."""
    v = _coordinate(dims)
    right = ((v > F.col("cv")) | ((v == F.col("cv")) & ((F.col("h") > F.col("ch"))
             | ((F.col("h") == F.col("ch")) & (F.col("row") >= F.col("cr"))))))
    return (at.join(F.broadcast(cuts), "node", "left")
            .withColumn("node", F.when(F.col("dim").isNull(), F.col("node")).otherwise(2 * F.col("node") + right.cast("long")))
            .drop("dim", "cv", "ch", "cr"))


def _coordinate(dims: int) -> Column:
    return F.element_at(F.array(*[F.col(f"c{i}") for i in range(dims)]), F.col("dim") + 1)


class _Search:
    """The search for one node's cut: the key (coordinate, hash, row) is refined part by part."""

    def __init__(self, node: int, dim: int, want: float, low: int, high: int) -> None:
        self.node, self.dim, self.want = node, dim, want
        self.stage, self.fixed, self.before = 0, [], 0
        self.low, self.high = low, high
        self.cut: tuple[int, int, int] | None = None

    def _cut_at(self, key: int) -> None:
        """Rows whose current part is ``key`` or more go to the right."""
        self.cut = tuple([*self.fixed, key, -1, -1][:3])

    def row(self, bins: int) -> tuple:
        fixed = [*self.fixed, 0, 0][:2]
        return (self.node, self.dim, self.stage, *fixed, self.low, self.high, (self.high - self.low) // bins + 1)

    def step(self, bins: list[tuple[int, int, int]], slack: float, group: float) -> None:
        """Go on with the (bytes, least, greatest) of the bins in order."""
        for size, least, greatest in bins:
            after = self.before + size
            if after < self.want:
                self.before = after
                continue
            to_left, to_right = self.want - self.before, after - self.want
            if least == greatest and (self.stage == 2 or self.stage == 1 and size <= group):
                return self._cut_at(least if to_left <= to_right else least + 1)
            if min(to_left, to_right) <= slack:
                return self._cut_at(least if to_left <= to_right else greatest + 1)
            if least < greatest:
                self.low, self.high = least, greatest
            else:
                self.fixed.append(least)
                self.stage, self.low, self.high = self.stage + 1, None, None
            return None
        return self._cut_at(bins[-1][2] + 1)  # every row is on the left


def tree(at: DataFrame, dims: int, shards: int) -> tuple[list[DataFrame], dict[int, int]]:
    """The cuts of every level and the shard of every leaf node."""
    spark = at.sparkSession
    leaves, done, levels = {1: shards}, {}, []
    spread: list[int] = []
    leaf, whole = 0.0, 0.0
    while True:
        splitting = {n: k for n, k in leaves.items() if k > 1}
        done |= {n: k for n, k in leaves.items() if k == 1}
        if not splitting:
            break
        ranges = at.groupBy("node").agg(F.sum("size"), F.max("size"), *[f(f"c{i}") for i in range(dims) for f in (F.min, F.max)]).collect()
        leaves, searches = {}, []
        for r in ranges:
            if r[0] not in splitting:
                continue
            node, total, k = r[0], r[1], splitting.pop(r[0])
            width = [r[4 + 2 * i] - r[3 + 2 * i] for i in range(dims)]
            if not levels:
                spread, leaf = [max(1, w) for w in width], total / shards
                whole = max(GROUP * leaf, r[2])
            dim = max(range(dims), key=lambda i: (width[i] / spread[i], -i))
            searches.append(_Search(node, dim, total * (k // 2) / k, r[3 + 2 * dim], r[4 + 2 * dim]))
            leaves |= {2 * node: k // 2, 2 * node + 1: k - k // 2}
        for node, k in splitting.items():  # nodes without rows
            leaves |= {2 * node: k // 2, 2 * node + 1: k - k // 2}
        if not searches:
            levels.append(spark.createDataFrame([], _CUTS))
            continue
        while any(s.cut is None for s in searches):
            _round(at, dims, [s for s in searches if s.cut is None], SLACK * leaf, whole)
        levels.append(spark.createDataFrame([(s.node, s.dim, *s.cut) for s in searches], _CUTS))
        at = _placed(at, levels[-1], dims)
    top = max((n.bit_length() for n in done), default=1)
    order = sorted(done, key=lambda n: n << (top - n.bit_length()))
    return levels, {n: i for i, n in enumerate(order)}


def _round(at: DataFrame, dims: int, searches: list[_Search], slack: float, group: float) -> None:
    """One refinement of all open searches of a level."""
    spark = at.sparkSession
    bins = max(MIN_BINS, BINS // len(searches))
    unknown = [s for s in searches if s.low is None]  # a part of the key has just been fixed: any value may follow
    for s in unknown:
        s.low, s.high = 0, (1 << 63) - 1
    known = spark.createDataFrame([s.row(bins) for s in searches], _OPEN)
    rows = (at.join(F.broadcast(known.withColumnsRenamed({"h": "fh", "v": "fv"})), "node")
            .withColumn("v", _coordinate(dims))
            .filter((F.col("stage") == 0) | (F.col("v") == F.col("fv")))
            .filter((F.col("stage") < 2) | (F.col("h") == F.col("fh")))
            .withColumn("key", F.when(F.col("stage") == 0, F.col("v")).when(F.col("stage") == 1, F.col("h"))
                        .otherwise(F.col("row")))
            .filter(F.col("key").between(F.col("lo"), F.col("hi")))
            .groupBy("node", F.expr("(key - lo) div width").alias("bin"))
            .agg(F.sum("size"), F.min("key"), F.max("key")).collect())
    found: dict[int, list] = {}
    for node, bin_no, *sums in rows:
        found.setdefault(node, []).append((bin_no, tuple(sums)))
    for s in searches:
        s.step([sums for _, sums in sorted(found[s.node])], slack, group)


def shard(docs: DataFrame, labels: Sequence[str] = (), numbers: Sequence[Column] = (), shards: int | None = None,
          target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    The number of shards is given, or follows from the bytes a shard should hold.
    """
    spark = docs.sparkSession
    with temporary_tables(spark) as tables:
        at, dims = points(docs, labels, numbers, id_col, text_col)
        tables.keep(at)
    if shards is None:
        total = at.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    levels, leaf_of = tree(at, dims, shards)
    for cuts in levels:
        at = _placed(at, cuts, dims)
    leaves = spark.createDataFrame(list(leaf_of.items()), "node long, shard int")
    # a slot is the row's place in its input split's part of the shard, after the parts of earlier splits
    placed = at.join(F.broadcast(leaves), "node").withColumn("split", F.shiftright("row", 33))
    earlier = Window.partitionBy("shard").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    parts = (placed.groupBy("shard", "split").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n"))
    inside = Window.partitionBy("shard", "split").orderBy("row")
    return (placed.withColumn("place", F.row_number().over(inside) - 1).join(parts, ["shard", "split"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first") + F.col("place")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
