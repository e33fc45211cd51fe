"""Exact distinct counts and key differences of integer columns by bitmap words.

A value is bit ``value mod 64`` of word ``value div 64``. Words are merged by
``bit_or``: a fixed-width state that combines map-side in a hash aggregate, in any
order, and that adds up across groups, so one scan gives the distinct counts of
every group and of every coarser one. Dense keys shrink to one row per 64 values;
sparse keys cost no more than the distinct values themselves, so there is no limit
and no switch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import materialize

WORD, BITS = "_ll_word", "_ll_bits"


def is_integer(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def word_of(value: Column) -> Column:
    return F.shiftright(value.cast("long"), 6)


def bit_of(value: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), value.cast("long").bitwiseAND(F.lit(63)).cast("int"))


def words(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, word, bits) of the non-null values."""
    v = F.col(value)
    return (df.filter(v.isNotNull()).groupBy(*groups, word_of(v).alias(WORD))
            .agg(F.bit_or(bit_of(v)).alias(BITS)))


def merged(bits: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Words of coarser groups."""
    return bits.groupBy(*groups, WORD).agg(F.bit_or(BITS).alias(BITS))


def counted(bits: DataFrame, groups: Sequence[str] = (), name: str = "n_distinct") -> DataFrame:
    """Distinct values per group; without groups one row, 0 for no values."""
    total = F.coalesce(F.sum(F.bit_count(BITS)), F.lit(0)).cast("long").alias(name)
    return bits.groupBy(*groups).agg(total) if groups else bits.agg(total)


def distinct_counts(df: DataFrame, columns: Mapping[str, str], rows: str | None = None,
                    groups: Sequence[str] = ()) -> DataFrame:
    """The distinct values of several integer columns (name -> column), from one scan:
    one row, or with ``groups`` one per group.

    ``rows`` names a count of all rows; without it a group that holds no value has no row.
    """
    parts = [F.struct(F.lit(i).alias("i"), word_of(F.col(c)).alias(WORD), bit_of(F.col(c)).alias(BITS))
             for i, c in enumerate(columns.values())]
    if rows:  # one word that counts its rows
        parts.append(F.struct(F.lit(-1).alias("i"), F.lit(0).cast("long").alias(WORD), F.lit(0).cast("long").alias(BITS)))
    each = df.select(*groups, F.explode(F.array(*parts)).alias("_ll_p"))
    state = (each.filter(F.col(f"_ll_p.{WORD}").isNotNull()).groupBy(*groups, F.col("_ll_p.i").alias("_ll_i"), F.col(f"_ll_p.{WORD}"))
             .agg(F.bit_or(f"_ll_p.{BITS}").alias(BITS), F.count(F.lit(1)).alias("_ll_n")))
    out = [F.coalesce(F.sum(F.when(F.col("_ll_i") == i, F.bit_count(BITS))), F.lit(0)).cast("long").alias(n)
           for i, n in enumerate(columns)]
    if rows:
        out.insert(0, F.coalesce(F.sum(F.when(F.col("_ll_i") == -1, F.col("_ll_n"))), F.lit(0)).alias(rows))
    return state.groupBy(*groups).agg(*out) if groups else state.agg(*out)


def distinct_rollup(df: DataFrame, value: str, dims: Sequence[str], levels: Mapping[str, Sequence[str]],
                    name: str = "n_distinct") -> DataFrame:
    """Distinct values at several levels (name -> subset of ``dims``), from one scan.

    Returns level, dims (null where a level does not have them) and the count. Rows
    without one of the dims count at the levels that do not use it.
    """
    base = materialize(words(df, value, dims))  # read once per level
    out = None
    for level, kept in levels.items():
        bits = base
        for c in kept:
            bits = bits.filter(F.col(c).isNotNull())
        one = counted(merged(bits, kept), kept, name)
        one = one.select(F.lit(level).alias("level"), *[
            (F.col(c) if c in kept else F.lit(None).cast(base.schema[c].dataType)).alias(c) for c in dims], name)
        out = one if out is None else out.unionByName(one)
    return out


def key_differences(checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Per check (name, child, key, parent, key): distinct child keys, those the parent lacks,
    and whether there is a null child key. Each table is scanned once, whatever it is used for.

    What is shuffled is one word per 64 keys, at most one per key.
    """
    by_table: dict[int, tuple[DataFrame, list]] = {}
    for i, (_, child, key, parent, parent_key) in enumerate(checks):
        by_table.setdefault(id(child), (child, []))[1].append((i, True, key))
        by_table.setdefault(id(parent), (parent, []))[1].append((i, False, parent_key))
    each = None
    for table, uses in by_table.values():
        parts = []
        for i, is_child, key in uses:
            v, none = F.col(key), F.lit(0).cast("long")
            parts.append(F.struct(
                F.lit(i).alias("i"), F.coalesce(word_of(v), none).alias(WORD),
                F.when(v.isNull() | F.lit(not is_child), none).otherwise(bit_of(v)).alias("child"),
                F.when(v.isNull() | F.lit(is_child), none).otherwise(bit_of(v)).alias("parent"),
                F.when(v.isNull() & F.lit(is_child), 1).otherwise(0).alias("nulls")))
        one = (table.select(F.explode(F.array(*parts)).alias("p")).select("p.*").groupBy("i", WORD)
               .agg(F.bit_or("child").alias("child"), F.bit_or("parent").alias("parent"), F.max("nulls").alias("nulls")))
        each = one if each is None else each.unionByName(one)
    state = each.groupBy("i", WORD).agg(F.bit_or("child").alias("child"), F.bit_or("parent").alias("parent"),
                                        F.max("nulls").alias("nulls"))
    lacking = F.bit_count(F.col("child").bitwiseAND(F.bitwise_not("parent")))
    found = state.groupBy("i").agg(F.sum(F.bit_count("child")).cast("long").alias("n_child_keys"),
                                   F.sum(lacking).cast("long").alias("n_orphan_keys"),
                                   F.max("nulls").cast("long").alias("n_null_keys"))
    zero = F.lit(0).cast("long")
    names = found.sparkSession.createDataFrame([(i, c[0]) for i, c in enumerate(checks)], "i int, check_name string")
    return names.join(found, "i", "left").select(
        "check_name", *[F.coalesce(c, zero).alias(c) for c in ("n_child_keys", "n_orphan_keys", "n_null_keys")])
