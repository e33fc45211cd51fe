"""Quality rules: base rules on word statistics, then a hashed n-gram log-likelihood ratio.

Method: lower-cased words and punctuation runs give unigrams and bigrams, hashed
into a fixed number of buckets. Two multinomials over the buckets are counted, one
on all documents (raw) and one on all documents labelled good (target), each smoothed by one
count per bucket. Both are counted in one pass. A document's score is the mean over its n-grams of
``log(p_target / p_raw)``, so length does not matter, and every document whose score
is below the threshold is not kept. Only DataFrame functions are used; the bucket
table is the only thing that reaches the driver, and its size is a parameter.

Words are maximal runs of characters other than space and U+0009..U+000D.

Defined cases: null or empty text has no words, all counts 0, fails the base rules
and scores 0; repeated rows give repeated results; an empty table gives no rows;
without a target row all buckets weigh 0; documents of a repeated id are target each if
the id is labelled good, those without an id never. Columns other than the id and the
text are not read; ``base_counts`` keeps them whatever their names.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import free_names, written

BUCKETS = 8192
THRESHOLD = -0.25
MIN_WORDS = 20
WINDOW = 8
#: bits of the filter over the ids labelled good
FILTER_BITS = 1 << 22
MAX_REPEAT_PCT = 30
_LLR_UNIT = 1_000_000


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _tail(array: Column, start: int) -> Column:
    return F.slice(array, start, F.greatest(F.size(array), F.lit(1)))


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words to the columns of ``docs``.

    Hashes of 8-word windows are made from those of 4, 2 and 1 words. Positions of
    equal windows are found by sorting (hash, position) pairs of one document, and
    only where some hash occurs twice.
    """
    own = docs.columns
    words, lined, hashes, pairs_at, at = free_names(own, "_words", "_lines", "_h", "_sorted", "_at")
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    both = lambda a, b: F.xxhash64(a, b)
    step = docs.select(
        *own, _words(text).alias(words), lines.alias(lined),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"))
    step = step.select(
        *own, "n_symbols", F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.size(lined) - F.size(F.array_distinct(lined))).cast("long").alias("n_dup_lines"),
        F.when(F.size(words) > WINDOW, F.transform(words, lambda w: F.xxhash64(w))).alias(hashes))
    kept = [*own, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    for width in (1, 2, 4):
        step = step.select(*kept, F.zip_with(hashes, _tail(F.col(hashes), width + 1), both).alias(hashes))
    step = step.select(*kept, F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(1))).alias(hashes))
    step = step.select(*kept, F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes),
        F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))).alias(pairs_at))
    pairs = F.zip_with(pairs_at, _tail(F.col(pairs_at), 2),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["at"], b["at"])))
    step = step.select(*kept, F.array_sort(F.array_distinct(F.flatten(
        F.filter(pairs, lambda x: x.isNotNull())))).alias(at))
    covered = F.aggregate(
        F.zip_with(at, _tail(F.col(at), 2), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("long"), lambda acc, x: acc + x)
    return step.select(*kept, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def _gram_rows(docs: DataFrame, buckets: int) -> DataFrame:
    """A row for every token and its follower: buckets ``u`` of the token and ``b`` of the pair (null at the end).

    A document without tokens has one row with nulls.
    """
    own = [c for c in docs.columns if c != "text"]
    tokens = F.regexp_extract_all(F.lower(F.coalesce(F.col("text"), F.lit(""))), F.lit(r"(?U)\w++|[^\w\s]++"), F.lit(0))
    step = docs.select(*own, tokens.alias("_t"))
    step = step.select(*own, F.explode_outer(F.arrays_zip("_t", _tail(F.col("_t"), 2).alias("_n"))).alias("_p"))
    h = F.xxhash64("_p._t")
    pair = F.when(F.col("_p._n").isNotNull(), F.xxhash64(h, F.xxhash64("_p._n")))
    return step.select(*own, F.when(F.col("_p._t").isNotNull(), F.pmod(h, F.lit(buckets))).cast("int").alias("u"),
                       F.pmod(pair, F.lit(buckets)).cast("int").alias("b"))


def _good_ids(labels: DataFrame) -> DataFrame:
    return (labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull())
            .select(F.col("doc_id").cast("long").alias("good_id")).distinct())


def _positions(doc_id: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(FILTER_BITS)) for seed in (1, 2)]


def _may_be_good(good: DataFrame, doc_id: Column) -> Column:
    """False for ids that are surely not labelled good: a Bloom filter as a constant array of words."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    rows = (good.select(F.explode(F.array(*_positions(F.col("good_id")))).alias("at"))
            .groupBy(F.shiftright("at", 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")).collect())
    words = [0] * (FILTER_BITS // 64)  # the collected rows are FILTER_BITS / 64 at most
    for r in rows:
        words[r["word"]] = r["bits"]
    table = F.from_json(F.lit(json.dumps(words)), "array<long>")

    def held(at: Column) -> Column:
        word = F.get(table, F.shiftright(at, 6).cast("int"))
        return F.call_function("shiftright", word, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
    first, second = _positions(doc_id)
    return F.coalesce(doc_id.isNotNull() & held(first) & held(second), F.lit(False))


def bucket_weights(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id",
                   text_col: str = "text") -> list[float]:
    """log(p_target / p_raw) of every bucket, in whole millionths, from one pass over the texts.

    Target are the documents that ``labels`` calls good. Those that a Bloom filter of
    fixed size passes are shuffled to the exact join on their id, the same join at
    every size; the others are counted where they are read.
    """
    good = written(_good_ids(labels), "good-ids")
    ids, text = F.col(id_col).cast("long"), F.col(text_col).cast("string").alias("text")
    maybe = _may_be_good(good, ids)
    others = docs.where(~maybe).select(text, F.lit(0).alias("aim"))
    flagged = (docs.where(maybe).select(ids.alias("good_id"), text)
               .join(good.withColumn("aim", F.lit(1)).hint("shuffle_hash"), "good_id", "left")
               .select("text", F.coalesce("aim", F.lit(0)).alias("aim")))
    grams = [_gram_rows(part, buckets).select("aim", F.explode(F.array("u", "b")).alias("b")).where("b is not null")
             .groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.sum("aim").alias("aim")) for part in (others, flagged)]
    rows = (grams[0].union(grams[1]).groupBy("b").agg(F.sum("raw").alias("raw"), F.sum("aim").alias("aim"))
            .collect())  # at most ``buckets`` rows
    raw, aim = {r["b"]: r["raw"] for r in rows}, {r["b"]: r["aim"] for r in rows}
    if not sum(aim.values()):
        return [0.0] * buckets
    n_raw, n_aim = sum(raw.values()) + buckets, sum(aim.values()) + buckets
    return [round(math.log((aim.get(b, 0) + 1) / n_aim) - math.log((raw.get(b, 0) + 1) / n_raw), 6)
            for b in range(buckets)]


def judge(docs: DataFrame, weights: list[float], threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Base counts, base_failed, llr score and kept of every document.

    Weights are summed as whole millionths, so that the order of the rows of a
    document does not matter; all of them are in one task, and one row per
    document is shuffled.
    """
    picked = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("doc_id"),
                         F.col(text_col).cast("string").alias("text"))
    table = F.from_json(F.lit(json.dumps([round(w * _LLR_UNIT) for w in weights])), "array<long>")
    grams = _gram_rows(base_counts(picked), len(weights))
    carried = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    scored = grams.groupBy("_row").agg(
        *[F.any_value(c).alias(c) for c in carried],
        F.sum(F.coalesce(F.get(table, F.col("u")), F.lit(0)) + F.coalesce(F.get(table, F.col("b")), F.lit(0))).alias("_sum"),
        (F.count("u") + F.count("b")).alias("_n"))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))
    llr = F.when(F.col("_n") > 0, F.round(F.col("_sum") / F.col("_n") / _LLR_UNIT, 6)).otherwise(F.lit(0.0))
    return (scored.select(*carried, failed.alias("base_failed"), llr.alias("llr"))
            .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)))
