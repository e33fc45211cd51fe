"""Near-duplicate groups against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import minhash

SCHEMA = "doc_id long, text string, kept string"


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, percent=80):
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(x), find(i)) for i, x in sets}


def corpus(seed, n=120):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(n):
        if texts and rnd.random() < 0.6:  # a near copy of an earlier text
            words = rnd.choice(texts).split()
            for _ in range(rnd.randint(0, max(1, len(words) // 12))):
                words[rnd.randrange(len(words))] = rnd.choice(vocab)
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 60))))
    return list(enumerate(texts))


def found(spark, rows, k):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in
            minhash.near_duplicates(df, shingle=k).collect()}


@pytest.mark.parametrize("seed,k", [(1, 2), (2, 5)])
def test_equals_brute_force(spark, seed, k):
    rows = corpus(seed)
    want = brute(rows, k)
    got = found(spark, rows, k)
    assert {i: x[:2] for i, x in got.items()} == want
    assert all(kept == (i == root) for i, (_, root, kept) in got.items())


def test_odd_texts_and_copies(spark):
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "One Two\x0bthree"), (3, "one two three"), (9, "ONE TWO THREE"),
            (10, "É two three"), (11, "é two three"), (12, "solo"), (2, "Solo")]
    want = brute(rows, 2)
    assert {i: x[:2] for i, x in found(spark, rows, 2).items()} == want
    assert want[8] == (2, 3) and want[5] == (0, 5) and want[12] == (1, 2)


def test_large_bucket_with_several_components_is_compared_in_blocks(spark, monkeypatch):
    # chains of near copies: neighbours are linked, the ends are not like the hub
    monkeypatch.setattr(minhash, "SMALL_BUCKET", 2)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 300)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[3 * i:3 * i + 60])) for i in range(40)]
    assert {i: x[:2] for i, x in found(spark, rows, 2).items()} == brute(rows, 2)


def test_empty_table_and_null_ids(spark):
    assert found(spark, [], 2) == {}
    df = spark.createDataFrame([(None, "a b c", "x"), (None, "a b c", "x")], SCHEMA)
    assert [r.component_id for r in minhash.near_duplicates(df).collect()] == [-1, -1]


def test_different_texts_of_one_id_are_different_documents(spark):
    rnd = random.Random(9)
    text = [" ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(40)) for _ in range(20)]
    near = text[0] + " more"
    rows = ([(None, t) for t in text[:12]] + [(None, near), (None, text[1]), (7, text[1].upper()), (7, text[13])]
            + [(8, text[13]), (8, text[14]), (8, text[14] + " x"), (9, text[15]), (9, None), (9, None), (9, ""), (10, None),
               (11, text[16] + " y"), (3, text[16])])
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert got == {(-1, 36, -1), (-1, 37, -1), (7, 36, -1), (7, 36, 7), (8, 36, 7), (8, 36, 8), (8, 37, 8), (9, 36, 9),
                   (9, 0, 9), (10, 0, 10), (11, 37, 3), (3, 36, 3)}
    left = [(r.doc_id, r.text) for r in minhash.keep_representatives(df).collect()]
    assert len(left) == len(set(left)) and set(left) <= set(rows)
    for some in ({(None, text[0]), (None, near)}, {(8, text[14]), (8, text[14] + " x")}):  # one of two near texts of one id
        assert len(some & set(left)) == 1
        left = [x for x in left if x not in some]
    assert set(left) == ({(None, t) for t in text[1:12]} | {(7, text[13]), (9, text[15]), (9, None), (9, ""), (10, None),
                                                           (3, text[16])})


def test_representatives_keep_columns(spark):
    rows = corpus(3, 60)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows] + [(0, rows[0][1], "x")], SCHEMA)
    left = minhash.keep_representatives(df)
    assert left.columns == df.columns
    want = sorted(i for i, (_, root) in brute(rows, 5).items() if i == root)
    assert sorted(r.doc_id for r in left.collect()) == want


def sequential(values, slots):
    """SuperMinHash as published: one permutation array per element."""
    h = [None] * slots
    for v in values:
        p = list(range(slots))
        for j in range(slots):
            x = int(minhash.seeded(np.array([v], np.uint64), j)[0])
            k = j + (((x >> 32) * (slots - j)) >> 32)
            p[j], p[k] = p[k], p[j]
            value = (j << 32) | (x & 0xFFFFFFFF)
            if h[p[j]] is None or value < h[p[j]]:
                h[p[j]] = value
    return h


@pytest.mark.parametrize("n", [1, 3, 20, 200])
def test_signature_equals_the_sequential_algorithm(n):
    rng = np.random.default_rng(n)
    values = rng.integers(0, 2 ** 63, n).astype(np.uint64)
    got = minhash.superminhash(values, np.array([0, n]), 32)
    assert got[0].tolist() == sequential(values.tolist(), 32)


def test_components_of_paths_and_stars(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, x) for x in range(2, 40)] + [(300, 299), (299, 298)]
    rnd.shuffle(edges)
    got = {r.node: r.component for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == ({i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 40)} | {i: 298 for i in (298, 299, 300)})


def test_representatives_keep_columns_of_any_name(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, 777, "x"), (1, text, 778, "y"), (2, text, 779, "z"), (3, "other words here", 780, "u"), (3, "", 781, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id long, _f1 string")
    got = sorted((r.doc_id, r._id, r._f1) for r in minhash.keep_representatives(df).collect())
    assert got in ([(1, 777, "x"), (3, 780, "u"), (3, 781, "v")], [(1, 778, "y"), (3, 780, "u"), (3, 781, "v")])
    words = df.withColumnRenamed("_id", "_dropped").withColumn("_kept_doc_id", F.lit("k"))
    assert {(r._dropped, r._kept_doc_id) for r in minhash.keep_representatives(words).collect()} >= {(780, "k"), (781, "k")}
