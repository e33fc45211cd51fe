"""Top-k search, toxicity, quality classifier and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_minhash import brute
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlens.llm import quality_classifier, topk_search, toxicity
from ledgerlens.llm.tokens import public_path

SF = "/root/testdata/sf0.001"


def brute_top(rows, k, asked):
    rows = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows
            if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for q, v in rows:
        if asked(q):
            best = sorted((-int(v @ w), i) for i, w in rows if i != q)[:k]
            out |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("n,block,bins", [(300, 64, 16), (3, 2048, 1024), (120, 7, 4)])
def test_top_k_equals_brute_force(spark, n, block, bins):
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 4)]) for i in range(n)]
    rows += [(1000 + i, [0.5, 0.5, 0.0, 0.0]) for i in range(n // 3)]  # one common vector: ties
    rows += [(5000, None), (5001, [0.1, None, 0.2, 0.3]), (5002, [float("nan")] * 4), (5003, [float("inf")] * 4), (5004, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = topk_search.top_k(df, F.col("id") % 20 == 0, bins=bins, block_rows=block).collect()
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == brute_top(exact, 5, lambda q: q % 20 == 0)


def best_of(rows, asked, k=5, scale=256):
    import math
    q = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
         if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i in sorted({i for i, _ in q if asked(i)}):
        mine = min(v for j, v in q if j == i)
        for w in {len(v) for j, v in q if j == i}:
            mine = min(v for j, v in q if j == i and len(v) == w)
            found = sorted((-sum(a * b for a, b in zip(mine, v)), j) for j, v in q if j != i and len(v) == w)
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("size", [1.0, 3.0e4, 1.0e5, 9.0e6])
def test_top_k_of_large_components(spark, size):
    """From doubles over 64-bit integers to whole numbers beyond; no finite vector is dropped."""
    rnd = random.Random(int(size))
    rows = [(i, [rnd.uniform(-size, size), rnd.uniform(-size, size)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.top_k(df, F.col("id") % 10 == 0, bins=64, block_rows=16).collect()
    assert sorted(tuple(r) for r in got) == best_of(rows, lambda i: i % 10 == 0)


def test_scores_beyond_64_bits_stop_the_run(spark):
    df = spark.createDataFrame([(1, [1e9, 1e9]), (2, [1e9, 1e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        topk_search.top_k(df, F.col("id") == 1).collect()
    huge = spark.createDataFrame([(1, [1e300]), (2, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        topk_search.top_k(huge, F.col("id") == 1).collect()


def test_each_length_is_searched_by_itself(spark):
    rnd = random.Random(9)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(2 + i % 3)]) for i in range(90)]
    rows += [(None, [0.1, 0.2]), (500, []), (501, None), (502, [float("nan"), 1.0]), (503, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("mine"))
    got = topk_search.top_k(df, F.col("id") % 7 == 0, block_rows=8).collect()
    assert sorted(tuple(r) for r in got) == best_of(rows, lambda i: i % 7 == 0)


def test_a_repeated_id_is_spread_over_chunks(spark):
    rnd = random.Random(10)
    rows = [(i if i % 3 else 0, [rnd.uniform(-1, 1) for _ in range(3)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.top_k(df, F.col("id") % 50 == 0, block_rows=16).collect()
    assert sorted(tuple(r) for r in got) == best_of(rows, lambda i: i % 50 == 0)


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_search.top_k(df, F.col("id") % 50 == 0).collect() == []


def talk(rnd, bad, n=80):
    words = [f"{rnd.choice('bcdfgklmnprst')}{rnd.choice('aeiou')}{rnd.choice(['n', 'st', 'l', 'r'])}" for _ in range(n)]
    if bad:
        for _ in range(3):
            words[rnd.randrange(n)] = rnd.choice(["scumbag", "vileness", "idiotic"])
    return " ".join(words)


def test_toxicity_on_held_out_rows(spark):
    rnd = random.Random(1)
    rows = [(i, talk(rnd, i % 4 == 0), 0.3) for i in range(1200)]
    docs = spark.createDataFrame(rows + [(5000, None, 0.1), (5001, "", 0.1)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(1200)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    found = {r.doc_id: r.score for r in toxicity.scores(docs, model).collect()}
    held = [i for i in range(1200) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(found[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.95
    assert 0 <= found[5000] == found[5001] < 0.5
    left = toxicity.drop_toxic(docs, model)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, s in found.items() if s < 0.5}


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    assert [r.score for r in toxicity.scores(docs, model).collect()] == [0.0]
    assert toxicity.scores(docs.limit(0), model).collect() == []


def quality_rows(n=900):
    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        text = talk(rnd, False, 60)
        if not good:
            text = " ".join(w + rnd.choice(["$$$", "%%%", "***"]) for w in text.split())
        rows.append((i, text, "hot" if i % 2 else f"h{i % 7}", None if i % 11 == 0 else "p"))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality_classifier(spark):
    rows, labels = quality_rows()
    docs = spark.createDataFrame(rows + [(9000, None, None, None)], "doc_id long, text string, source string, lang string")
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = quality_classifier.classify(docs, told, F.col("source"), F.col("lang")).collect()
    assert len(out) == len(rows) + 1
    kept = {r.doc_id: r.kept for r in out}
    assert not kept[9000]
    held = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([kept[i] == (i % 3 != 0) for i in held]) > 0.97
    left = quality_classifier.keep_good(docs, told, F.col("source"), F.col("lang"))
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, k in kept.items() if k}


def test_sparse_sites_stay_near_their_parent(spark):
    rows = [(i, "big", "a", 4.0 if i % 10 else -4.0) for i in range(1000)] + [(2000, "tiny", "b", -4.0)]
    rows += [(3000 + i, "bad", "c", -4.0) for i in range(500)]
    found = spark.createDataFrame(rows, "doc_id long, _host string, _path string, llr double")
    got = {r._host: r for r in quality_classifier.site_posteriors(found, 0.5).collect()}
    assert got["big"].path_posterior > 0.85 and got["bad"].path_posterior < 0.1
    share = sum(1 / (1 + np.exp(-r[3])) for r in rows) / len(rows)
    # one document of 0.018 says little: its site is drawn a fourth of the way to the whole share at least
    assert 0.018 + (share - 0.018) / 4 < got["tiny"].path_posterior < share


def test_quality_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "l"), (2, "c", None, "l"), (3, None, "s", None)],
                                 "doc_id long, text string, source string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality_classifier.classify(docs, none, F.col("source"), F.col("lang")).collect()
    assert {r.doc_id: r.llr for r in out} == {1: 0.0, 2: 0.0, 3: -quality_classifier.MAX_EVIDENCE}
    assert all(0 <= r.quality <= 1 for r in out)  # no NaN
    left = quality_classifier.keep_good(docs, none, F.col("source"), F.col("lang")).collect()
    assert {r.doc_id for r in left} == {r.doc_id for r in out if r.kept}
    assert quality_classifier.classify(docs.limit(0), none, F.col("source"), F.col("lang")).count() == 0


def test_quality_with_one_class_only(spark):
    rows, _ = quality_rows(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    told = spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int")
    out = quality_classifier.classify(docs, told, F.col("source"), F.col("lang")).collect()
    assert {r.llr for r in out} == {0.0}
    left = quality_classifier.keep_good(docs, told, F.col("source"), F.col("lang")).collect()
    assert {r.doc_id for r in left} == {r.doc_id for r in out if r.kept}


def test_quality_keeps_columns_of_any_name_and_fits_an_id_once(spark):
    rows, labels = quality_rows(300)
    rows += [rows[1]] * 2000  # one labelled id holds most rows
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality_classifier.train(docs, told)
    assert model.base == pytest.approx(quality_classifier.train(docs.dropDuplicates(["doc_id"]), told).base)
    named = docs.withColumn("_host", F.lit("mine")).withColumn("_path_posterior", F.col("doc_id") * 2)
    left = quality_classifier.keep_good(named, told, F.col("source"), F.col("lang"))
    assert left.columns == named.columns
    plain = quality_classifier.keep_good(docs, told, F.col("source"), F.col("lang"))
    assert sorted(r.doc_id for r in left.collect()) == sorted(r.doc_id for r in plain.collect())
    assert all(r._host == "mine" and r._path_posterior == 2 * r.doc_id for r in left.collect())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_classifier", "near_dedup", "packing"]
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    packed = corpus_pipeline.pack(spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_pipeline_equals_its_operators_and_brute_force(spark):
    """Each stage's decisions, taken from the operator's own table or from all pairs, give run()'s pieces."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r.doc_id: r.score for r in toxicity.scores(docs, toxicity.train(docs, labels)).collect()}
    clean = docs.filter(F.col("doc_id").isin([i for i, x in scores.items() if x < 0.5]))
    judged = quality_classifier.classify(clean, labels, F.col("source"), F.col("lang")).collect()
    good = {r.doc_id for r in judged if r.kept}
    texts = {r.doc_id: r.text or "" for r in clean.collect() if r.doc_id in good}
    component = brute(sorted(texts.items()), 5)
    left = {i for i in texts if component[i][1] == i}
    lib = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    want = {i: len(lib.encode(texts[i], add_special_tokens=False).ids) + 1 for i in left}
    got, rooms = {}, {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        rooms[r.sequence_id] = rooms.get(r.sequence_id, 0) + r.length
    assert got == want and max(rooms.values()) <= 1024


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
