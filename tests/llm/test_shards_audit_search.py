"""K-d sharding, filter audit and ranked search against plain Python."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import filter_audit, kd_shards, lexical_search
from ledgerlens.llm.common import temporary_tables, written

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- sharding
def sharded(df, shards, **kw):
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    return kd_shards.shard(df, labels=["lang", "source"], numbers=[size], shards=shards, **kw).collect()


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard string, node string")


def corpus(seed, n=600, hot=0):
    rnd = random.Random(seed)
    rows = [(i, "x" * rnd.randrange(400), rnd.choice(["de", "en", None]), f"src{rnd.randrange(9)}", "mine", "yours") for i in range(n)]
    rows += [(10_000 + i, "the hot text " * 8, rnd.choice(["de", "en"]), f"src{rnd.randrange(9)}", "mine", "yours") for i in range(hot)]
    return rows


@pytest.mark.parametrize("seed,shards,hot", [(1, 16, 0), (2, 16, 300), (3, 5, 40), (4, 1, 0), (5, 3, 1)])
def test_shards_are_near_equal_and_complete(spark, seed, shards, hot):
    rows = corpus(seed, hot=hot)
    out = sharded(documents(spark, rows).repartition(4), shards)
    text = {r[0]: r[1] or "" for r in rows}
    assert {(r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in out} == {
        (i, len(t.encode()) + 1, zlib.crc32(t.encode()), "bytes", None) for i, t in text.items()}
    held = defaultdict(list)
    for r in out:
        held[r.shard].append(r)
    assert sorted(held) == list(range(shards))
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in held.values())
    sizes = [sum(r["size"] for r in x) for x in held.values()]
    leaf = sum(sizes) / shards
    # every cut misses its place by half a row or half a whole group at most, halved on the way down
    assert max(abs(s - leaf) for s in sizes) <= 2 * max(400, leaf * (kd_shards.GROUP + kd_shards.SLACK))


def test_copies_stay_together_unless_they_are_too_heavy(spark):
    rows = corpus(7, n=900) + [(20_000 + i, f"copy {i // 3} " * 9, "de" if i % 3 else "fr", f"src{i % 9}", "", "") for i in range(90)]
    out = sharded(documents(spark, rows), 8)
    text = {r[0]: r[1] for r in rows}
    places = defaultdict(set)
    for r in out:
        places[text[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for t, s in places.items() if t and t.startswith("copy"))


def test_a_shard_is_a_box_of_the_metadata(spark):
    """With one dimension and distinct values the shards are intervals in order."""
    rows = [(i, "abc", None, None, "", "") for i in range(200)]
    df = documents(spark, rows)
    out = kd_shards.shard(df, numbers=[F.col("doc_id")], shards=4).collect()
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.doc_id)
    assert [(min(by[s]), max(by[s])) for s in range(4)] == [(0, 49), (50, 99), (100, 149), (150, 199)]


def test_shards_of_odd_tables(spark):
    rows = [(1, None, None, None, "", ""), (1, None, None, None, "", ""), (None, "", "", "", "", ""), (2, "é🙂" * 50_000, "de", "s", "", "")]
    out = sharded(documents(spark, rows), 4)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter(
        [(1, 1, 0), (1, 1, 0), (None, 1, 0), (2, 300_001, zlib.crc32(("é🙂" * 50_000).encode()))])
    assert all(0 <= r.shard < 4 for r in out)
    assert sharded(documents(spark, rows).limit(0), 16) == []
    assert {r.shard for r in kd_shards.shard(documents(spark, corpus(9)), numbers=[F.col("doc_id")], target_bytes=20_000).collect()} \
        == set(range(math.ceil(sum(len(r[1]) + 1 for r in corpus(9)) / 20_000)))


# ---------------------------------------------------------------- filter audit
def mask_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return ((len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words))
            + 4 * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + 8 * bool(re.search(r"[#$%&*|]", text)))


def audited(rows, labels):
    texts = defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            texts[t or ""].append(i)
    good, bad = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    docs = [(p or "", mask_of(t or "") + 16 * (i is not None and i > min(texts[t or ""])), i in good, i in bad) for i, t, p in rows]
    out = {}
    for part in {d[0] for d in docs}:
        mine, shapley = [d for d in docs if d[0] == part], Counter()
        for order in itertools.permutations("ABCDE"):
            before = 0
            for step, name in enumerate(order, 1):
                bit = 1 << "ABCDE".index(name)
                removed = [d for d in mine if not d[1] & before and d[1] & bit]
                shapley[name] += len(removed)
                out[part, "".join(order), step] = [
                    sum(not d[1] & (before | bit) for d in mine), len(removed), sum(bool(d[1] & before and d[1] & bit) for d in mine),
                    sum(d[1] == bit for d in mine), sum(d[2] for d in removed), sum(d[3] for d in removed)]
                before |= bit
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


AUDIT_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@pytest.mark.parametrize("run_bytes,step,range_bytes", [(16 << 20, 1 << 20, 8 << 20), (2000, 100, 300)])
def test_audit_equals_brute_force(spark, monkeypatch, run_bytes, step, range_bytes):
    monkeypatch.setattr(filter_audit, "RUN_BYTES", run_bytes)
    monkeypatch.setattr(filter_audit, "STEP_BYTES", step)
    monkeypatch.setattr(filter_audit, "RANGE_BYTES", range_bytes)
    rnd = random.Random(3)
    pool = ["", None, " \n", "word " * 250, " ".join(f"w{i}" for i in range(300)), "ABC def", "a|b", "é🙂 " * 220, "x" * 70_000]
    pool += [" ".join(rnd.choice(["a", "B", "cc", "d$"]) for _ in range(rnd.randrange(260))) for _ in range(25)]
    pool += ["shared beginning " * 20 + str(i) for i in range(12)]
    rows = [(rnd.choice([None, rnd.randrange(150), i]), rnd.choice(pool), rnd.choice(["en", "de", "", None])) for i in range(300)]
    labels = [(rnd.choice([None, rnd.randrange(300)]), rnd.choice([None, 0, 1]), rnd.choice([None, 0, 1])) for _ in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("mask", F.lit("mine")).repartition(3)
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): [r[c] for c in AUDIT_COUNTS] for r in filter_audit.audit(docs, told).collect()}
    assert got == audited(rows, labels)
    assert filter_audit.audit(docs.limit(0), told).collect() == []


def test_trie_holds_the_smallest_id_of_every_text():
    rnd = random.Random(8)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(9))) for _ in range(800)] + [b"ab" * 3000, b"ab" * 3000 + b"c"]
    root, least = filter_audit.Trie(), defaultdict(list)
    for i, t in enumerate(texts):
        least[t].append(rnd.randrange(1000))
        root.insert(t, least[t][-1], 1, (0, i))
    found = {run[1]: (n.least, n.copies) for n in root.terminals() for run in n.runs}
    assert found == {i: (min(least[t]), len(least[t])) for i, t in enumerate(texts)}


def test_borders_are_the_shortest_that_part_neighbours(monkeypatch):
    monkeypatch.setattr(filter_audit, "STEP_BYTES", 10)
    texts = sorted([b"aaaaaaaaaaaaaaa1", b"aaaaaaaaaaaaaaa2", b"b", b"bcdefghijklmn", b"c"])
    for i, border in filter_audit._borders(texts):
        assert texts[i - 1] < border <= texts[i] and not texts[i - 1] >= border[:-1] + bytes([255])


# ---------------------------------------------------------------- ranked search
def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, k):
    said = [(i, Counter(terms(t))) for i, t in docs]
    said = [(i, c) for i, c in said if c]
    n_docs, total = len(said), sum(c.total() for _, c in said)
    df = Counter(w for _, c in said for w in c)
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) for w in df}
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = set()
    for item, words in asked.items():
        found = []
        for i, c in said:
            m = 50 + 50 * c.total() * n_docs // total
            score = sum(weight[w] * (1_000_000_000 * c[w] // (1000 * c[w] + 20 * m)) for w in words if w in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out |= {(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k], 1)}
    return out


@pytest.mark.parametrize("seed,k,first,block", [(1, 50, 64, 1_000_000), (2, 3, 1, 20), (3, 10, 2, 1_000_000), (4, 500, 64, 7)])
def test_search_equals_brute_force(spark, monkeypatch, seed, k, first, block):
    monkeypatch.setattr(lexical_search, "FIRST_READ", first)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
    monkeypatch.setattr(lexical_search.nra, "__defaults__", (0, first))
    rnd = random.Random(seed)
    vocab = [f"W{i}" for i in range(40)] + ["é", "ÉA", "日本", "a1", "the", "the", "the"]
    docs = [(i if i % 17 else None, rnd.choice([" ", "\n", "-", "\x01"]).join(rnd.choice(vocab) for _ in range(rnd.randrange(60)))) for i in range(200)]
    docs += [(300 + i, "the w1 w2") for i in range(120)] + [(7, "twice"), (7, "twice w3"), (8, None), (9, ""), (10, "W5 " * 5000)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(1, 12)))) for i in range(12)]
    items += [(3, "more W7 words"), (100, None), (101, "nobody says this at all"), (None, "the w1"), (102, "the")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("mine")).repartition(3)
    got = lexical_search.search(df, spark.createDataFrame(items, "item_id long, text string"), k=k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == ranked(docs, items, k)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(docs.limit(0), items).collect() == []
    assert lexical_search.search(docs, items.limit(0)).collect() == []


def test_nra_reads_no_more_than_it_needs():
    rng = np.random.default_rng(1)
    n, lists = 5000, 6
    sizes = np.full(lists, n)
    starts = np.arange(lists) * n
    rows = np.concatenate([rng.permutation(n) for _ in range(lists)])
    impacts = np.concatenate([np.sort((10_000 / (1 + np.arange(n)) ** 0.9).astype(np.int64) * (j + 1))[::-1] for j in range(lists)])
    left, lower, read = lexical_search.nra(starts, sizes, rows, impacts, n, 5)
    total = np.zeros(n, np.int64)
    np.add.at(total, rows, impacts)
    best = np.lexsort((np.arange(n), -total))[:5]
    assert set(best) <= set(left) and all(total[i] == s for i, s in zip(left, lower))
    assert read <= lists * n
    # a threshold from elsewhere spares reading
    assert lexical_search.nra(starts, sizes, rows, impacts, n, 5, floor=int(total.max()) + 1)[2] <= read


# ---------------------------------------------------------------- intermediate tables
def test_temporary_tables_are_removed(spark):
    with temporary_tables(spark) as outer:
        with temporary_tables(spark) as inner:
            a, b = written(spark.range(3).toDF("x"), "a"), written(spark.range(4).toDF("x"), "b")
            inner.keep(b)
        assert b.count() == 4
        with pytest.raises(Exception):
            spark.read.parquet(a._scratch_path)
        c = written(b, "c")
        outer.keep(c)
    assert c.count() == 4
    with pytest.raises(Exception):
        spark.read.parquet(b._scratch_path)
