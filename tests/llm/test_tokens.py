"""Packing, token counts and BPE: against the tokenizers library."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import bpe, packing, token_counts
from ledgerlens.llm.tokens import PieceEncoder, public_path

ODD = [None, "", " ", "a  b\n\n c\t\td", "It's I'LL don't", "<|endoftext|> a <|startoftext|>b<|x|>", "a\x1c\x1d b!!\x1c",
       "ΑΣ ΣΑΣ", "İstanbul", "é", "123 4５", "ab\xa0 c", "x" * 300, "aaaa" * 50, "日本語🙂🙂", "l'''ll", "word " * 3000]


def texts(seed, n=300):
    rnd = random.Random(seed)
    return ODD + ["".join(rnd.choice("abeinorsthABÉé's ,.$1\n") for _ in range(rnd.randint(1, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(public_path("byte_bpe_50k.json"))


def test_piece_encoder_equals_library(byte_bpe):
    enc = PieceEncoder(public_path("byte_bpe_50k.json"), memo_pieces=50)
    for t in texts(1):
        want = byte_bpe.encode(t or "", add_special_tokens=False).ids
        assert enc.ids(t) == want
        assert sum(enc.piece_counts(enc.pieces(t))) == len(want)


def test_packing(spark, byte_bpe):
    docs = list(enumerate(texts(2) + ["long text here " * 700] * 3))
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, offset string")
    rows = [r.asDict() for r in packing.pack(df).collect()]
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, t in docs:
        ids = np.array(byte_bpe.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024 and all(r["sequence_tokens"] == at for r in rs)
        assert all(r["padded_tokens"] == (at if at & (at - 1) == 0 else 1024) for r in rs)
    assert packing.pack(df.limit(0)).collect() == []


def test_packing_of_repeated_and_null_ids(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "other"), (None, "x"), (None, None), (2, "w " * 3000), (2, "w " * 3000)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    tokens = {}
    for r in got:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    enc = PieceEncoder(public_path("byte_bpe_50k.json"))
    want = {}
    for i, t in rows:
        want[-1 if i is None else i] = want.get(-1 if i is None else i, 0) + len(enc.ids(t)) + 1
    assert tokens == want
    assert sum(r.length == 1024 for r in got) == 2 * ((len(enc.ids("w " * 3000)) + 1) // 1024)


def test_padding_is_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1)
    found = packing.pack(docs).select("sequence_id", "sequence_tokens", "padded_tokens").distinct()
    used, padded = found.agg(F.sum("sequence_tokens"), F.sum("padded_tokens")).first()
    assert padded <= 1.01 * used


def test_best_fit_decreasing_equals_a_plain_search():
    rnd = random.Random(3)
    lengths = [rnd.randint(1, 64) for _ in range(400)]
    place, offset, used = packing.best_fit_decreasing(lengths, 64)
    room: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in room if r >= lengths[i]]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - lengths[i])
        else:
            room.append(64 - lengths[i])
        assert 64 - offset[i] == (min(fits) if fits else 64)
    assert used == len(room)
    assert packing.best_fit_decreasing([], 64) == ([], [], 0)


def test_edited_counts_equal_counting_anew(byte_bpe):
    enc = PieceEncoder(public_path("byte_bpe_50k.json"))
    rnd = random.Random(5)
    for t in texts(6):
        t = t or ""
        cuts = sorted(rnd.sample(range(len(t) + 1), min(len(t) + 1, 2 * rnd.randint(0, 4))))
        edits = [{"start": a, "stop": b, "text": rnd.choice(["", "x", " y", " ", "z z ", "\n", "  "])}
                 for a, b in zip(cuts[::2], cuts[1::2])]
        new = t
        for e in reversed(edits):
            new = new[:e["start"]] + e["text"] + new[e["stop"]:]
        n, before, after, _, _, chars = token_counts.edited_counts(enc, t, edits)
        assert (n, before, after, chars) == (len(edits), len(byte_bpe.encode(t, add_special_tokens=False).ids),
                                             len(byte_bpe.encode(new, add_special_tokens=False).ids), len(new))


def test_edits_reencode_only_their_neighbourhood():
    enc = PieceEncoder(public_path("byte_bpe_50k.json"))
    text = " ".join(f"word{i}" for i in range(2000))
    *_, reencoded, _ = token_counts.edited_counts(enc, text, [{"start": 900, "stop": 905, "text": "new"}])
    assert reencoded <= 5


def test_token_count_frames(spark, byte_bpe):
    df = spark.createDataFrame([(i, t, [(0, 1, "Zz")] if i % 2 else None) for i, t in enumerate(texts(7, 40))],
                               "doc_id long, text string, edits array<struct<start:int,stop:int,text:string>>")
    said = dict(enumerate(texts(7, 40)))
    for r in token_counts.count_tokens(df).collect():
        new = (said[r.doc_id] or "")
        new = "Zz" + new[1:] if r.doc_id % 2 else new
        assert r.n_tokens == len(byte_bpe.encode(new, add_special_tokens=False).ids)
    for r in token_counts.count_redacted(df).collect():
        new = re.sub("[0-9]{3,}", "[NUMBER]", said[r.doc_id] or "")
        assert r.n_tokens == len(byte_bpe.encode(new, add_special_tokens=False).ids)
    assert token_counts.count_redacted(df.limit(0)).collect() == []


def test_bpe_digests_equal_library(spark):
    lib = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    said = texts(8)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(said)], "doc_id long, text string, n_tokens int")
    for r in bpe.digests(df).collect():
        ids = lib.encode(said[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids), said[r.doc_id]
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    full = {r.doc_id: r.ids for r in bpe.encode(df).collect()}
    assert all(full[i] == lib.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(said))
    assert bpe.digests(df.limit(0)).collect() == []


def test_automaton_accepts_exactly_the_tokenizations():
    # every string over a small alphabet, against merging in order
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("b", "a"), ("aa", "aa"), ("ab", "ab"), ("c</w>", "")]
    merges = merges[:-1] + [("b", "c</w>"), ("a", "bc</w>")]
    vocab = {t: i for i, t in enumerate(["a", "b", "c", "a</w>", "b</w>", "c</w>"] + [x + y for x, y in merges])}
    machine = bpe.TokenAutomaton(vocab, merges, "</w>")
    back = {i: t for t, i in vocab.items()}
    rnd = random.Random(9)
    for _ in range(3000):
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
        symbols = [*word[:-1], word[-1] + "</w>"]
        for x, y in merges:
            i = 0
            while i < len(symbols) - 1:
                if symbols[i] == x and symbols[i + 1] == y:
                    symbols[i:i + 2] = [x + y]
                i += 1
        assert [back[i] for i in machine.encode(word)] == symbols


def applied(text, edits):
    """The text after its edits, by the rule for overlapping ones, in plain Python."""
    n, taken = len(text), []
    inside = [(min(max(a, 0), n), min(max(a, b, 0), n), new) for a, b, new in edits]
    for a, b, new in sorted(inside, key=lambda e: (e[0], e[1] > e[0], -e[1])):
        if all(a >= q for _, q, _ in taken):
            taken.append((a, b, new))
    out, at = "", 0
    for a, b, new in taken:
        out += text[at:a] + new
        at = b
    return out + text[at:], len(taken)


def test_overlapping_edits(byte_bpe):
    enc, rnd = PieceEncoder(public_path("byte_bpe_50k.json")), random.Random(12)
    for _ in range(150):
        text = "".join(rnd.choice(["ab", " ", "\n", "don't", "é", "12", "  "]) for _ in range(rnd.randrange(25)))
        edits = []
        for _ in range(rnd.randrange(8)):
            a = rnd.randrange(-2, len(text) + 3)
            edits.append((a, a + rnd.choice([0, 0, 1, 3, 9]), rnd.choice(["", "x", " y", " "])))
        want, kept = applied(text, edits)
        told = [{"start": a, "stop": b, "text": t} for a, b, t in edits]
        n, _, after, _, _, chars = token_counts.edited_counts(enc, text, [*told, None])
        assert (n, after, chars) == (kept, len(byte_bpe.encode(want, add_special_tokens=False).ids), len(want))


def test_cleaning_edits_every_document(spark, byte_bpe):
    texts = [None, "", "\n", "one", "# head\nx\n", "a  b\t\tc 12345 d-\ne\n\n\n\nline\nline\n line\nend 999",
             "x\r\ny\u00a0\u00a0z", "1234 1234\n1234 1234\n" * 3]
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    df = df.union(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    for r in token_counts.count_cleaned(df).collect():
        edits = [(e["start"], e["stop"], e["text"]) for e in token_counts.cleaning_edits(texts[r.doc_id])]
        want, kept = applied(texts[r.doc_id], edits)
        assert (r.n_edits, r.n_chars) == (kept, len(want))
        assert r.n_tokens == len(byte_bpe.encode(want, add_special_tokens=False).ids)
        assert r.n_tokens_before == len(byte_bpe.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert r.n_edits >= (len(texts[r.doc_id].split()) > 0 and not texts[r.doc_id].startswith("#"))
