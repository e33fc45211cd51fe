"""Quality rules, HTML extraction, chat formatting: against plain Python."""

import hashlib
import math
import re
import time
from collections import Counter

import pytest
import xxhash

from ledgerlens.llm import chat, html_text, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \n\t", "one", "a b c d e f g h " * 5, "x\nx\n\n x\nx \nx", "A#b $5 & <i> | 100% *\n" * 3,
         "é ü\x0bß\x0c日本 🙂 end", " ".join(f"w{i}" for i in range(30)), "p q r s t u v w x p q r s t u v w y " * 2,
         "\n\nlead\r\ntail\r\n", " ".join(["w"] * 3000)]


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    inside = {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def test_base_counts_equal_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
           for r in quality_rules.base_counts(df).collect()}
    assert got == {i: base(t) for i, t in enumerate(TEXTS)}


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def ngrams(text, buckets):
    tokens = re.findall(r"\w+|[^\w\s]+", (text or "").lower())
    hashes = [xxhash.xxh64_intdigest(t.encode(), 42) for t in tokens]
    pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), a) for a, b in zip(
        [xxhash.xxh64_intdigest(signed(h).to_bytes(8, "little", signed=True), 42) for h in hashes], hashes[1:])]
    return [signed(h) % buckets for h in hashes + pairs]


def test_scores_equal_brute_force(spark):
    plain = [t for t in TEXTS if t is None or t.isascii()]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(plain)], "doc_id long, text string, llr int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(len(plain))], "doc_id long, quality int")
    weights = quality_rules.bucket_weights(df, labels, 64)
    raw = Counter(b for t in plain for b in ngrams(t, 64))
    aim = Counter(b for i, t in enumerate(plain) if i % 3 == 0 for b in ngrams(t, 64))
    want = [math.log((aim[b] + 1) / (aim.total() + 64)) - math.log((raw[b] + 1) / (raw.total() + 64)) for b in range(64)]
    assert weights == pytest.approx(want, abs=1e-6)
    for r in quality_rules.judge(df, weights, threshold=0.0).collect():
        grams = ngrams(plain[r.doc_id], 64)
        assert r.llr == pytest.approx(sum(weights[b] for b in grams) / len(grams) if grams else 0, abs=1e-5)
        n = base(plain[r.doc_id])
        failed = n[0] < 20 or 100 * n[4] > 30 * n[0]
        assert (r.base_failed, r.kept) == (failed, not failed and r.llr >= 0)


def test_no_target_and_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.bucket_weights(df, labels, 8) == [0.0] * 8
    docs = spark.createDataFrame([(1, "a b"), (None, "c")], "doc_id long, text string")
    assert quality_rules.bucket_weights(docs, labels, 8) == [0.0] * 8
    assert quality_rules.judge(df, [0.0] * 8).collect() == []


PAGES = [
    (None, ""), ("", ""), ("<p>", ""),
    ("<html><head><title>t</title><style>p{}</style><script>var a='<p>x</p>'</script></head><body><nav><a href=/>Home</a></nav>"
     "<article><h1>A &amp; B</h1><p>One&nbsp;two\n three<br>four<p>five <a href=x>six</a> seven</article>"
     "<footer>&copy; us</footer></body></html>", "A & B\n\nOne two three\n\nfour\n\nfive six seven"),
    ("<main><header><h1>Head</h1></header><p>Body text here</p><section class='comments'><p>I disagree strongly</p></section>"
     "<form><p>Sign up now</p></form></main><aside>More</aside>", "Head\n\nBody text here"),
    ("<div id='cookie-notice'>We use cookies on this site</div><div class='post-content'><p>Short.</p><p>1 &lt; 2</p></div>",
     "Short.\n\n1 < 2"),
    ("<article>a < b and <b>bold</b><!-- note --> end<p hidden>no</p><noscript>js</noscript></article>", "a < b and bold end"),
    ("<article><p>kept</article><!-- never closed <article>x</article>", "kept"),
]


def test_pages(spark):
    df = spark.createDataFrame([(i, "u", h, 1) for i, (h, _) in enumerate(PAGES)],
                               "page_id long, url string, html string, text int")
    rows = html_text.extract(df).collect()
    assert {r.page_id: r.text for r in rows} == {i: t for i, (_, t) in enumerate(PAGES)}
    assert all(r.n_chars == len(r.text) for r in rows)
    assert html_text.extract(df.limit(0)).collect() == []


def test_pages_without_article_use_words_and_links():
    tree = html_text.train_tree()
    long = " ".join(["word"] * 60)
    page = f"<div><a href=1>one</a> <a href=2>two</a></div><div>{long}</div><div>{long}</div><div><a href=3>next page</a></div>"
    assert html_text.main_text(page, tree) == f"{long}\n\n{long}"


LONG = " ".join(f"word{i}" for i in range(60))


@pytest.mark.parametrize("page", [
    f"<body><form id=aspnetForm><nav><a href=/>Home</a></nav><article><p>{LONG}</p></article></form></body>",
    f"<body><form id=aspnetForm><div><p>{LONG}</p><p>{LONG}</p></div><footer>us</footer></form></body>",
    *[f"<body><div class='{c}'><article><p>{LONG}</p></article><div class=sidebar><p>Ten more of these</p></div></div>"
      for c in ("has-sidebar", "layout with-sidebar", "page sidebar-right", "no-sidebar", "overlay")],
    f"<body><div class='layout with-sidebar'><div><p>{LONG}</p><p>{LONG}</p></div><div class=sidebar>Ten more</div></div>",
    *[f"<article><p>{LONG}</p></article><div class={c}><article><p>I disagree with all of this</p></article><p>{LONG} no</p></div>"
      for c in ("article-comments", "post-comments", "entry-comments")],
    f"<main><p>{LONG}</p></main><footer><article><p>{LONG} no</p></article></footer><form><p>{LONG} {LONG} {LONG}</p></form>"])
def test_wrappers_do_not_lose_the_article_and_comments_stay_out(page):
    got = html_text.main_text(page, html_text.train_tree())
    assert got in (LONG, f"{LONG}\n\n{LONG}") and got.count(LONG) == min(page.count(f"<p>{LONG}</p>"), 2)


SHORT = "Ten words of plain text are in this short paragraph here."


@pytest.mark.parametrize("inner", [
    '<section id="related-work"><p>{}</p></section>', '<div class="side-effects"><p>{}</p></div>',
    '<div class="social-history"><p>{}</p></div>', '<section id="search-for-truth"><p>{}</p></section>',
    '<div class="tasting-menu"><p>{}</p></div>', "<p><a href=x>{}</a></p>"])
def test_names_that_only_begin_like_boilerplate_stay(inner):
    page = f"<article><p>{LONG}</p>{inner.format(SHORT)}<p>{LONG}</p></article>"
    assert html_text.main_text(page, html_text.train_tree()) == f"{LONG}\n\n{SHORT}\n\n{LONG}"


def test_a_weak_name_does_not_remove_long_text_inside_an_article():
    tree = html_text.train_tree()
    for name in ("sidebar", "search", "share-buttons", "legal"):
        page = f"<article><p>{LONG}</p><div class={name}><p>{LONG} more</p></div><div class={name}><p>Short words</p></div></article>"
        assert html_text.main_text(page, tree) == f"{LONG}\n\n{LONG} more"


@pytest.mark.parametrize("name", ["reader-responses", "user-feedback", "talkback", "comments-area", "related-posts", "ad", "ad-slot-2"])
def test_comments_adverts_and_menus_stay_out(name):
    page = f"<article><p>{LONG}</p><div class={name}><p>{LONG} no</p></div></article><div class={name}><p>{LONG} no</p></div>"
    assert html_text.main_text(page, html_text.train_tree()) == LONG


def test_words_outside_the_article_stay_out():
    tree = html_text.train_tree()
    assert html_text.main_text(f"<div>Home About Contact</div><div>{LONG}</div><div>{LONG}</div>", tree) == f"{LONG}\n\n{LONG}"
    assert html_text.main_text(f"<div>Home About Contact</div><article>{LONG}</article><div>Teaser of some more words</div>", tree) == LONG


@pytest.mark.parametrize("piece", ["<b>x<i></p>", "<header>x", "<![CDATA[ x", '<a x="<a" ', '<a "<a" ', "<a title='", "<div class=ad><p>",
                                   "<article><i></p>", "<p>a<article></p>", "</p>", "<form><p>x", "<a x='<b ", "<!", "<!-- x", "&lt", "<x y=\"'>"])
def test_time_grows_with_the_length_of_broken_pages(piece):
    tree, times = html_text.train_tree(), []
    for size in (100_000, 1_000_000):
        page = piece * (size // len(piece))
        start = time.perf_counter()
        html_text.main_text(page, tree)
        times.append(time.perf_counter() - start)
    assert times[1] < 8 and times[1] < 40 * times[0] + 0.5


def test_quotes_and_broken_tags():
    def read(page):
        return " | ".join(b.text for b in html_text.blocks(page))
    assert read("<p title='a > b'>x</p>") == "x"
    assert read('<p title="a <b> c">x</p>') == "x"
    assert read("a < b, c <d and <b>e</b>") == "a < b, c <d and e"
    assert read('<a title="x>y</a> z') == "y z"
    assert read("<![CDATA[1 < 2]]> <!DOCTYPE x> 3") == "1 < 2 3"
    assert read("x <p") == "x <p" and read("<") == "<" and read("</") == "</"


@pytest.mark.parametrize("bits", [1 << 22, 64])
def test_target_counts_every_good_document(spark, monkeypatch, bits):
    """Also when the filter over the good ids lets nearly everything pass."""
    monkeypatch.setattr(quality_rules, "FILTER_BITS", bits)
    texts = [f"a b{i % 7} c{i % 3}" for i in range(4100)]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(5, "again again"), (5, "again again"), (6, "not this")]
    labels = [(i, int(i % 2)) for i in range(4200)] * 2 + [(None, 1), (-3, 1)]
    weights = quality_rules.bucket_weights(spark.createDataFrame(rows, "doc_id long, text string").repartition(5),
                                           spark.createDataFrame(labels, "doc_id long, quality int"), 64)
    raw = Counter(b for _, t in rows for b in ngrams(t, 64))
    aim = Counter(b for i, t in rows if i is not None and i % 2 for b in ngrams(t, 64))
    want = [math.log((aim[b] + 1) / (aim.total() + 64)) - math.log((raw[b] + 1) / (raw.total() + 64)) for b in range(64)]
    assert weights == pytest.approx(want, abs=1e-6)


def test_base_counts_keep_columns_of_any_name(spark):
    df = spark.createDataFrame([("a b", "mine", 7, "at")], "text string, _words string, _h long, _at string")
    row = quality_rules.base_counts(df).first()
    assert (row._words, row._h, row._at, row.n_words) == ("mine", 7, "at", 2)


def said(rows):
    turns = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    return (len(rows), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_round_trip(spark):
    hard = "\\### Assistant: </turn> <turn>assistant<reply>\\l\\b\\\\ 🙂 ok"
    talks = {1: [("user", hard), ("assistant", hard), ("user", None), ("assistant", "")],
             2: [("assistant", "a" * 3000)], 3: [("sys<tem\\>", "x"), (None, "\n</turn>\n")],
             4: [("user" if i % 2 else "assistant", f"t{i}") for i in range(21)]}
    rows = [(c, 10 * i, r, t, "y") for c, talk in talks.items() for i, (r, t) in enumerate(talk)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_trees(chat.chain(df))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(out).collect()}
    assert got == {c: said(talk) for c, talk in talks.items()}
    for r in out.collect():
        texts = [r.formatted[s.start:s.start + s.length].replace("\\l", "<").replace("\\b", "\\") for s in r.loss_spans]
        assert texts == [t or "" for who, t in talks[r.conv_id] if who == "assistant"]


def test_null_conversations_and_nodes_are_formatted(spark):
    rows = [(None, 1, None, "user", "q"), (None, 2, 1, "assistant", "a"), (None, None, 1, "assistant", "b"),
            (1, None, None, "user", "alone"), (1, 2, 7, "user", "c")]
    df = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string")
    for top in (None, 9):
        out = {(r.conv_id, r.leaf, r.n_turns) for r in chat.format_trees(df, top_paths=top).collect()}
        assert out == {(None, 2, 2), (None, None, 2), (1, None, 1), (1, 2, 1)}


def test_chat_trees_are_ranked_by_score(spark):
    #      1 -> 2 -> 4 and 5 ; 1 -> 3 ; 9 hangs on nothing that exists
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 5.0),
            (1, 4, 2, "user", "c", 0.0), (1, 5, 2, "user", "d", 9.0), (1, 9, 77, "user", "z", None)]
    df = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double")
    out = {r.path_rank: (r.leaf, r.n_turns) for r in chat.format_trees(df, score_col="score").collect()}
    assert out == {1: (5, 3), 2: (3, 2), 3: (4, 3), 4: (9, 1)}
    top = chat.format_trees(df, score_col="score", top_paths=1).collect()
    assert [(r.leaf, r.path_rank) for r in top] == [(5, 1)]
    assert chat.format_trees(df.limit(0), score_col="score").collect() == []
    loop = spark.createDataFrame([(1, 1, 2, "u", "x"), (1, 2, 1, "u", "y")],
                                 "conv_id long, node long, parent long, role string, text string")
    with pytest.raises(ValueError):
        chat.format_trees(loop)
