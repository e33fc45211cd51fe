"""BPE encoding and decoding by a tokenization automaton.

Method: the automaton over tokens that accepts exactly the correct tokenizations.
It starts as one state with a loop for every base symbol. Merges are then applied
in order, each by a merge gadget: for the merge (u, v) -> w, the state that the
u-arcs lead to is copied without its v-arc, the u-arcs lead to the copy, and a
w-arc runs from every state with a u-arc to where v led. All arcs of one token lead
to one state, so the automaton is held as that target state per token, and a state
as its chain of copies: (state it was copied from, token it forbids, merge number).
A token is missing from a state if the chain forbids it, or forbids the first part
that it was built from before it was built.

Each pre-split word has exactly one accepted path, and the path of a prefix is a
prefix of the path; so a word is encoded left to right along arcs of the automaton,
stepping back where none goes on. Arcs looked up are kept in a table of transitions.
Decoding emits the label of each arc.

Text is normalised as the tokenizer file says (NFC, lower case) and cut by its
pattern; words of white-space-free text repeat, so their result is kept in a
bounded memo. Rows are independent: no shuffle, memory bounded by one text.

Defined cases: null or empty text has no ids and decodes to the empty string; the
strings of special tokens inside a text become those tokens; repeated rows give
repeated results; columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import slices
from ledgerlens.llm.tokens import Memo, byte_chars, public_path

MEMO_WORDS = 250_000
#: entries of the table of looked-up transitions
TABLE_ENTRIES = 400_000
#: symbols by which the length of the longest token is looked up
HEAD = 5
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                    ("decoded_sha256", pa.string())])
#: white space as the tokenizers library has it (Python's also has U+001C..U+001F)
_SPACE = "\t-\r \x85\xa0  -     　"
_CONTROL = re.compile("[\x1c-\x1f]")
_automata: dict[str, "TokenAutomaton"] = {}


class TokenAutomaton:
    """The automaton of a BPE merge list over symbols (strings)."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        self.vocab, self.suffix = dict(vocab), suffix
        n = max(vocab.values(), default=0) + 1
        self.target = [0] * n        # state that the arcs of a token lead to
        self.parent = [0]            # of a state: the state it was copied from,
        self.forbids = [-1]          # the token whose arc the copy lacks,
        self.since = [-1]            # and the merge that made it
        self.first = [-1] * n        # the first part of a token, and the merge that built it
        self.built = [-1] * n
        for k, (u, v) in enumerate(merges):
            if not self._gadget(k, vocab[u], vocab[v], vocab[u + v]):
                del self.vocab[u + v]
        self.table: dict[int, bool] = {}
        self.reach: dict[str, int] = {}  # first symbols: those of the longest token that begins so
        for t in self.vocab:
            t = t.removesuffix(suffix)
            if len(t) >= HEAD:
                self.reach[t[:HEAD]] = max(len(t), self.reach.get(t[:HEAD], 0))

    def _gadget(self, k: int, u: int, v: int, w: int) -> bool:
        """Apply merge number k; False if no v-arc follows a u-arc, so that w never comes about."""
        if not self.has_arc(self.target[u], v):
            return False
        led = self.target[v]  # where v led before, also when u and v are the same token
        self.parent.append(self.target[u])
        self.forbids.append(v)
        self.since.append(k)
        self.target[u] = len(self.parent) - 1
        self.target[w] = led
        self.first[w], self.built[w] = u, k
        return True

    def has_arc(self, state: int, token: int) -> bool:
        """Whether the state has an arc with the token (by its chain of copies)."""
        firsts = {token: 1 << 60}  # token and its first parts: the merge that built on each
        at = token
        while self.first[at] >= 0:
            firsts[self.first[at]] = self.built[at]
            at = self.first[at]
        while state:
            if self.since[state] <= firsts.get(self.forbids[state], -1):
                return False
            state = self.parent[state]
        return True

    def encode(self, symbols: str) -> list[int]:
        """Ids of one pre-split word given as base symbols; the last one carries the suffix.

        The accepted path is unique, so it does not matter in which order arcs are
        tried: the longest token comes first, and a place from which no arc goes on
        is left again and not entered a second time.
        """
        n, vocab, target, reach, table = len(symbols), self.vocab.get, self.target, self.reach.get, self.table
        suffix, short = self.suffix, HEAD - 1
        whole = vocab(symbols + suffix)
        if whole is not None and (n == 1 or self.first[whole] >= 0):
            return [whole]
        path: list[tuple[int, int]] = []  # place and token of each arc taken
        at, state, size, dead = 0, 0, min(n, reach(symbols[:HEAD], short)), set()
        while at < n:
            while size:
                stop = at + size
                token = vocab(symbols[at:stop] + suffix if stop == n else symbols[at:stop])
                if token is not None and (stop, target[token]) not in dead:
                    if not at:
                        break
                    key = state << 24 | token
                    if (ok := table.get(key)) is None:
                        ok = self._look_up(key, state, token)
                    if ok:
                        break
                size -= 1
            else:
                if not path:
                    raise ValueError("a symbol that the vocabulary lacks")
                dead.add((at, state))
                stop = at
                at, token = path.pop()
                state, size = target[path[-1][1]] if path else 0, stop - at - 1
                continue
            path.append((at, token))
            at, state = stop, target[token]
            size = min(n - at, reach(symbols[at:at + HEAD], short))
        return [token for _, token in path]

    def _look_up(self, key: int, state: int, token: int) -> bool:
        if len(self.table) >= TABLE_ENTRIES:
            self.table.clear()
        got = self.table[key] = self.has_arc(state, token)
        return got


class WordBpe:
    """Whole texts to ids and back, for a word-end BPE tokenizer file."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        if steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None or not self.suffix:
            raise ValueError(f"{path}: not a word-end BPE of the known kind")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\\s", _SPACE)
        self.split = regex.compile(split).findall
        self.cut = regex.compile(f"[^{_SPACE}]+").findall
        self.automaton = TokenAutomaton(model["vocab"], [tuple(m) for m in model["merges"]], self.suffix)
        self.label = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.symbols = byte_chars()
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pieces = Memo(self._piece, memo_words)
        self.words = Memo(self._word, memo_words)

    def _piece(self, piece: str) -> list[int]:
        """Ids of one pre-split word (lower case)."""
        if not piece.isascii():
            piece = "".join([self.symbols[b] for b in piece.encode()])
        elif not piece.isalnum():
            piece = piece.translate(self.symbols)
        return self.automaton.encode(piece)

    def _word(self, word: str) -> tuple[int, str, str]:
        """Number of ids, ids and labels (each joined by a space) of a run without white space."""
        if not word.isascii():
            word = unicodedata.normalize("NFC", word)
        low = word.lower() if "Σ" not in word else "".join(c.lower() for c in word)
        ids = [i for p in self.split(low) for i in self.pieces[p]]
        return len(ids), " ".join(map(str, ids)), " ".join([self.label[i] for i in ids])

    def parts(self, text: str | None) -> list[tuple[int, str, str]]:
        """(number of ids, ids, labels) of the white-space-free runs and special tokens of a text."""
        if not text:
            return []
        out = []
        cut = self.specials.split(text) if self.specials and "<|" in text else [text]
        for piece in cut:
            if piece in self.special:
                out.append((1, str(self.special[piece]), piece))
            else:
                out += map(self.words.__getitem__, self.cut(piece) if _CONTROL.search(piece) else piece.split())
        return [x for x in out if x[0]]

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for _, ids, _ in self.parts(text) for i in ids.split(" ")]

    def decode(self, ids: list[int]) -> str:
        """Labels of the arcs, joined by spaces (the file has no decoder)."""
        return " ".join(self.label[i] for i in ids if i in self.label)


def word_bpe(path: str) -> WordBpe:
    """The compiled tokenizer of this Python worker."""
    if path not in _automata:
        _automata[path] = WordBpe(path)
    return _automata[path]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _digest_task(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(public_path(tokenizer))
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for text in part.column("text").to_pylist():
                    parts = bpe.parts(text)
                    rows.append((sum(x[0] for x in parts), _sha(" ".join([x[1] for x in parts])),
                                 _sha(" ".join([x[2] for x in parts]))))
                n, ids, decoded = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)], schema=_ARROW)

    return run


def _encode_task(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(public_path(tokenizer))
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [bpe.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32())),
                     pa.array(map(bpe.decode, ids), pa.string())], names=["doc_id", "ids", "decoded"])

    return run


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Ids and decoded text of every document."""
    return _picked(docs, id_col, text_col).mapInArrow(
        _encode_task(tokenizer), "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Count of ids, and SHA-256 of the ids and of the decoded text, of every document."""
    return _picked(docs, id_col, text_col).mapInArrow(_digest_task(tokenizer), SCHEMA)
