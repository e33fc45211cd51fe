"""Main text of web pages: flat text blocks classified by a decision tree.

Method: the markup is read once from front to back and cut into flat blocks at every
block-level tag. A block has its word count, its link density (share of its words
inside links), the same of the block before and the block after, and what it stands
in: an article, boilerplate, both, or neither, and in the last case whether the page
has an article that holds more. A decision tree trained on the small labelled table
below tells which blocks are main text; these are joined in page order.

Boilerplate are menus, headers of the page, footers, sidebars, forms, adverts,
notices and comments, found by tag, role or class and id names. A name counts if all
its parts are known (``related-posts``, not ``related-work``). Inside an article a
name of the weaker kind decides nothing alone: such a block is both, and the tree goes
by its length and links. An article inside boilerplate counts as one again, unless it
stands in menus, footers, asides, comments or related links. A form that holds more
than half of the words of a page is no boilerplate.

Every page is worked on alone inside its input split: no shuffle, memory bounded by
one page, time in proportion to its length however broken the markup is (open
elements are found by name; where a tag fails to close is remembered).

Defined cases: null or empty html and pages without main text give the empty text;
broken markup is read as far as it goes (a ``<`` that opens no tag is text, an
unclosed comment, script or style runs to the end, an end tag without its start is
skipped); repeated rows give repeated results. Columns other than those named are
not read.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "page_id long, url string, text string, n_chars long"
_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

#: Labelled blocks: words, link density, words and link density of the block before,
#: the same of the block after, in an article (0/1), in boilerplate (0/1), in neither on a
#: page whose article holds more (0/1), label (1 main text). Blocks of invented pages of
#: different make: news, blog, shop, forum.
LABELLED = [
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0, 0), (2, 1.0, 1, 1.0, 2, 1.0, 0, 1, 0, 0), (3, 1.0, 2, 1.0, 6, 0.0, 0, 1, 0, 0),
    (9, 0.0, 1, 1.0, 8, 0.0, 0, 1, 0, 0), (60, 0.0, 3, 1.0, 12, 0.0, 0, 1, 0, 0), (25, 0.1, 40, 0.0, 5, 1.0, 0, 1, 0, 0),
    (120, 0.0, 80, 0.0, 30, 0.0, 0, 1, 0, 0), (4, 0.5, 0, 0.0, 4, 0.5, 0, 1, 0, 0), (45, 0.9, 10, 0.2, 3, 1.0, 0, 1, 0, 0),
    (30, 0.0, 90, 0.0, 80, 0.0, 0, 1, 0, 0), (75, 0.1, 20, 0.0, 0, 0.0, 0, 1, 0, 0), (18, 0.0, 0, 0.0, 45, 0.0, 0, 1, 0, 0),
    (8, 0.0, 0, 0.0, 50, 0.0, 1, 0, 0, 1), (50, 0.0, 8, 0.0, 70, 0.0, 1, 0, 0, 1), (70, 0.02, 50, 0.0, 5, 0.0, 1, 0, 0, 1),
    (3, 0.0, 70, 0.0, 60, 0.0, 1, 0, 0, 1), (1, 0.0, 60, 0.0, 1, 0.0, 1, 0, 0, 1), (1, 0.0, 1, 0.0, 0, 0.0, 1, 0, 0, 1),
    (2, 0.0, 9, 0.0, 2, 0.0, 1, 0, 0, 1), (4, 0.0, 2, 1.0, 90, 0.0, 1, 0, 0, 1), (5, 0.0, 1, 1.0, 3, 0.0, 1, 0, 0, 1),
    (1, 0.0, 1, 1.0, 7, 0.2, 1, 0, 0, 1), (2, 0.0, 6, 0.0, 8, 0.0, 1, 0, 0, 1), (3, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1),
    (6, 0.0, 2, 1.0, 8, 0.0, 1, 0, 0, 1), (90, 0.3, 20, 0.0, 40, 0.1, 1, 0, 0, 1), (12, 0.4, 90, 0.0, 30, 0.0, 1, 0, 0, 1),
    (15, 0.5, 60, 0.0, 40, 0.0, 1, 0, 0, 1), (4, 0.5, 80, 0.0, 35, 0.0, 1, 0, 0, 1),
    (1, 0.0, 3, 1.0, 4, 1.0, 1, 0, 0, 1), (2, 0.0, 2, 1.0, 2, 1.0, 1, 0, 0, 1), (3, 0.0, 4, 1.0, 5, 0.0, 1, 0, 0, 1),
    (4, 0.0, 1, 1.0, 4, 0.0, 1, 0, 0, 1), (5, 0.0, 12, 0.0, 3, 0.0, 1, 0, 0, 1), (6, 0.0, 20, 0.0, 2, 1.0, 1, 0, 0, 1),
    (9, 0.0, 5, 0.0, 1, 1.0, 1, 0, 0, 1), (1, 0.0, 75, 0.0, 3, 0.0, 1, 0, 0, 1), (2, 0.0, 4, 0.0, 4, 0.0, 1, 0, 0, 1),
    (7, 0.0, 8, 0.0, 10, 0.9, 1, 0, 0, 1), (30, 0.1, 5, 1.0, 5, 1.0, 1, 0, 0, 1), (55, 0.0, 7, 0.8, 3, 1.0, 1, 0, 0, 1),
    (3, 0.0, 10, 0.0, 4, 0.0, 1, 0, 0, 1), (20, 0.0, 4, 0.0, 4, 0.0, 1, 0, 0, 1), (11, 0.4, 16, 0.5, 4, 1.0, 1, 0, 0, 1),
    (100, 0.0, 5, 1.0, 4, 1.0, 1, 0, 0, 1), (1, 0.0, 2, 0.0, 4, 0.4, 1, 0, 0, 1), (4, 0.0, 5, 0.5, 0, 0.0, 1, 0, 0, 1),
    (2, 1.0, 40, 0.0, 2, 1.0, 1, 0, 0, 0), (5, 1.0, 60, 0.0, 4, 1.0, 1, 0, 0, 0), (3, 0.9, 3, 1.0, 0, 0.0, 1, 0, 0, 0),
    (14, 0.9, 3, 1.0, 6, 1.0, 1, 0, 0, 0), (8, 1.0, 8, 1.0, 9, 1.0, 1, 0, 0, 0),
    (40, 0.0, 6, 0.0, 55, 0.0, 0, 0, 0, 1), (80, 0.05, 40, 0.0, 60, 0.0, 0, 0, 0, 1), (30, 0.0, 80, 0.0, 4, 1.0, 0, 0, 0, 1),
    (18, 0.1, 50, 0.0, 60, 0.0, 0, 0, 0, 1), (8, 0.0, 45, 0.0, 50, 0.0, 0, 0, 0, 1), (5, 0.0, 30, 0.0, 40, 0.0, 0, 0, 0, 1),
    (22, 0.0, 3, 1.0, 35, 0.0, 0, 0, 0, 1), (60, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (35, 0.2, 25, 0.0, 2, 0.0, 0, 0, 0, 1),
    (6, 1.0, 0, 0.0, 60, 0.0, 0, 0, 0, 0), (1, 1.0, 1, 1.0, 80, 0.0, 0, 0, 0, 0), (10, 0.9, 5, 1.0, 45, 0.0, 0, 0, 0, 0),
    (15, 0.8, 30, 0.0, 50, 0.1, 0, 0, 0, 0), (4, 0.9, 60, 0.0, 70, 0.0, 0, 0, 0, 0),
    (2, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (1, 1.0, 2, 1.0, 1, 1.0, 0, 0, 0, 0), (6, 0.8, 4, 1.0, 7, 0.9, 0, 0, 0, 0),
    (30, 0.9, 5, 1.0, 20, 0.8, 0, 0, 0, 0), (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0), (4, 0.0, 1, 1.0, 3, 1.0, 0, 0, 0, 0),
    (5, 0.0, 3, 0.0, 4, 0.0, 0, 0, 0, 0), (7, 0.3, 5, 0.6, 6, 0.7, 0, 0, 0, 0), (6, 0.0, 40, 0.0, 2, 1.0, 0, 0, 0, 0),
    (3, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (2, 0.0, 3, 0.0, 0, 0.0, 0, 0, 0, 0), (12, 0.6, 30, 0.0, 8, 0.9, 0, 0, 0, 0),
    # a name of the weaker kind inside an article
    (60, 0.0, 50, 0.0, 40, 0.0, 1, 1, 0, 1), (45, 0.1, 80, 0.0, 60, 0.0, 1, 1, 0, 1), (90, 0.05, 3, 0.0, 70, 0.0, 1, 1, 0, 1),
    (35, 0.0, 4, 0.0, 50, 0.0, 1, 1, 0, 1), (30, 0.1, 60, 0.0, 2, 1.0, 1, 1, 0, 1), (120, 0.0, 0, 0.0, 0, 0.0, 1, 1, 0, 1),
    (12, 0.0, 60, 0.0, 50, 0.0, 1, 1, 0, 0), (8, 0.5, 50, 0.0, 4, 0.8, 1, 1, 0, 0), (5, 1.0, 70, 0.0, 6, 1.0, 1, 1, 0, 0),
    (3, 0.0, 80, 0.0, 40, 0.0, 1, 1, 0, 0), (20, 0.6, 60, 0.0, 30, 0.0, 1, 1, 0, 0), (40, 0.9, 30, 0.0, 9, 1.0, 1, 1, 0, 0),
    (10, 0.0, 40, 0.0, 0, 0.0, 1, 1, 0, 0), (15, 0.0, 90, 0.0, 8, 0.0, 1, 1, 0, 0), (6, 0.0, 0, 0.0, 60, 0.0, 1, 1, 0, 0),
    # a paragraph that is a link, between others or at the end of an article
    (6, 1.0, 60, 0.0, 50, 0.0, 1, 0, 0, 1), (3, 1.0, 40, 0.0, 70, 0.0, 1, 0, 0, 1), (9, 1.0, 80, 0.1, 30, 0.0, 1, 0, 0, 1),
    (12, 0.9, 20, 0.0, 25, 0.0, 1, 0, 0, 1), (2, 1.0, 90, 0.0, 60, 0.0, 1, 0, 0, 1), (5, 1.0, 30, 0.0, 0, 0.0, 1, 0, 0, 1),
    # a few words before the text of a page without containers
    (3, 0.0, 0, 0.0, 60, 0.0, 0, 0, 0, 0), (4, 0.0, 0, 0.0, 45, 0.0, 0, 0, 0, 0), (3, 0.0, 0, 0.0, 90, 0.0, 0, 0, 0, 0),
    (2, 0.0, 0, 0.0, 70, 0.0, 0, 0, 0, 0), (8, 0.0, 0, 0.0, 50, 0.0, 0, 0, 0, 1), (7, 0.0, 0, 0.0, 80, 0.0, 0, 0, 0, 1),
    (10, 0.0, 0, 0.0, 60, 0.0, 0, 0, 0, 1),
    # outside the article that holds more
    (3, 0.0, 0, 0.0, 60, 0.0, 0, 0, 1, 0), (40, 0.0, 6, 0.0, 55, 0.0, 0, 0, 1, 0), (80, 0.0, 30, 0.0, 60, 0.0, 0, 0, 1, 0),
    (5, 1.0, 0, 0.0, 5, 1.0, 0, 0, 1, 0), (8, 0.0, 45, 0.0, 50, 0.0, 0, 0, 1, 0), (20, 0.1, 90, 0.0, 0, 0.0, 0, 0, 1, 0),
    (12, 0.0, 5, 0.0, 9, 1.0, 0, 0, 1, 0), (60, 0.1, 8, 0.0, 3, 0.0, 0, 0, 1, 0),
]

_BLOCK_TAGS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe li main menu nav noscript ol option p pre "
    "section select summary table tbody td tfoot th thead title tr ul".split())
_VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED_TAGS = frozenset("script style noscript template svg math textarea select button title head iframe object".split())
_RAW_TAGS = ("script", "style", "textarea", "title", "iframe", "noscript", "template")
_INLINE_TAGS = frozenset("p b i em strong span u font".split())
_BOILER_TAGS = frozenset("nav footer aside form menu dialog".split())
#: boilerplate in which an article is none
_CLOSED_TAGS = frozenset("nav footer aside menu dialog".split())
_CLOSED_ROLES = frozenset("navigation contentinfo complementary dialog alertdialog menu menubar".split())
_MAIN_TAGS = frozenset(("article", "main"))
_BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
#: parts of class and id names that tell boilerplate; those of adverts and comments do so anywhere
_BOILER_PARTS = frozenset(
    "banner cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup login sidebar "
    "sidebars side widget widgets related recommended share sharing social breadcrumb breadcrumbs nav navbar navigation menu footer "
    "masthead toolbar pagination pager discussion search tags skip copyright legal disclaimer promo promotion".split())
_ADVERT_PARTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored".split())
_COMMENT_PARTS = frozenset(
    "comment comments commentlist disqus replies respond response responses feedback talkback talkbacks guestbook".split())
_CLOSED_PARTS = frozenset("related recommended nav navbar navigation menu footer".split())
#: parts that say nothing: a name of these and boilerplate parts is boilerplate
_NEUTRAL_PARTS = frozenset(
    "site page main top bottom left right upper lower header head box block area list lists link links item items wrapper wrap "
    "container inner outer bar section form button buttons icon icons title panel slot unit global primary secondary mobile "
    "desktop article articles post posts entry entries story stories blog news user users reader readers visitor customer "
    "content body text row col column group media network networks center small large fixed sticky js the my a".split())
_MAIN_NAME = re.compile(
    r"(?:^|[\s_-])(?:article|story|post|entry|content|main)(?:[\s_-]?(?:body|content|text))?(?:$|[\s_-])", re.I)
#: names that say what a wrapper has, not what it is
_MODIFIER = re.compile(
    r"(?:(?<!\S)|(?<=[_-]))(?:has|with|without|no)[_-]+\S+|(?<!\S)comments?[_-](?:open|closed|on|off|enabled|disabled)(?!\S)", re.I)
_LAYOUT = re.compile(r"(?<!\S)(?:page|layout|site|wrapper|wrap)(?!\S)", re.I)
_SIDES = re.compile(r"(?<!\S)(?:sidebars?[_-](?:left|right|both|none|one|two)|(?:left|right|both|one|two)[_-]sidebars?)(?!\S)", re.I)
#: a tag without ``<`` or ``>`` in its quotes
_PLAIN_TAG = re.compile(r"</?[a-zA-Z](?:[^<>\"']|\"[^\"<>]*\"|'[^'<>]*')*+>")
_DELIMITER = re.compile("[<>\"']")
_NAME = re.compile(
    r"(?:^|[\s_-])(?:article|story|post|entry|content|main)(?:[\s_-]?(?:body|content|text))?(?:$|[\s_-])", re.I)
#: names that say what a wrapper has, not what it is
_MODIFIER = re.compile(
    r"(?:(?<!\S)|(?<=[_-]))(?:has|with|without|no)[_-]+\S+|(?<!\S)comments?[_-](?:open|closed|on|off|enabled|disabled)(?!\S)", re.I)
_LAYOUT = re.compile(r"(?<!\S)(?:page|layout|site|wrapper|wrap)(?!\S)", re.I)
_SIDES = re.compile(r"(?<!\S)(?:sidebars?[_-](?:left|right|both|none|one|two)|(?:left|right|both|one|two)[_-]sidebars?)(?!\S)", re.I)
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?|</?[a-zA-Z][^\s/>]*(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>|</?[a-zA-Z][^<>]*>", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WHITE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    kind: int
    form: int = -1


#: what a block stands in: nothing known, an article, boilerplate, a weaker boilerplate name in an article
NONE, ARTICLE, BOILER, NAMED = 0, 1, 2, 3
#: kinds while a page is read: boilerplate in which articles are none, a form in no container, a form in an article
_CLOSED, _FORM, _MAIN_FORM = 4, 5, 6


def _named(value: str) -> int | None:
    """What a class or id says: comments, adverts or boilerplate of some kind, or nothing (None)."""
    weak = None
    for token in value.lower().split():
        parts = [p for p in re.split(r"[_\d-]+", token) if p]
        if any(p in _COMMENT_PARTS for p in parts) and all(p in _COMMENT_PARTS | _NEUTRAL_PARTS | _BOILER_PARTS for p in parts):
            return _CLOSED
        known = [p for p in parts if p in _BOILER_PARTS or p in _ADVERT_PARTS]
        if known and all(p in _NEUTRAL_PARTS for p in parts if p not in known):
            if any(p in _ADVERT_PARTS for p in known):
                return BOILER
            weak = _CLOSED if any(p in _CLOSED_PARTS for p in known) or weak == _CLOSED else NAMED
    return weak


def _container(name: str, tag: str, inside: int, in_main: bool) -> int:
    """Kind of the container a tag opens: -1 skipped, or one of the kinds above."""
    if name in _SKIPPED_TAGS:
        return -1
    if name in _CLOSED_TAGS:
        return _CLOSED
    if name == "form" and inside in (NONE, ARTICLE):
        return _MAIN_FORM if inside else _FORM
    if name in _BOILER_TAGS or name == "header" and not in_main:
        return BOILER
    kind = ARTICLE if name in _MAIN_TAGS else inside
    if "=" in tag or "hidden" in tag:
        for key, a, b, c in _ATTRIBUTE.findall(tag):
            key, value = key.lower(), a or b or c
            if key == "hidden" and not value or key == "aria-hidden" and value.lower() == "true":
                return -1
            if key == "style" and re.search(r"display\s*:\s*none", value, re.I):
                return -1
            if key == "role" and value.lower() in _BOILER_ROLES:
                return _CLOSED if value.lower() in _CLOSED_ROLES else BOILER
            if key == "role" and value.lower() in ("main", "article"):
                kind = ARTICLE
            if key in ("class", "id") and name not in ("html", "body"):
                value = _MODIFIER.sub(" ", value)
                if _LAYOUT.search(value):
                    value = _SIDES.sub(" ", value)
                said = None if name in _MAIN_TAGS else _named(value)
                if said == NAMED and inside in (ARTICLE, NAMED):
                    kind = NAMED
                elif said is not None:
                    return BOILER if said == NAMED else said
                elif _MAIN_NAME.search(value):
                    kind = {BOILER: BOILER, NAMED: NAMED, _FORM: _MAIN_FORM, _MAIN_FORM: _MAIN_FORM}.get(kind, ARTICLE)
    return kind


class _Tokens:
    """Front-to-back reader of a page: (text before, tag) pairs, each character looked at a few times at most."""

    def __init__(self, page: str) -> None:
        self.page, self.at = page, 0
        self.next_gt = -2          # the first '>' at or after the place last asked for
        self.dead: set[int] = set()  # delimiters outside quotes from which no tag closes
        self.last = {q: page.rfind(q) for q in "\"'"}
        self.cdata_end = page.rfind("]]>")

    def _gt(self, at: int) -> int:
        if self.next_gt != -1 and self.next_gt < at:
            self.next_gt = self.page.find(">", at)
        return self.next_gt

    def _tag_end(self, start: int) -> int:
        """End of the tag that opens at ``start``, or -1."""
        page, at, seen = self.page, start + 1, []
        while True:
            found = _DELIMITER.search(page, at)
            if found is None or found.start() in self.dead or found.group() == "<":
                self.dead.update(seen)
                break
            at = found.end()
            if found.group() == ">":
                return at
            seen.append(found.start())
            if at <= self.last[found.group()]:  # a quote that closes; one that does not is a character
                at = page.find(found.group(), at) + 1
        gt, lt = self._gt(start), page.find("<", start + 1)
        return gt + 1 if gt >= 0 and (lt < 0 or gt < lt) else -1

    def __iter__(self) -> Iterator[tuple[str, str]]:
        page, n, said = self.page, len(self.page), 0
        while True:
            start = page.find("<", self.at)
            if start < 0:
                yield page[said:], ""
                return
            follow = page[start + 1:start + 2]
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                end = n if end < 0 else end + 3
            elif page.startswith("<![CDATA[", start) and start <= self.cdata_end:
                end = page.find("]]>", start) + 3
            elif follow in ("!", "?") and follow:
                end = self._gt(start) + 1 or n
            elif follow.isascii() and follow.isalpha() or follow == "/" and page[start + 2:start + 3].isascii() and page[start + 2:start + 3].isalpha():
                found = _PLAIN_TAG.match(page, start)
                end = found.end() if found else self._tag_end(start)
            else:
                end = -1
            if end < 0:  # text
                self.at = start + 1
                continue
            self.at = end
            yield page[said:start], page[start:end]
            said = self.at  # the reader may have moved on past raw text


class _Open:
    """The open elements, with the places of each name and of the elements a stray end tag does not leave."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = {}
        self.walls: list[int] = []
        self.mains = 0

    def push(self, name: str, kind: int) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name in _BOILER_TAGS or name in _MAIN_TAGS:
            self.walls.append(len(self.stack))
            self.mains += name in _MAIN_TAGS
        self.stack.append((name, kind))

    def pop(self) -> None:
        name, _ = self.stack.pop()
        self.places[name].pop()
        if self.walls and self.walls[-1] == len(self.stack):
            self.walls.pop()
            self.mains -= name in _MAIN_TAGS

    def count(self, name: str) -> int:
        return len(self.places.get(name, ()))

    def match(self, name: str) -> int:
        """Place of the element an end tag closes, or -1."""
        places = self.places.get(name)
        if not places or name not in ("body", "html") and self.walls and places[-1] < self.walls[-1]:
            return -1
        return places[-1]

    @property
    def kind(self) -> int:
        return self.stack[-1][1] if self.stack else NONE


def blocks(page: str | None) -> list[Block]:
    """Flat text blocks of a page in their order."""
    out: list[Block] = []
    opened = _Open()
    kind, text, linked = NONE, [], []
    form, forms = -1, 0  # number of the open form

    def flush() -> None:
        if text:
            clean = _WHITE.sub(" ", html_lib.unescape("".join(text))).strip()
            if clean:
                links = _WHITE.sub(" ", html_lib.unescape(" ".join(linked))).strip()
                out.append(Block(clean, clean.count(" ") + 1, links.count(" ") + 1 if links else 0, kind, form))
            text.clear()
            linked.clear()

    def say(piece: str) -> None:
        if piece and kind >= 0:
            text.append(piece)
            if opened.count("a"):
                linked.append(piece)

    page = page or ""
    tokens = _Tokens(page)
    for before, tag in tokens:
        say(before)
        if not tag:
            break
        if tag[1] in "!?":
            if tag.startswith("<![CDATA[") and tag.endswith("]]>"):
                say(tag[9:-3])
            continue
        name = _NAME.match(tag).group(1).lower()
        if tag[1] != "/":
            if name in _RAW_TAGS:  # its text is not markup
                end = re.compile(rf"</{name}\s*>", re.I).search(page, tokens.at)
                tokens.at = end.end() if end else len(page)
                if name in _BLOCK_TAGS:
                    flush()
                continue
            if name in _BLOCK_TAGS:
                flush()
            elif name in ("img", "input"):
                continue
            if name in _VOID_TAGS or tag.endswith("/>") and name not in _BLOCK_TAGS:
                continue
            if name == "p":  # a paragraph ends where the next one begins
                while opened.stack and opened.stack[-1][0] in _INLINE_TAGS and any(x == "p" for x, _ in opened.stack[-8:]):
                    opened.pop()
                kind = opened.kind
            inside = kind if kind in (-1, _CLOSED) else _container(
                name, tag, kind if name != "form" or form < 0 else BOILER, name == "header" and opened.mains > 0)
            if inside != kind:
                flush()
            if name == "form" and form < 0:
                form, forms = forms, forms + 1
            opened.push(name, inside)
            kind = inside
        else:
            if name in _BLOCK_TAGS:
                flush()
            place = opened.match(name)
            if place >= 0:
                outer = opened.stack[place - 1][1] if place else NONE
                if outer != kind:
                    flush()
                while len(opened.stack) > place:
                    opened.pop()
                kind = outer
                if form >= 0 and not opened.count("form"):
                    form = -1
    flush()
    if forms:
        words = [0] * (forms + 1)  # the last of what stands in no form
        for b in out:
            words[b.form] += b.words
        article = any(b.kind in (ARTICLE, NAMED) and b.form < 0 for b in out)
        for b in out:
            if b.kind in (_FORM, _MAIN_FORM):
                wide = 2 * words[b.form] > sum(words) and (b.kind == _MAIN_FORM or not article)
                b.kind = (ARTICLE if b.kind == _MAIN_FORM else NONE) if wide else BOILER
    for b in out:
        b.kind = BOILER if b.kind > NAMED else b.kind
    return out


def block_features(found: list[Block]) -> np.ndarray:
    """Words and link density of each block and of its neighbours, and what it stands in."""
    own = np.array([(b.words, min(1.0, b.linked / b.words)) for b in found], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    inside, outside = (sum(b.words for b in found if b.kind == k) for k in (ARTICLE, NONE))
    more = inside > 0 and inside >= outside
    return np.hstack([own, np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge]),
                      np.array([(b.kind in (ARTICLE, NAMED), b.kind in (BOILER, NAMED), more and b.kind == NONE)
                                for b in found], float).reshape(-1, 3)])


class DecisionTree:
    """Binary decision tree grown by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 7) -> None:
        self.feature, self.cut = -1, 0.0
        self.share = float(y.mean())
        if depth == 0 or self.share in (0.0, 1.0):
            return
        best = self._gini(y)
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= cut
                impurity = (left.mean() * self._gini(y[left]) + (~left).mean() * self._gini(y[~left]))
                if impurity < best - 1e-9:
                    best, self.feature, self.cut = impurity, f, float(cut)
        if self.feature >= 0:
            left = x[:, self.feature] <= self.cut
            self.left = DecisionTree(x[left], y[left], depth - 1)
            self.right = DecisionTree(x[~left], y[~left], depth - 1)

    @staticmethod
    def _gini(y: np.ndarray) -> float:
        p = float(y.mean())
        return 2 * p * (1 - p)

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.share >= 0.5)
        left = x[:, self.feature] <= self.cut
        out = np.empty(len(x), bool)
        out[left], out[~left] = self.left.predict(x[left]), self.right.predict(x[~left])
        return out


def train_tree(labelled: list[tuple] = LABELLED) -> DecisionTree:
    table = np.array(labelled, float)
    return DecisionTree(table[:, :-1], table[:, -1])


def main_text(page: str | None, tree: DecisionTree) -> str:
    found = blocks(page)
    if not found:
        return ""
    keep = tree.predict(block_features(found))
    return "\n\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame, labelled: list[tuple] = LABELLED, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points of the text) of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = train_tree(labelled)
        for batch in batches:
            texts = [main_text(x, tree) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array(list(map(len, texts)), pa.int64())], schema=_ARROW)

    picked = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                          F.col(html_col).cast("string").alias("html"))
    return picked.mapInArrow(run, SCHEMA)
