"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level tags. Blocks inside menus, footers, forms and the like, or inside
elements whose class, id or role names such a part, are bad. The first pass decides the others by link
density, length and density of stop words; short blocks, those in between and those without stop words stay open. In the second pass open
blocks inherit the label of the nearest decided neighbours inside the same article. All blocks of a page take part; an article
only counts as good at its edges, and not even so if more good text stands outside of articles than text inside. Where good
blocks hold less text than the other long ones, the lists of stop words do not fit the page, and long
blocks are judged by length and link density alone.

Defined results: null and empty pages give empty text; unclosed and stray tags are tolerated; character references are
decoded as HTML5 says; pages without any decided block keep their open blocks; repeated rows are rows like others.
"""
from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT = 70  # characters up to which a block is undecided
LINKS = 0.5  # share of characters in links from which a block is bad
STOP_GOOD, STOP_SOME = 0.30, 0.12  # densities of stop words

# Frequent function words of the languages at hand.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his i if in into is it its not of on or she so that the their "
    "they this to was we were what which who will with you "
    "aber als am auch auf aus bei bin das dass dem den der des die durch ein eine einem einen einer er es für hat ich ihr im ist "
    "kein man mit nach nicht noch nur oder sich sie sind über um und uns von vor war wenn wie wir zu zum zur "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou où par pas plus pour "
    "qu que qui sa se ses son sont sur un une vous "
    "al ante como con cuando del desde el ella ellos entre era es esta este ha hay la las lo los mi muy más no o para pero por "
    "porque que se si sin sobre su sus también una uno y ya".split())
# Elements by their role in HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong sub sup time tt u var".split())
SKIPPED = frozenset("aside button datalist dialog fieldset footer form head menu nav select".split())
RAW = "script|style|noscript|template|svg|textarea|iframe|object|title|math|canvas|audio|video"
ELEMENTS = BLOCKS | VOID | INLINE | SKIPPED | frozenset(RAW.split("|"))
ENDS_P = BLOCKS - {"html", "body"}
# Words in class, id or role that name parts beside the article.
BESIDE = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist complementary consent "
    "contentinfo cookie cookies copyright dialog disqus footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter "
    "notice notices notification pager pagination popup promo promotion recommended related reply replies respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe tagcloud toolbar topbar widget".split())

# Of compound names, the last part says what it is, unless it only says where or how; then the first one does.
PARTS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies footer menu modal nav navbar navigation "
    "newsletter notice notices pagination popup promo sidebar social subscribe toolbar widget".split())
FRAMES = frozenset(
    "area bar block body bottom box button buttons container content group inner item items left list links main outer panel posts right row section "
    "slot top wrap wrapper".split())

# Attributes as HTML reads them: a quote opens a value behind "=" only, a value without quotes ends at white space. No part is tried twice.
_ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+"""
_TOKEN = re.compile(
    rf"<(?:!--.*?(?:-->|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|(?P<raw>{RAW})(?=[\s/>]){_ATTRS}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>{_ATTRS})>|[!?/][^>]*>)", re.S | re.I)
_OPENS = re.compile(r"</?[a-zA-Z]|<[!?]")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_NAMED = re.compile(r"(?:^|[\s\"'/])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[^\W\d_]+").findall
_WIDE = re.compile(r"[\u2e80-\uffdc\U00020000-\U0003ffff]").findall  # a character that says as much as two letters


def _names_beside(name: str) -> bool:
    """Whether one word of a class, id or role names a part beside the article."""
    parts = re.split(r"[-_]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower().strip("-_"))
    if len(parts) == 1:
        return parts[0] in BESIDE
    return "".join(parts) in BESIDE or parts[-1] in PARTS or (
        parts[0] in BESIDE - {"header", "hidden"} and all(x in FRAMES for x in parts[1:]))


def _is_beside(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in SKIPPED or tag == "header" and not in_article:
        return True
    if not attrs or tag in ("html", "body", "main", "article"):
        return False
    return any(_names_beside(name) for m in _NAMED.findall(attrs) for x in m for name in x.split())


class _Open:
    """The open elements of a page: every question is answered by counters, whatever the depth."""

    def __init__(self):
        self.stack: list[tuple[str, bool, int]] = []  # tag, skipped, article
        self.counts: Counter[str] = Counter()
        self.blocks: list[int] = []  # places of block elements in the stack

    def top(self) -> tuple[str, bool, int]:
        return self.stack[-1] if self.stack else ("", False, 0)

    def push(self, tag: str, skipped: bool, article: int) -> None:
        if tag in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, skipped, article))
        self.counts[tag] += 1

    def cut(self, length: int) -> None:
        """Close all elements from a place on."""
        while len(self.stack) > length:
            self.counts[self.stack.pop()[0]] -= 1
        while self.blocks and self.blocks[-1] >= length:
            self.blocks.pop()

    def close(self, tag: str) -> None:
        if self.counts[tag]:
            at = len(self.stack) - 1
            while self.stack[at][0] != tag:
                at -= 1
            self.cut(at)


def blocks(page: str) -> list[tuple[str, int, int]]:
    """(text, characters in links, article number or 0) of the blocks outside skipped parts. Markup is never text: a tag without
    an end takes the rest of the page, as in browsers, unless it is no element of HTML. Time is linear in the page."""
    found: list[tuple[str, int, int]] = []
    open_ = _Open()
    parts: list[str] = []
    links, articles = 0, 0

    def add(raw: str) -> int:
        if not raw or open_.top()[1]:
            return 0
        parts.append(raw)
        return len(html.unescape(raw).strip()) if open_.counts["a"] else 0

    def close_block() -> None:
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            found.append((text, links, open_.top()[2]))
        parts.clear()

    at = 0
    while (opens := _OPENS.search(page, at)) is not None:  # a bare "<" is text
        links += add(page[at : opens.start()])
        m = _TOKEN.match(page, opens.start())
        if m is None:  # no end up to the end of the page
            name = _NAME.match(page, opens.start())
            known = name is None or name[1].lower() in ELEMENTS or page.find(">", opens.start()) >= 0
            at = len(page) if known else opens.start()
            break
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            close_block()
            links = 0
        elif tag == "br":
            parts.append(" ")
        if tag in VOID:
            continue
        if m["end"]:
            open_.close(tag)
            continue
        if tag == "body":
            open_.cut(0)
        if tag in ENDS_P and open_.blocks:
            cut = open_.blocks[-1]
            if open_.stack[cut][0] == "p" or tag == "li" == open_.stack[cut][0]:
                open_.cut(cut)
        _, skipped, article = open_.top()
        within = bool(article)
        if tag in ("article", "main") and not article and not skipped:
            articles += 1
            article = articles
        if m["attrs"].endswith("/") and tag not in BLOCKS:
            continue
        open_.push(tag, skipped or _is_beside(tag, m["attrs"], within), article)
    links += add(page[at:])
    close_block()
    return found


def first_pass(text: str, links: int, article: int) -> str:
    """good, bad, or open: short (nothing known), near (some stop words) or plain (long, hardly any)."""
    if links >= LINKS * len(text):
        return "bad"
    if len(text) + (0 if text.isascii() else len(_WIDE(text))) < SHORT:
        return "bad" if links and not article else "short"
    found = _WORDS(text.lower())
    density = sum(map(STOP_WORDS.__contains__, found)) / max(1, len(found))
    if density >= STOP_GOOD:
        return "good"
    return "near" if density >= STOP_SOME or article else "plain"


def second_pass(labels: list[str], articles: list[int]) -> list[bool]:
    """Whether each block is kept. The edges of an article count as good, those of a page and of teasers (below 0) as bad."""
    n = len(labels)
    before: list[tuple[int, bool] | None] = [None] * n
    after: list[tuple[int, bool] | None] = [None] * n
    for order, out in ((range(n), before), (range(n - 1, -1, -1), after)):
        last: dict[int, tuple[int, bool]] = {}
        for i in order:
            out[i] = last.get(articles[i])
            if labels[i] in ("good", "bad"):
                last[articles[i]] = (i, labels[i] == "good")
    decided = any(x in ("good", "bad") for x in labels)
    kept = []
    for i, label in enumerate(labels):
        if label in ("good", "bad"):
            kept.append(label == "good")
            continue
        edge = articles[i] > 0 or not decided
        left = before[i] or (-1, edge)
        right = after[i] or (n, edge)
        if left[1] == right[1]:
            kept.append(left[1])
        elif label == "near" or articles[i] > 0:
            kept.append(True)
        else:
            kept.append(left[1] if i - left[0] < right[0] - i else right[1])
    return kept


def extract(page: str | None) -> str:
    found = blocks(page or "")
    articles = [x[2] for x in found]
    labels = [first_pass(*x) for x in found]
    sizes = [len(x[0]) for x in found]
    outside = sum(n for n, a, label in zip(sizes, articles, labels, strict=True) if not a and label == "good")
    if any(articles) and outside > sum(n for n, a, label in zip(sizes, articles, labels, strict=True) if a and label != "bad"):
        articles = [-a for a in articles]  # teasers beside the text
        labels = [first_pass(text, links, 0) for text, links, _ in found]
    good = sum(n for n, label in zip(sizes, labels, strict=True) if label == "good")
    if good < sum(n for n, label in zip(sizes, labels, strict=True) if label in ("near", "plain")):
        labels = ["good" if label in ("near", "plain") else label for label in labels]
    kept = second_pass(labels, articles)
    return " ".join(x[0] for x, keep in zip(found, kept, strict=True) if keep)


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, 500):
            batch = whole.slice(lo, 500)
            texts = [extract(page) for page in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points of text) of every row of ``pages`` (page_id, url, html)."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        _extract_batches, "page_id long, url string, text string, n_chars long")
