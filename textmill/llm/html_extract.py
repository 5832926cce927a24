"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags.  Every word scores positive and every
tag scores by its learned weight (negative for tags that surround menus and
footers); the contiguous stretch with the highest sum, found in one linear scan,
is the content region.  Words inside elements that never hold article text
(scripts, navigation, adverts, reader comments, ...) score nothing and are left
out of the text where they lie within the region; such an element costs
``CLUTTER_SCORE`` once.

Weights are smoothed log odds of a tag lying between content words rather than
outside, counted on labelled pages (pages whose article text is known); counting
is a Spark aggregation with one row for each kind of tag, and the fit takes at
most ``FIT_PAGES`` labelled pages.  Extraction is per row: no shuffle of pages.

Defined cases: null or empty html, and pages without words, give empty text;
repeated rows give a row each; unclosed and stray tags end with their nearest
open ancestor; a table without labelled pages uses ``PRIOR`` alone.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIT_PAGES = 2000  # labelled pages of the fit, at most
WORD_SCORE = 1.0
CLUTTER_SCORE = -1.0
# Weight that a tag has before any labelled page is seen (fixed values).
PRIOR = {"a": -1.0, "li": -0.5, "ul": -0.5, "ol": -0.5, "img": -0.5, "td": -0.5, "article": -4.0, "main": -4.0,
         "p": 0.5, "b": 0.5, "i": 0.5, "em": 0.5, "strong": 0.5, "br": 0.5, "h1": 0.0, "h2": 0.0, "h3": 0.0}
PRIOR_OTHER = -0.5
PRIOR_COUNT = 20.0
# Elements whose raw content is not markup (fixed values).
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp", "template"))
# Elements that hold no article text (fixed values).
CLUTTER = frozenset(("nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "object", "svg",
                     "head", "canvas", "audio", "video", "map", "fieldset", "label", "input", "option", "datalist"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
BLOCK = frozenset(("address", "article", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt",
                   "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html", "li", "main", "ol", "p",
                   "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul")) | CLUTTER
# Words of class, id and role values that mark clutter (fixed values).
CLUTTER_WORDS = frozenset((
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
    "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer", "header",
    "masthead", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "comment", "comments",
    "commentlist", "reply", "replies", "respond", "disqus", "widget", "toolbar", "pager", "pagination", "search", "tags",
    "copyright", "disclaimer", "complementary", "contentinfo", "alert", "skip", "discussion",
    "responses", "feedback", "teaser", "teasers", "trending", "popular"))
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_MARK = re.compile(r"[>\"']")
_VALUE = re.compile(r"([^\s\"'=<>/]*)\s*=\s*\Z")  # what stands before a quote that opens a value
_OWN = re.compile(r"(?:class|id|role|style|hidden)\Z", re.I)  # attributes that _clutter reads
_ATTR = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\shidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class _Tags:
    """Ends of the tags of one page, in time linear in its length.

    A quote behind ``=`` opens a value that goes on to the next such quote, however
    long.  A tag whose values don't close ends at its first ``>``.
    """

    def __init__(self, page: str):
        self.page = page
        self.stray: set[int] = set()  # quotes from which no tag end is reached

    def end(self, at: int) -> tuple[int, str]:
        """(end, attributes) of the tag whose name ends at ``at``; values that hold
        no class, id, role or style are left out of the attributes."""
        page, pos, start, parts, passed = self.page, at, at, [], []
        while m := _MARK.search(page, pos):
            pos = m.end()
            if m[0] == ">":
                parts.append(page[start:pos - 1])
                return pos, "".join(parts)
            # names are looked for in a bounded stretch before the quote
            name = _VALUE.search(page, max(start, pos - 201), pos - 1)
            if not name:
                continue
            if pos in self.stray:
                break
            passed.append(pos)
            close = page.find(m[0], pos)
            if close < 0:
                break
            if not _OWN.search(name[1]):
                parts.append(page[start:pos])
                start = close
            pos = close + 1
        self.stray.update(passed)
        close = page.find(">", at)
        return (close + 1, page[at:close]) if close >= 0 else (len(page), page[at:])


def _clutter(name: str, attrs: str) -> bool:
    if name in CLUTTER:
        return True
    if name in ("html", "body", "main", "article") or not attrs:
        return False
    if _HIDDEN.search(attrs):
        return True
    for m in _ATTR.finditer(attrs):
        value = m[1] or m[2] or m[3] or ""
        # camelCase and punctuation divide the names of a class list
        if CLUTTER_WORDS.intersection(_NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower())):
            return True
    return False


def tokens(page: str) -> list[tuple[str, str, bool]]:
    """(kind, value, clutter): kind ``<``/``/`` with a tag name, or ``t`` with text.

    Scripts, styles, comments and markup declarations have no tokens.
    """
    out: list[tuple[str, str, bool]] = []
    stack: list[tuple[str, bool]] = []  # open elements; True: clutter by itself or an ancestor
    opened: Counter = Counter()
    at, end, tags = 0, len(page), _Tags(page)
    while at < end:
        m = _TAG.search(page, at)
        text = page[at:m.start() if m else end]
        if text:
            out.append(("t", text, bool(stack) and stack[-1][1]))
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        at, attrs = tags.end(at)
        if m[1]:
            out.append(("/", name, bool(stack) and stack[-1][1]))
            if opened[name]:  # else a stray end tag
                while stack[-1][0] != name:
                    opened[stack.pop()[0]] -= 1
                opened[stack.pop()[0]] -= 1
            continue
        if name in RAW:
            # the content is no markup: go on behind the end tag
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            if not attrs.rstrip().endswith("/"):
                at = close.end() if close else end
            continue
        if name == "p" and stack and stack[-1][0] == "p":
            opened[stack.pop()[0]] -= 1
        inside = bool(stack) and stack[-1][1]
        clutter = inside or _clutter(name, attrs)
        out.append(("<", name, clutter))
        if name not in VOID and not attrs.rstrip().endswith("/"):
            stack.append((name, clutter))
            opened[name] += 1
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """Bounds of the first contiguous stretch with the highest sum (linear scan)."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, at = total, (start, i + 1)
    return at


def extract(page: str | None, weights: dict[str, float]) -> str:
    """Main text of one page; blocks are joined by one space."""
    if not page:
        return ""
    toks = tokens(page)
    scores, before = [], False
    for kind, value, clutter in toks:
        if clutter:
            scores.append(0.0 if before else CLUTTER_SCORE)
        elif kind == "t":
            scores.append(len(value.split()) * WORD_SCORE)
        else:
            scores.append(weights.get(kind + value, PRIOR_OTHER))
        before = clutter
    lo, hi = best_region(scores)
    blocks, now = [], []
    for kind, value, clutter in toks[lo:hi]:
        if kind == "t":
            if not clutter:
                now.append(entities.unescape(value))
        elif value in BLOCK:
            blocks.append("".join(now))
            now = []
    blocks.append("".join(now))
    return " ".join(b for b in (_SPACE.sub(" ", x).strip() for x in blocks) if b)


def tag_counts(page: str | None, article: str | None) -> Counter:
    """(tag, inside) counts of one labelled page: a tag is inside when the words
    on both sides of it belong to the article."""
    out: Counter = Counter()
    if not page or not article:
        return out
    known, state, waiting = set(article.split()), False, []
    for kind, value, clutter in tokens(page):
        if clutter:
            continue
        if kind != "t":
            waiting.append(kind + value)
            continue
        ws = entities.unescape(value).split()
        if not ws:
            continue
        now = 2 * sum(w in known for w in ws) > len(ws)
        out.update((w, state and now) for w in waiting)
        state, waiting = now, []
    out.update((w, False) for w in waiting)
    return out


def fit_weights(labelled: DataFrame) -> dict[str, float]:
    """Tag weights from labelled pages (columns html, article).

    Bounded: at most ``FIT_PAGES`` pages, chosen by a hash of their html, and one
    result row for each kind of tag.
    """
    sample = (labelled.where(F.col("html").isNotNull() & F.col("article").isNotNull())
              .orderBy(F.xxhash64("html"), "html").limit(FIT_PAGES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for page, article in zip(b.column("html").to_pylist(), b.column("article").to_pylist(), strict=True):
                total.update(tag_counts(page, article))
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in keys], pa.string()), pa.array([v for _, v in keys], pa.bool_()),
             pa.array([total[k] for k in keys], pa.int64())], names=["tag", "inside", "n"])

    counts = sample.select("html", "article").mapInArrow(run, "tag string, inside boolean, n long")
    top = (counts.groupBy("tag").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("n_in"),
                                     F.sum("n").alias("n")).orderBy(F.desc("n"), "tag").limit(500))
    return weights_from({r["tag"]: (r["n_in"], r["n"] - r["n_in"]) for r in top.collect()})


def weights_from(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Log odds by tag, shrunk towards ``PRIOR`` by ``PRIOR_COUNT`` pseudo counts."""
    out = {k + t: w for t, w in PRIOR.items() for k in "</"}
    for tag, (inside, outside) in counts.items():
        p = 1 / (1 + math.exp(-PRIOR.get(tag[1:], PRIOR_OTHER)))
        out[tag] = math.log((inside + PRIOR_COUNT * p) / (outside + PRIOR_COUNT * (1 - p)))
    return out


def extract_pages(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of pages."""
    src = pages.select("page_id", "url", "html")
    id_type = src.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [extract(p, weights) for p in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(text, pa.string()),
                 pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return src.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
