"""Front-matter heuristics as column expressions (P15, F6 condition)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.text import py_strip

# Phrases that mark front matter anywhere in a chunk, the
# looser words that count only in short chunks, and the phrases that mark
# the start of real content.
FRONT_MATTER_RE = (r"(table of contents|list of effective pages|record of revisions|revision record|"
                   r"log of revisions|copyright|proprietary notice|distribution statement|toc\b|lep\b)")
SHORT_FRONT_RE = r"(copyright|revision|toc|lep)"
SHORT_LEN = 200
CONTENT_START_PHRASES = ("introduction", "general description", "system description", "normal procedures")
CONTENT_MIN_LEN = 400


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_front_matter(text) -> Column:
    """True for empty text (after strip), any front-matter phrase, or a short
    text (< 200 characters) containing one of the looser words (not anchored
    at the left, so 'telephone' counts)."""
    t = py_strip(F.coalesce(_c(text), F.lit("")))
    return ((t == "")
            | t.rlike("(?iU)" + FRONT_MATTER_RE)
            | ((F.length(t) < SHORT_LEN) & t.rlike("(?iU)" + SHORT_FRONT_RE)))


def starts_content(text) -> Column:
    """Chunk that may open the real content: not front matter and either
    holds a start phrase or is longer than 400 characters (unstripped)."""
    low = F.lower(F.coalesce(_c(text), F.lit("")))
    phrase = None
    for p in CONTENT_START_PHRASES:
        hit = F.instr(low, p) > 0
        phrase = hit if phrase is None else (phrase | hit)
    return ~is_front_matter(text) & (phrase | (F.length(low) > CONTENT_MIN_LEN))


def split_list(c) -> Column:
    """'a, b,,c' -> ['a','b','c'] (split on commas, trim, drop empties)."""
    return F.filter(F.transform(F.split(_c(c), ","), lambda x: F.trim(x)), lambda x: x != "")
