"""String helpers that reproduce Python ``str`` semantics with JVM regexes.

Python's ``str.strip()`` and ``re``'s ``\\s`` treat every character for which
``str.isspace()`` holds as whitespace, including the separators U+001C-U+001F
that Java's ``\\s`` misses even in Unicode mode.  The class below spells that
set out explicitly, so the same pattern text means the same thing in Java and
in RE2 (used by the SQL oracle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts.
WS = (r"[\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
NON_WS = WS.replace("[", "[^", 1)

STRIP_RE = rf"\A{WS}+|{WS}+\z"
RUNS_RE = WS + "{2,}"
ANY_RUN_RE = WS + "+"
WORD_TOKEN_RE = rf"{NON_WS}+{WS}*"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The same set as WS, spelled out as characters for btrim (which trims any
# character of the set from both ends and touches only the ends).
WS_CHARS = ("\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0\u1680"
            + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")


def py_strip(c) -> Column:
    """``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def collapse_runs(c) -> Column:
    """Runs of two or more whitespace characters become one space, then strip.

    A lone newline survives, so a later title search can still anchor on it.
    """
    return py_strip(F.regexp_replace(_c(c), RUNS_RE, " "))


def collapse_all(c) -> Column:
    """Every whitespace run (even a single newline) becomes one space."""
    return F.regexp_replace(_c(c), ANY_RUN_RE, " ")


def drop_nul(c) -> Column:
    """Delete NUL characters."""
    return F.translate(_c(c), "\u0000", "")


def word_tokens(c) -> Column:
    """Lossless word tokens: each token is a non-blank run plus the blanks after it.

    ``array_join(tokens, '')`` rebuilds the input when it starts with a
    non-blank character (always true after ``py_strip``).
    """
    return F.regexp_extract_all(_c(c), F.lit(WORD_TOKEN_RE), 0)


def word_tokens_stripped(c) -> Column:
    """:func:`word_tokens` for text that starts with a non-blank character
    (stripped text): a zero-width split at every blank -> non-blank step,
    cheaper than extracting every match; '' gives no tokens."""
    x = _c(c)
    return F.when(x == "", F.array().cast("array<string>")).otherwise(
        F.split(x, f"(?<={WS})(?={NON_WS})", -1))


# Fixed value: the published pre-tokenisation pattern of the cl100k encoding.
PRETOKEN_RE = (r"(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}"
               r"| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+")


def tokens(c, mode: str = "word") -> Column:
    """Tokenise into ``array<string>`` whose concatenation is the input.

    ``word``: non-blank run plus trailing blanks.  ``pretoken``: the cl100k
    pre-split (the pieces BPE would then merge inside).  A byte-pair encoder
    needs its vocabulary file, which a job can ship with ``--files`` and plug
    in through :func:`textmill.operators.chunking.register_tokenizer`.
    """
    if mode == "word":
        return word_tokens(c)
    if mode == "pretoken":
        return F.regexp_extract_all(_c(c), F.lit("(?U)" + PRETOKEN_RE), 0)
    raise ValueError(f"unknown tokenizer mode: {mode!r}")


# Fixed value: the section-title heuristic (optional heading word, optional
# number, then a capital and 3-60 characters that are neither newline nor
# period), at the very start of the text or right after a newline.
TITLE_RE = (r"(?:^|\n)(?:Chapter|Section|Part|Item|Task)?" + WS + r"*[\d\.\-]*"
            + WS + r"*([A-Z][^\n\.]{3,60})")


def section_title(c, default: str = "Unknown Section") -> Column:
    """Heuristic section title of a chunk, stripped; ``default`` when none."""
    t = F.regexp_extract(_c(c), "(?U)" + TITLE_RE, 1)
    return F.when(t == "", F.lit(default)).otherwise(py_strip(t))


def first_nonempty(*cols, zero_is_missing: bool = False) -> Column:
    """Python ``a or b or c``: falsy values (null, '', and 0 if asked) fall
    through; the last alternative is returned as is."""
    cs = [_c(c) for c in cols]
    if not cs:
        raise ValueError("need at least one column")
    out = cs[-1]
    for c in reversed(cs[:-1]):
        falsy = c.isNull()
        if zero_is_missing:
            falsy = falsy | (c == 0)
        else:
            falsy = falsy | (c.cast("string") == "")
        out = F.when(falsy, out).otherwise(c)
    return out


def slug(c) -> Column:
    """Table-name slug: '/', '-', '.' become '_', then lower case."""
    return F.lower(F.translate(_c(c), "/-.", "___"))


def path_slug(c) -> Column:
    """Path slug: only '/' becomes '_'."""
    return F.translate(_c(c), "/", "_")


def basename(c) -> Column:
    return F.element_at(F.split(_c(c), "/"), -1)


def stem(c) -> Column:
    """File name without its last extension (a leading dot is not one)."""
    return F.regexp_replace(basename(c), r"(?<=.)\.[^.]*$", "")


def output_name(c, suffix: str = ".chunks.json") -> Column:
    """Per-document output file name ``<stem><suffix>``."""
    return F.concat(stem(c), F.lit(suffix))
