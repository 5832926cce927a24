"""SQL fragments (DuckDB dialect) mirroring the column functions, used only to
write the independent oracle queries.  RE2 has no (?U) flag (it means
'ungreedy' there), so patterns carry explicit character classes instead."""

from __future__ import annotations

from textmill.functions import tagging
from textmill.functions.text import ANY_RUN_RE, RUNS_RE, STRIP_RE, TITLE_RE, WORD_TOKEN_RE


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(STRIP_RE)}, '', 'g')"


def collapse(x: str) -> str:
    return strip(f"regexp_replace({x}, {q(RUNS_RE)}, ' ', 'g')")


def collapse_all(x: str) -> str:
    return f"regexp_replace({x}, {q(ANY_RUN_RE)}, ' ', 'g')"


def word_tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {q(WORD_TOKEN_RE)})"


def title(x: str) -> str:
    t = f"regexp_extract({x}, {q(TITLE_RE)}, 1)"
    return f"CASE WHEN {t} = '' THEN 'Unknown Section' ELSE {strip(t)} END"


def _dbl(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def hits(x: str, pat: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, {q('(?i)' + pat)})) AS DOUBLE)"


def score_exprs(body: str, title_col: str | None = None) -> list[str]:
    out = []
    for name, pats in tagging.CATEGORY_RULES:
        acc = "CAST(0.0 AS DOUBLE)"
        for pat, w in pats:
            if title_col is not None:
                acc = (f"({acc} + CASE WHEN coalesce({title_col}, '') <> '' THEN "
                       f"{_dbl(tagging.TITLE_WEIGHT * w)} * {hits(title_col, pat)} "
                       f"ELSE CAST(0.0 AS DOUBLE) END)")
            acc = f"({acc} + {_dbl(tagging.BODY_WEIGHT * w)} * {hits(body, pat)})"
        out.append(f"{acc} AS {tagging.score_column_name(name)}")
    return out


def label_expr() -> str:
    cols = [tagging.score_column_name(n) for n in tagging.CATEGORIES]
    best = f"greatest({', '.join(cols)})"
    arms = " ".join(f"WHEN {c} = {best} THEN {q(n)}" for c, n in zip(cols, tagging.CATEGORIES))
    return f"CASE WHEN {best} < {_dbl(tagging.MIN_SCORE)} THEN 'General' {arms} END"


def pages_cte(src: str, id_col: str, text_col: str, delim_sql: str, min_chars: int = 50) -> str:
    """Usable pages: split, number from 1, strip, keep > min_chars."""
    return f"""
    raw_pages AS (
      SELECT {id_col} AS document_id, unnest(parts) AS raw,
             generate_subscripts(parts, 1) AS page_number
      FROM (SELECT {id_col}, string_split(coalesce({text_col}, ''), {delim_sql}) AS parts FROM {src})
    ),
    pages AS (
      SELECT document_id, page_number, {strip('raw')} AS text FROM raw_pages
      WHERE length({strip('raw')}) > {min_chars}
    )"""


def chunks_cte(size: int = 600, overlap: int = 50, tagged: bool = True) -> str:
    """Windows over the ``pages`` CTE (word tokens)."""
    step = size - overlap
    tag = ""
    if tagged:
        tag = f""",
    titled AS (SELECT *, {title('content')} AS section_title FROM chunks),
    scored AS (SELECT *, {', '.join(score_exprs('content', 'section_title'))} FROM titled),
    tagged AS (SELECT *, {label_expr()} AS system_category FROM scored)"""
    return f"""
    toks AS (SELECT document_id, page_number, {word_tokens(collapse('text'))} AS t FROM pages),
    wins AS (
      SELECT document_id, page_number, t, unnest(generate_series(0, len(t) - 1, {step})) AS s
      FROM toks WHERE len(t) > 0
    ),
    chunks AS (
      SELECT document_id, page_number, CAST(s // {step} AS BIGINT) AS chunk_index,
             replace(array_to_string(list_slice(t, s + 1, s + {size}), ''), chr(0), '') AS content,
             CAST(len(list_slice(t, s + 1, s + {size})) AS BIGINT) AS token_count
      FROM wins
    ){tag}"""


def front_matter(x: str) -> str:
    from textmill.functions.frontmatter import FRONT_MATTER_RE, SHORT_FRONT_RE, SHORT_LEN
    t = strip(f"coalesce({x}, '')")
    return (f"({t} = '' OR regexp_matches({t}, {q('(?i)' + FRONT_MATTER_RE)}) OR "
            f"(length({t}) < {SHORT_LEN} AND regexp_matches({t}, {q('(?i)' + SHORT_FRONT_RE)})))")


def starts_content(x: str) -> str:
    from textmill.functions.frontmatter import CONTENT_MIN_LEN, CONTENT_START_PHRASES
    low = f"lower(coalesce({x}, ''))"
    ph = " OR ".join(f"contains({low}, {q(p)})" for p in CONTENT_START_PHRASES)
    return f"(NOT {front_matter(x)} AND ({ph} OR length({low}) > {CONTENT_MIN_LEN}))"


def first_nonempty(*cols: str, zero: bool = False) -> str:
    out = cols[-1]
    for c in reversed(cols[:-1]):
        falsy = f"{c} IS NULL OR {c} = 0" if zero else f"{c} IS NULL OR CAST({c} AS VARCHAR) = ''"
        out = f"CASE WHEN {falsy} THEN {out} ELSE {c} END"
    return out
