"""Front-matter skip, previews and element filters over chunk tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.frontmatter import starts_content
from textmill.functions.text import collapse_all, first_nonempty, py_strip

PREVIEW_ROWS = 6
PREVIEW_WIDTH = 800


def chunk_text(df: DataFrame) -> "F.Column":
    """``content or text or ''`` (empty strings fall through)."""
    cols = [c for c in ("content", "text") if c in df.columns]
    return first_nonempty(*cols, F.lit(""))


def content_start(chunks: DataFrame, doc: str = "document_id", pos: str = "pos",
                  text=None) -> DataFrame:
    """Per document, the position of the first chunk that opens real content;
    the first position when none does (keep everything).

    A grouped aggregate (map-side partial min), not a window, so a document
    holding a third of the chunks is still reduced in every task first.
    """
    t = chunk_text(chunks) if text is None else text
    return (chunks.groupBy(doc)
            .agg(F.coalesce(F.min(F.when(starts_content(t), F.col(pos))), F.min(pos)).alias("start")))


def skip_front_matter(chunks: DataFrame, doc: str = "document_id", pos: str = "pos",
                      text=None, keep_start: bool = True) -> DataFrame:
    """Drop the chunks of each document that come before its content start;
    front matter after that point stays."""
    starts = content_start(chunks, doc, pos, text)
    out = chunks.join(starts, doc).filter(F.col(pos) >= F.col("start"))
    return out if keep_start else out.drop("start")


def exclude_elements(chunks: DataFrame, spec="Header,Footer", col: str = "element_type") -> DataFrame:
    """Drop chunks whose element type is listed (comma list or sequence);
    chunks without a type are kept."""
    names = [s.strip() for s in spec.split(",")] if isinstance(spec, str) else list(spec)
    names = [s for s in names if s]
    if not names:
        return chunks
    return chunks.filter(F.col(col).isNull() | ~F.col(col).isin(names))


def resolved_fields(chunks: DataFrame) -> DataFrame:
    """Coalesce alternative key names the way ``a or b or c`` does."""
    have = set(chunks.columns)

    def pick(*names, zero=False):
        cols = [n for n in names if n in have]
        return first_nonempty(*cols, zero_is_missing=zero) if cols else F.lit(None)

    return chunks.select(
        "*",
        py_strip(chunk_text(chunks)).alias("_text"),
        pick("page_number", "page", "page_index", zero=True).alias("_page"),
        pick("section_title", "title", "section").alias("_title"),
        pick("element_type", "type").alias("_type"))


def preview(chunks: DataFrame, n: int = PREVIEW_ROWS, width: int = PREVIEW_WIDTH,
            doc: str = "document_id", pos: str = "pos", skip: bool = False) -> DataFrame:
    """First ``n`` chunks of every document (after the optional front-matter
    skip) with a one-line preview of at most ``width`` characters.

    ``row_number() <= n`` is planned as a WindowGroupLimit: each task keeps
    only its first n rows per document before the shuffle.
    """
    src = skip_front_matter(chunks, doc, pos, keep_start=False) if skip else chunks
    r = resolved_fields(src)
    w = Window.partitionBy(doc).orderBy(pos)
    top = r.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    text = F.substring(collapse_all("_text"), 1, width)
    return top.select(doc, pos, F.col("_page").alias("page"), F.col("_title").alias("title"),
                      F.col("_type").alias("type"),
                      F.when(text == "", F.lit("(empty)")).otherwise(text).alias("preview"))
