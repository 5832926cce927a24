"""Document discovery and page scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.text import basename, py_strip
from textmill.session import spread

MIN_PAGE_CHARS = 50


def _suffix_glob(suffix: str) -> str:
    """'.pdf' -> '*.[pP][dD][fF]' (case-insensitive glob)."""
    out = []
    for ch in suffix:
        out.append(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch)
    return "*" + "".join(out)


def discover_documents(spark: SparkSession, path: str, suffix: str = ".pdf") -> DataFrame:
    """List files with ``suffix`` (any case) in a folder, non-recursively, or
    the single file ``path``; raise when nothing matches.

    Returns ``path, document_id, length, content`` lazily; ``content`` (the
    bytes) is only read if a later step selects it.
    """
    from pyspark.errors import AnalysisException
    try:
        df = (spark.read.format("binaryFile")
              .option("pathGlobFilter", _suffix_glob(suffix))
              .option("recursiveFileLookup", "false")
              .load(path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"No {suffix} file or folder found at: {path}") from e
        raise
    # in path order, as the files are processed
    df = df.select("path", basename("path").alias("document_id"), "length", "content").orderBy("path")
    if df.select("path").isEmpty():
        raise FileNotFoundError(f"No {suffix} file or folder found at: {path}")
    return df


def _quote(delim: str) -> str:
    return r"\Q" + delim + r"\E"


def page_rows(docs: DataFrame, id_col: str = "document_id", text_col: str = "text",
              delimiter: str = "\f") -> DataFrame:
    """Every page of every document, unfiltered: ``document_id, page_number,
    raw`` with pages numbered from 1.  Narrow (a small input is first dealt over
    the cores, see :func:`textmill.session.spread`)."""
    return spread(docs.select(*dict.fromkeys((id_col, text_col)))).select(
        F.col(id_col).alias("document_id"),
        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), _quote(delimiter), -1))
         .alias("pos", "raw"),
    ).select("document_id", (F.col("pos") + 1).alias("page_number"), "raw")


def scan_pages(docs: DataFrame, id_col: str = "document_id", text_col: str = "text",
               delimiter: str = "\f", min_chars: int = MIN_PAGE_CHARS) -> DataFrame:
    """Usable pages: stripped text longer than ``min_chars``; page numbers keep
    their gaps.  Output ``document_id, page_number, text``."""
    p = page_rows(docs, id_col, text_col, delimiter).select(
        "document_id", "page_number", py_strip("raw").alias("text"))
    return p.filter(F.length("text") > min_chars)


def dropped_pages(docs: DataFrame, id_col: str = "document_id", text_col: str = "text",
                  delimiter: str = "\f", min_chars: int = MIN_PAGE_CHARS,
                  every: int | None = 50) -> DataFrame:
    """Pages the scan drops.  With ``every`` set, only those whose 0-based
    index is a multiple of it (the sparse-page warning); ``None`` gives all."""
    p = page_rows(docs, id_col, text_col, delimiter)
    cond = F.length(py_strip("raw")) <= min_chars
    if every:
        cond = cond & (F.pmod(F.col("page_number") - 1, F.lit(every)) == 0)
    return p.filter(cond).select("document_id", "page_number")


def documents_without_pages(docs: DataFrame, pages: DataFrame,
                            id_col: str = "document_id") -> DataFrame:
    """Documents that yield no usable page (skipped by the pipeline)."""
    return (docs.select(F.col(id_col).alias("document_id"))
            .join(pages.select("document_id"), "document_id", "left_anti"))
