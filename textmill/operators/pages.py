"""Per-document page and chunk counters and page-range parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

PART_SIZE = 100


def page_stats(pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """``document_id, pages, chunks, tokens``: usable pages and the chunks and
    tokens made from them.  Both sides aggregate map-side before the shuffle,
    so one huge document costs one partial row per task."""
    p = pages.groupBy("document_id").agg(F.count(F.lit(1)).alias("pages"))
    c = chunks.groupBy("document_id").agg(F.count(F.lit(1)).alias("chunks"),
                                          F.sum("token_count").cast("long").alias("tokens"))
    return (p.join(c, "document_id", "left")
            .select("document_id", "pages",
                    F.coalesce("chunks", F.lit(0)).cast("long").alias("chunks"),
                    F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens")))


def page_parts(pages: DataFrame, size: int = PART_SIZE, name_col: str | None = None) -> DataFrame:
    """Split every document's pages into parts of ``size`` pages.

    ``pages`` holds ``document_id, page_number`` for *all* pages (counted
    before any text filter).  Output per part: ``document_id, part,
    start_page, end_page, part_name, pages`` where the name is
    ``<stem>_pages_<start>-<end>`` (1-based, inclusive, last part short).
    The total page count per document is a partial aggregate, so a
    document holding a third of all pages is still summed across tasks.
    """
    stem = F.col(name_col) if name_col else F.col("document_id").cast("string")
    per_part = (pages.select("document_id", stem.alias("_stem"),
                             F.floor((F.col("page_number") - 1) / size).cast("long").alias("part"))
                .groupBy("document_id", "_stem", "part").agg(F.count(F.lit(1)).alias("pages")))
    total = pages.groupBy("document_id").agg(F.max("page_number").cast("long").alias("_total"))
    start = F.col("part") * size + 1
    end = F.least(start + (size - 1), F.col("_total"))
    return (per_part.join(total, "document_id")
            .select("document_id", "part", start.alias("start_page"), end.alias("end_page"),
                    F.format_string("%s_pages_%d-%d", F.col("_stem"), start, end).alias("part_name"),
                    F.col("pages").cast("long").alias("pages")))


def observed_chunks(pages: DataFrame, chunk, name: str = "chunks") -> tuple[DataFrame, Observation, Observation]:
    """``chunk(pages)`` with counters that fill while the chunks are written: one pass
    gives the chunks and their totals.

    Returns (chunks, of pages, of chunks); after an action on the chunks the first
    holds ``pages, longest_page`` and the second ``chunks, tokens``.
    Nothing is computed a second time, and what reaches the driver is a few numbers.
    Take the action once: another one isn't counted."""
    seen, made = Observation(f"{name}-pages"), Observation(f"{name}-made")
    pages = pages.observe(seen, F.count(F.lit(1)).alias("pages"), F.max(F.length("text")).alias("longest_page"))
    out = chunk(pages)
    return out.observe(made, F.count(F.lit(1)).alias("chunks"),
                       F.coalesce(F.sum("token_count").cast("long"), F.lit(0)).alias("tokens")), seen, made
