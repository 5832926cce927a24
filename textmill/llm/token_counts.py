"""Token counts of documents and stored prefix tables.

``count_tokens`` answers, per document, the exact token count, whether it passes
a budget and how many characters fit the budget.  ``prefix_tables`` stores the
exact count after every character, in segments, and ``tokens_of_prefix`` and
``fitting_prefix`` answer later questions from the stored tables by joins and
array look-ups, without encoding again.

All work is per row (no shuffle); a segment bounds the row size of very long
texts.  Defined cases: null and empty texts count 0; repeated rows and ids give
a row each; extra columns of the input are ignored; an empty table gives an
empty result; the strings of special tokens count as those tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix_tokens import counter

SEGMENT = 4096
ROWS = 512  # texts a worker holds as Python strings at a time


def count_tokens(docs: DataFrame, vocabulary: str, *, budget: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, fit_chars`` (``fit_chars``: the
    longest prefix, in characters, of at most ``budget`` tokens)."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary)
        for b in batches:
            texts, got = b.column("text"), []
            for at in range(0, len(texts), ROWS):
                got += c.count_and_fit(texts.slice(at, ROWS).to_pylist(), budget)
            n = pa.array([x for x, _ in got], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), n, pa.array([x > budget for x, _ in got], pa.bool_()),
                 pa.array([x for _, x in got], pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    return src.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def prefix_tables(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text",
                  segment: int = SEGMENT) -> DataFrame:
    """``doc_id, segment, counts``: entry i of segment s is the token count of the
    first ``s * segment + i + 1`` characters.  Empty texts have no rows."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary)
        for b in batches:
            ids = b.column("doc_id")
            for row, text in enumerate(b.column("text").to_pylist()):
                counts = c.table(text)
                starts = range(0, len(counts), segment)
                if starts:
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array([row] * len(starts))), pa.array([s // segment for s in starts], pa.int32()),
                         pa.array([counts[s:s + segment] for s in starts], pa.list_(pa.int32()))],
                        names=["doc_id", "segment", "counts"])

    return src.mapInArrow(run, f"doc_id {id_type}, segment int, counts array<int>")


def tokens_of_prefix(tables: DataFrame, questions: DataFrame, *, segment: int = SEGMENT) -> DataFrame:
    """``questions``: doc_id, n_chars (from 1).  Adds ``n_tokens`` from the stored tables."""
    q = questions.select("doc_id", "n_chars").withColumn("segment", F.floor((F.col("n_chars") - 1) / segment).cast("int"))
    at = (F.pmod(F.col("n_chars") - 1, F.lit(segment)) + 1).cast("int")
    return q.join(tables, ["doc_id", "segment"]).select("doc_id", "n_chars", F.get("counts", at - 1).alias("n_tokens"))


def fitting_prefix(tables: DataFrame, budget: int, *, segment: int = SEGMENT) -> DataFrame:
    """``doc_id, fit_chars``: the longest stored prefix of at most ``budget`` tokens."""
    last = F.array_max(F.transform("counts", lambda c, i: F.when(c <= budget, i + 1).otherwise(0)))
    end = F.when(last > 0, F.col("segment") * segment + last).otherwise(0)
    return tables.groupBy("doc_id").agg(F.max(end).cast("long").alias("fit_chars"))
