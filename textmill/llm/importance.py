"""Target-distribution importance resampling (hashed n-gram weights, Gumbel top-k).

A document's weight is the floored mean of its n-grams' gains; a gain is the log
ratio of the smoothed shares that the n-gram's bucket has in the target texts and in
the raw documents.  Each batch of texts is interned in an open-addressed NumPy table
(:mod:`textmill.llm.ngram_table`): counts are summed by bucket over all batches and
tasks, then the gains are looked up once a slot and gathered by the slot ids of the
occurrences.  Scores add Gumbel noise that is a hash of the id, so the documents of
the highest scores are a draw without replacement in proportion to exp(weight), and
reruns agree.

Only bucket sums (``buckets`` numbers, a parameter) pass the driver.  Null texts
have no words; a null id is hashed as the empty text and comes last among ties;
repeated rows are documents of their own; columns other than the two used are
never looked at, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators.sinks import number_rows

from .common import stage

BUCKETS = 10_000


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, max_n: int = 1) -> DataFrame:
    """``bucket, n``: occurrences of n-grams by bucket over all texts, zeros left out."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .ngram_table import interned
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, table, _, _ in interned(batch.column(0), buckets, max_n):
                np.add.at(total, table.bucket, table.count)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit], pa.int64())], schema=schema)

    return (texts.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def fit_gains(raw: DataFrame, target: DataFrame, raw_text: str = "text", target_text: str = "text",
              buckets: int = BUCKETS, max_n: int = 1) -> list[int]:
    """Gain of every bucket: floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))."""
    def counts(df, col):
        out = [0] * buckets
        for r in bucket_counts(df, col, buckets, max_n).collect():  # at most one row a bucket
            out[r["bucket"]] = r["n"]
        return out, sum(out)

    (s, all_s), (t, all_t) = counts(raw, raw_text), counts(target, target_text)
    return [math.floor(1000 * math.log((b + 1) * (all_s + buckets) / ((a + 1) * (all_t + buckets)))) for a, b in zip(s, t)]


def weigh(docs: DataFrame, gains: list[int], id_col: str = "doc_id", text: str = "text", max_n: int = 1) -> DataFrame:
    """Per row: id, ``n_words, n_features, weight`` (all long; weight 0 without features)."""
    g = np.asarray(gains, dtype=np.int64)
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text).cast("string").alias("_text"))
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .ngram_table import interned
        for batch in batches:
            words, features, total = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            for first, n, table, text_of, n_words in interned(batch.column(1), len(g), max_n):
                words[first:first + n] += n_words
                features[first:first + n] += np.bincount(text_of, minlength=n)
                np.add.at(total, first + text_of, g[table.bucket][table.slot])
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, features, weight))],
                                             names=[id_col, "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_features long, weight long")


def gumbel(id_col: str, seed: str) -> F.Column:
    """floor(-1000 ln(-ln u)), u from the first 32 bits of sha256(seed:id)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def score_documents(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, seed: str = "2024",
                    id_col: str = "doc_id", text: str = "text", target_text: str = "text",
                    buckets: int = BUCKETS, max_n: int = 1) -> DataFrame:
    """One row per document: id, ``n_features, weight, score, rank`` (1, 2, ... among the
    drawn, else null).  Of the N documents of at least ``min_words`` words the
    floor(percent N / 100) highest scores are drawn, ties to the smaller id.

    Ranks come from one range-partitioned sort of the eligible (id, score) rows."""
    gains = fit_gains(docs, target, text, target_text, buckets, max_n)
    rows = weigh(docs, gains, id_col, text, max_n)
    rows = stage(rows.withColumn("score", (F.col("weight") + gumbel(id_col, seed)).cast("long"))
                 .withColumn("_uid", F.monotonically_increasing_id()), "importance")
    fit = F.col("n_words") >= min_words
    drawn = percent * rows.filter(fit).count() // 100
    order = rows.filter(fit).select("*", (-F.col("score")).alias("_down"), F.col(id_col).isNull().alias("_none"))
    ranked = number_rows(order, ["_down", "_none", id_col, "_uid"], out="_row")
    cols = [id_col, "n_features", "weight", "score"]
    rank = F.when(F.col("_row") < drawn, F.col("_row") + 1)
    return ranked.select(*cols, rank.cast("long").alias("rank")).unionByName(
        rows.filter(~fit).select(*cols, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The drawn documents with all their columns (rows that share a drawn id all stay)."""
    drawn = score_documents(docs, target, id_col=id_col, **kw).filter("rank is not null").select(id_col).distinct()
    return docs.join(drawn, id_col, "left_semi")
