"""A corpus pipeline of five stages, each one operator of ``textmill.llm``.

Documents come in as the table ``documents`` and leave as pieces of full token
windows.  Every stage takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read again as the next stage's documents; all but the
last return the columns of documents.  Nothing is collected but bounded models,
and every stage can be computed again from the table before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import jaccard_join, mixing, packing, substring_dedup, toxicity
from textmill.llm.common import stage
from textmill.llm.queries import vocabulary_path
from textmill.session import apply_conf, read_table

SHINGLE_WORDS, SIMILARITY = 5, 80  # near copies: five words, 80 percent
PASSAGE_WORDS = 40  # shortest repeated passage that is cut


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; all labels are learned from."""
    apply_conf(spark)
    return toxicity.reject(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return jaccard_join.keep_one(docs, k=SHINGLE_WORDS, percent=SIMILARITY)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur earlier are cut from the text."""
    return substring_dedup.deduplicate(docs, window=PASSAGE_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or are left out, as their source's target asks."""
    return mixing.mix(docs, weights=(3, 1, 2), share=1.5, max_repeat=2)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2048 tokens with their ids; copies lie apart."""
    return packing.pack(docs, vocabulary_path(), length=2048, order=("doc_id", "uid"), with_ids=True)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("passages", cut_passages),
          ("mixing", mix_sources), ("packing", pack_windows)]

# A k-nearest-neighbour score, a hash-based draw and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
