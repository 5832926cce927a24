"""Embedding step with a provider registry (P13) and vector-store rows.

Providers map a text column to ``array<float>``.  The built-in ``hashing``
provider is MLlib's ``HashingTF`` over the word tokens (JVM side, no
network).  Remote or model-based providers plug in as pandas functions run
with ``mapInPandas`` (Arrow batches): they see one batch at a time, so a
batch size bounds memory whatever the table size.  Rows a provider cannot
embed go to a rejects table instead of being lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.text import py_strip, word_tokens
from textmill.functions.vectors import l2_normalize
from textmill.session import cut_lineage, path_exists

DEFAULT_DIM = 64
PASSAGE_PREFIX = "passage: "

# name -> fn(pandas.Series[str]) -> list[list[float] | None]
_PROVIDERS: dict[str, Callable] = {}


def register_provider(name: str, fn: Callable) -> None:
    """Register a batch embedder: pandas Series of text -> list of vectors
    (``None`` for a row that failed)."""
    _PROVIDERS[name] = fn


def providers() -> list[str]:
    return ["hashing", *sorted(_PROVIDERS)]


def _hashing(df: DataFrame, text_col: str, dim: int) -> DataFrame:
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array
    tok = df.withColumn("_tm_tokens", F.transform(word_tokens(F.lower(F.col(text_col))),
                                                  lambda t: py_strip(t)))
    h = HashingTF(inputCol="_tm_tokens", outputCol="_tm_vec", numFeatures=dim)
    out = h.transform(tok)
    return (out.withColumn("embedding", vector_to_array("_tm_vec", "float32"))
            .drop("_tm_tokens", "_tm_vec"))


def _one(fn: Callable, text):
    try:
        return list(fn(text))[0]
    except Exception:
        return None


def _pandas_provider(df: DataFrame, text_col: str, fn: Callable) -> DataFrame:
    schema = T.StructType(df.schema.fields + [T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(batches):
        for pdf in batches:
            pdf = pdf.copy()
            try:
                pdf["embedding"] = list(fn(pdf[text_col]))
            except Exception:  # find the rows that fail; the others are kept
                pdf["embedding"] = [_one(fn, pdf[text_col].iloc[i:i + 1]) for i in range(len(pdf))]
            yield pdf
    return df.mapInPandas(run, schema)


def embed(df: DataFrame, text_col: str = "content", provider: str = "hashing",
          model: str = "hashing-tf-64", prefix: str = "", normalize: bool = True,
          dim: int = DEFAULT_DIM) -> tuple[DataFrame, DataFrame]:
    """Add ``embedding`` and ``embedding_model``; return ``(ok, rejects)``.

    ``prefix`` is prepended to the text sent to the provider (``'passage: '``
    for instruction-tuned encoders).  Unknown providers fail here, before any
    data is read.
    """
    if provider != "hashing" and provider not in _PROVIDERS:
        raise ValueError(f"Unknown embedding provider: {provider}")
    src = df.withColumn("_tm_in", F.concat(F.lit(prefix), F.col(text_col)) if prefix else F.col(text_col))
    if provider == "hashing":
        # The JVM hasher fails only on null text: split on the input, so no
        # filter on the computed vector is pushed below (and re-evaluates) it.
        has_text = F.col(text_col).isNotNull()
        ok = _hashing(src.filter(has_text), "_tm_in", dim).drop("_tm_in")
        rejects = src.filter(~has_text).drop("_tm_in")
    else:
        # spread the calls; written once, so both results share one call a row
        src = src.repartition(df.sparkSession.sparkContext.defaultParallelism)
        out = cut_lineage(_pandas_provider(src, "_tm_in", _PROVIDERS[provider]).drop("_tm_in"), "embedded")
        good = F.col("embedding").isNotNull()
        ok, rejects = out.filter(good), out.filter(~good).drop("embedding")
    if normalize:
        ok = ok.withColumn("embedding", l2_normalize("embedding"))
    ok = ok.withColumn("embedding_model", F.lit(model))
    return ok, rejects.withColumn("embedding_model", F.lit(model))


def embed_rows(df: DataFrame, text_col: str = "content", provider: str = "hashing",
               model: str = "hashing-tf-64", prefix: str = "", normalize: bool = True,
               dim: int = DEFAULT_DIM) -> DataFrame:
    """:func:`embed` with rejects left in place: every row once, its vector null where
    there is none.  ``df`` is read once, not once for each side."""
    if provider != "hashing":
        ok, rejects = embed(df, text_col, provider, model, prefix, normalize, dim)
        return ok.unionByName(rejects.withColumn("embedding", F.lit(None).cast("array<float>")))
    text = F.coalesce(F.col(text_col), F.lit(""))  # the JVM hasher fails on null text
    ok, _ = embed(df.withColumn("_tm_text", text), "_tm_text", provider, model, prefix, normalize, dim)
    return ok.withColumn("embedding", F.when(F.col(text_col).isNotNull(), F.col("embedding"))).drop("_tm_text")


def vector_rows(chunks: DataFrame, document_type: str) -> DataFrame:
    """Embedded chunks -> vector-store rows: constant ``document_type`` and
    ``metadata.token_count`` (0 when absent); the model column is dropped."""
    from textmill.schemas import VECTOR_ROW
    tc = F.col("token_count") if "token_count" in chunks.columns else F.lit(None)
    out = chunks.select(
        "content", "embedding", "page_number", "section_title", "aircraft_model",
        "document_id", "system_category", F.lit(document_type).alias("document_type"),
        F.struct(F.coalesce(tc.cast("int"), F.lit(0)).alias("token_count")).alias("metadata"))
    # conform to the declared table schema
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in VECTOR_ROW.fields])


def embedding_dims(df: DataFrame, col: str = "embedding") -> DataFrame:
    """Rows per vector dimension, over all rows."""
    return df.groupBy(F.size(col).alias("dimension")).agg(F.count(F.lit(1)).alias("rows"))


def embed_incremental(chunks: DataFrame, path: str, text_col: str = "content", provider: str = "hashing",
                      model: str = "hashing-tf-64", prefix: str = "", normalize: bool = True,
                      keys=("document_id", "page_number", "chunk_index", "content_hash")):
    """Embedded-chunk table at ``path`` kept up to date: only chunks whose
    key (position, content hash) and model are not stored yet are embedded
    and appended; returns ``(table, rejects)``.  A re-run with unchanged
    chunks embeds nothing; a changed text is embedded again."""
    from textmill.operators.chunking import chunk_hash
    from textmill.operators.sinks import pending
    spark = chunks.sparkSession
    if "content_hash" not in chunks.columns:
        chunks = chunk_hash(chunks)
    cur = chunks.withColumn("embedding_model", F.lit(model))
    todo = pending(cur, spark.read.parquet(path), list(keys) + ["embedding_model"]) if path_exists(spark, path) else cur
    ok, rejects = embed(todo.drop("embedding_model"), text_col, provider, model, prefix, normalize)
    ok.write.mode("append").parquet(path)
    return spark.read.parquet(path), rejects
