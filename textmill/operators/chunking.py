"""Sliding token windows over pages (P4-P7, P11), all narrow.

Word windows are cut in Arrow batches: one pass notes where a page's words start, and
a window is the text between two starts.  Of other tokenisers the token array is built
once and every window is a ``slice`` of it: ``explode(sequence(0, n-1, step))`` gives
the window starts.  No shuffle: a page and its chunks stay in the task that read the document.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.tagging import with_categories
from textmill.functions.text import (WS_CHARS, collapse_runs, drop_nul, section_title, tokens,
                                     word_tokens_stripped)
from textmill.operators.bpe import bpe_windows

CHUNK_SIZE = 600
CHUNK_OVERLAP = 50

_TOKENIZERS: dict[str, Callable[[Column], Column]] = {}


def register_tokenizer(name: str, fn: Callable[[Column], Column]) -> None:
    """Plug in a tokeniser ``Column(text) -> Column(array<string>)`` whose
    pieces concatenate back to the text (e.g. a pandas UDF wrapping a BPE
    encoder whose vocabulary the job ships)."""
    _TOKENIZERS[name] = fn


def tokenize(c, mode: str = "word", stripped: bool = False) -> Column:
    if mode in _TOKENIZERS:
        return _TOKENIZERS[mode](F.col(c) if isinstance(c, str) else c)
    if mode == "word" and stripped:
        return word_tokens_stripped(c)
    return tokens(c, mode)


def n_windows(n: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Number of windows for ``n`` tokens: ceil(n / step), 0 for none."""
    step = size - overlap
    return F.when(n > 0, F.floor((n + step - 1) / step)).otherwise(F.lit(0)).cast("int")


_RUNS = re.compile(r"\s{2,}")  # Python's blanks are those of functions.text.WS
_BLANK = np.zeros(0x3002, bool)  # by code point; larger ones are no blanks
_BLANK[[ord(c) for c in WS_CHARS]] = True
WINDOW_ROWS = 256  # pages a worker holds as Python strings at a time


def word_windows(pages: DataFrame, size: int, overlap: int, drop_contained_tail: bool) -> DataFrame:
    """``pages`` with its ``text`` (blank runs collapsed, stripped) cut into windows of
    ``size`` words, each word with the blank after it: ``chunk_index, _raw, token_count``
    instead of ``text``."""
    kept = [f for f in pages.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("chunk_index", T.IntegerType()), T.StructField("_raw", T.StringType()),
                           T.StructField("token_count", T.IntegerType())])
    step = size - overlap

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, WINDOW_ROWS):
                batch = whole.slice(at, WINDOW_ROWS)
                row, index, raw, count = [], [], [], []
                for i, text in enumerate(batch.column(len(kept)).cast(pa.binary()).to_pylist()):
                    if text is None:
                        continue
                    text = _RUNS.sub(" ", text.decode("utf-8", "replace")).strip()
                    blank = _BLANK[np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), len(_BLANK) - 1)]
                    # stripped and collapsed: a word follows each blank
                    starts = np.concatenate([[0], np.flatnonzero(blank) + 1]) if text else np.zeros(0, int)
                    n = len(starts)
                    for k, s in enumerate(range(0, n, step)):
                        if drop_contained_tail and s and s + overlap >= n:
                            continue
                        row.append(i)
                        index.append(k)
                        raw.append(text[starts[s]:starts[s + size] if s + size < n else None])
                        count.append(min(size, n - s))
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(take) for c in batch.columns[:len(kept)]), pa.array(index, pa.int32()), pa.array(raw, pa.string()),
                     pa.array(count, pa.int32())], names=schema.names)

    return pages.select(*[F.col(f"`{f.name}`") for f in kept], "text").mapInArrow(run, schema)


def chunk_pages(pages: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                mode: str = "word", cleanup: bool = True, drop_contained_tail: bool = False,
                constants: dict | None = None, tag: bool = True, vocabulary=None) -> DataFrame:
    """Pages ``(document_id, page_number, text)`` -> one row per token window.

    Output: ``document_id, page_number, chunk_index, content, token_count``
    plus ``section_title, system_category`` when ``tag`` and any
    ``constants`` columns.  A window starts every ``size - overlap`` tokens;
    the last, shorter window is kept even when it lies inside the previous one
    unless ``drop_contained_tail``.  ``token_count`` is counted before NULs
    are removed from the text.  ``mode="bpe"`` takes the byte-pair tokens of
    ``vocabulary`` (see :mod:`textmill.operators.bpe`).
    """
    if size <= overlap:
        raise ValueError("size must exceed overlap")
    step = size - overlap
    extra = [c for c in pages.columns if c not in ("document_id", "page_number", "text")]
    if mode == "bpe":
        if vocabulary is None:
            raise ValueError("mode bpe needs a vocabulary")
        stripped = pages.select("document_id", "page_number", *extra, collapse_runs("text").alias("text"))
        out = bpe_windows(stripped, vocabulary, size, overlap, drop_contained_tail=drop_contained_tail)
        out = out.withColumnRenamed("content", "_raw").drop("byte_start", "byte_end")
    elif mode == "word" and mode not in _TOKENIZERS:
        out = word_windows(pages.select("document_id", "page_number", *extra, "text"), size, overlap, drop_contained_tail)
    else:
        tok = pages.select("document_id", "page_number", *extra,
                           tokenize(collapse_runs("text"), mode, stripped=True).alias("_toks"))
        n = F.size("_toks")
        starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))) \
                  .otherwise(F.array().cast("array<int>"))
        # every window as (index, text, token count) in one array, so an exploded
        # row carries only its own chunk, never the page's whole token array
        wins = F.transform(starts, lambda s, i: F.struct(
            i.alias("i"), s.alias("s"),
            F.array_join(F.slice("_toks", s + 1, size), "").alias("t"),
            F.least(F.lit(size), n - s).alias("c")))
        if drop_contained_tail:
            wins = F.filter(wins, lambda w: (w["s"] == 0) | (w["s"] + overlap < n))
        out = tok.select("document_id", "page_number", *extra, F.explode(wins).alias("_w")).select(
            "document_id", "page_number", *extra, F.col("_w.i").alias("chunk_index"),
            F.col("_w.t").alias("_raw"), F.col("_w.c").alias("token_count"))
    content = F.when(F.col("_raw").contains("\0"), drop_nul("_raw")).otherwise(F.col("_raw")) if cleanup else F.col("_raw")
    out = out.select("document_id", "page_number", *extra, "chunk_index",
                     content.alias("content"), "token_count")
    if tag:
        out = out.withColumn("section_title", section_title("content"))
        out = with_categories(out, body="content", title="section_title")
    for k, v in (constants or {}).items():
        out = out.withColumn(k, F.lit(v))
    return out


def chunk_hash(df: DataFrame) -> DataFrame:
    """Add ``content_hash`` (sha2-256 of the content), the incremental key."""
    return df.withColumn("content_hash", F.sha2(F.col("content"), 256))
