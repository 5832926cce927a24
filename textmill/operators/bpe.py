"""Token windows over byte-pair tokens (P4, P5): ids and byte offsets in Arrow batches.

A page is encoded once; the byte length of every token is looked up by id, so the
running sum gives each token's place in the page's UTF-8 bytes, and a window is a
range of tokens, hence a range of bytes.

Window ends inside a character: tokens are byte strings, so a window may start or end
within a multi-byte character.  Its text is its bytes decoded with U+FFFD for what is
no whole character (Unicode's rule of maximal subparts); ``byte_start``
and ``byte_end`` keep the exact range, and the ranges of all windows cover the page.
Strings of special tokens in a text are ordinary text.

The vocabulary (lines of base64 token and rank) is read on the driver and sent to
the tasks, at most ``MAX_VOCABULARY`` bytes of it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the published pre-split pattern of the byte-level vocabularies of 50,000 tokens.
BYTE_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_VOCABULARY = 64 << 20
FLUSH_BYTES = 8 << 20  # text of the windows that go out in one Arrow batch

_ENCODINGS: dict = {}  # of this worker: one or a few vocabularies


class Vocabulary:
    """Ranks of a byte-level BPE vocabulary and its pre-split pattern."""

    def __init__(self, lines: bytes, pattern: str = BYTE_BPE_PATTERN):
        if len(lines) > MAX_VOCABULARY:
            raise ValueError(f"vocabulary of {len(lines)} bytes; at most {MAX_VOCABULARY}")
        self.lines, self.pattern = lines, pattern
        self.key = (hash(lines), pattern)

    @classmethod
    def read(cls, path: str, pattern: str = BYTE_BPE_PATTERN) -> "Vocabulary":
        with open(path, "rb") as f:
            return cls(f.read(MAX_VOCABULARY + 1), pattern)

    def encoding(self):
        """(encoder, byte length of each id), made once a worker."""
        known = _ENCODINGS.get(self.key)
        if known is None:
            import tiktoken
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, self.lines.splitlines())}
            sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
            for token, rank in ranks.items():
                sizes[rank] = len(token)
            enc = tiktoken.Encoding("bytes", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
            known = _ENCODINGS[self.key] = (enc, sizes)
        return known


def window_ranges(n: int, size: int, overlap: int, drop_contained_tail: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Token ranges of the windows of ``n`` tokens: one starts every ``size - overlap``."""
    starts = np.arange(0, n, size - overlap)
    if drop_contained_tail:
        starts = starts[(starts == 0) | (starts + overlap < n)]
    return starts, np.minimum(starts + size, n)


def bpe_windows(pages: DataFrame, vocabulary: Vocabulary, size: int, overlap: int, text: str = "text",
                drop_contained_tail: bool = False, with_ids: bool = False) -> DataFrame:
    """One row per token window of ``pages``: its other columns, ``chunk_index``, ``content``,
    ``token_count, byte_start, byte_end`` and, if asked, ``token_ids``.  Null and
    empty texts give no window.  Narrow: no shuffle, a page stays in its task."""
    if not 0 <= overlap < size:
        raise ValueError("size must exceed overlap")
    new = ["chunk_index", "content", "token_count", "byte_start", "byte_end"] + ["token_ids"] * with_ids
    others = [c for c in pages.columns if c != text]
    clash = [c for c in others if c.lower() in new]
    if clash:
        raise ValueError(f"columns {clash} have names of the result")
    src = pages.select(*[F.col(f"`{c}`") for c in others], F.col(text).alias("_text"))
    names = [*others, *new]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    schema = (schema + ", " if schema else "") + "chunk_index int, content string, token_count int, byte_start long, byte_end long"
    shipped = pages.sparkSession.sparkContext.broadcast((vocabulary.lines, vocabulary.pattern))  # bounded by MAX_VOCABULARY

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sizes = Vocabulary(*shipped.value).encoding()

        def flush(batch, rows, cols):
            take = pa.array(rows, pa.int64())
            arrays = [batch.column(i).take(take) for i in range(len(others))]
            arrays += [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()),
                       pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())]
            if with_ids:
                arrays.append(pa.array(cols[5], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            texts = batch.column(len(others))
            rows, cols, held = [], [[] for _ in new], 0
            for row in range(batch.num_rows):
                page = texts[row].as_py()
                if not page:
                    continue
                data = page.encode("utf-8")
                ids = np.asarray(enc.encode_ordinary(page), dtype=np.int64)
                ends = np.concatenate([[0], np.cumsum(sizes[ids])])
                a, b = window_ranges(len(ids), size, overlap, drop_contained_tail)
                lo, hi = ends[a].tolist(), ends[b].tolist()
                for i, (s, e) in enumerate(zip(lo, hi)):
                    rows.append(row)
                    cols[0].append(i)
                    cols[1].append(data[s:e].decode("utf-8", "replace"))
                    cols[2].append(int(b[i] - a[i]))
                    cols[3].append(s)
                    cols[4].append(e)
                    if with_ids:
                        cols[5].append(ids[a[i]:b[i]])
                    held += e - s
                    if held >= FLUSH_BYTES:
                        yield flush(batch, rows, cols)
                        rows, cols, held = [], [[] for _ in new], 0
            if rows:
                yield flush(batch, rows, cols)

    return src.mapInArrow(run, schema + (", token_ids array<int>" if with_ids else ""))


def given_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> Vocabulary:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers
    return Vocabulary.read(public_tokenizers.path(name))
