"""Duplicate passages by relative Lempel-Ziv parsing against the corpus.

The corpus before a document (smaller ids, or the same document further left) is
its reference.  Reference text is indexed by phrases with content-defined ends:
every window of ``window`` words belongs to the smallest ``gram``-word hash in
it, and a phrase is the stretch of all consecutive windows that belong to one
such anchor.  Equal text has equal anchors, so a passage that occurs earlier is
cut into the same phrases there, and a document is parsed greedily, phrase by
phrase, into factors that point at the first place of the phrase in any
reference block.  A phrase is at least one window long, so every factor is a
duplicate span, and neighbouring factors join into the long factors of the parse.

Factor boundaries are checked apart: a phrase that is new as a whole, though its
anchor also occurs with other surroundings, may still hold single windows that
occurred earlier.  Only for those phrases windows are compared one by one.  With
that, the removed words are exactly those covered by a window whose words occur
earlier.

Scale.  A phrase is one slim row for some nine words of text.  Each batch of
documents emits only its first copy of a phrase and settles the others itself,
so copies of one passage reach the shuffle once a batch, however many there are;
the index is spread by anchor hash, and no list of occurrences is ever built.
Texts travel twice, by document, to the windows at factor boundaries and to the
removal.  Hashes have 64 bits; two different phrases of one anchor would have to
collide to remove a word wrongly.

Defined cases: null and blank texts have no words; texts shorter than a window
have no spans; repeated rows (same id and text) are one document and get the
same result; rows that share an id (or have none) but not the text are documents
of their own, told apart and ordered by the whole 64-bit hash of the text; null
ids come first; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import RangeHashes, WORD_RE, WordHashes, release, stage, trimmed, words

WINDOW = 20
GRAM = 5
BATCH_CHARS = 4_000_000  # text a worker parses at a time
COUNT_BITS = 8  # of ``at``, for the number of windows


def _with_tag(docs: DataFrame) -> DataFrame:
    """``_tag``: the text's 64-bit hash; with the id it names a document."""
    return docs.withColumn("_tag", F.xxhash64("text"))


def _slices(b: pa.RecordBatch, chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``chars`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // chars
    at = 0
    for end in [*(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]:
        if end > at:
            yield b.slice(at, end - at)
        at = end


class _Parsed:
    """The phrases of one batch of documents."""

    def __init__(self, texts: list[str | None], hashes: WordHashes, window: int, gram: int):
        ws = [words(t) for t in texts]
        sizes = np.array([len(w) for w in ws], dtype=np.int64)
        self.first_word = np.concatenate([[0], np.cumsum(sizes)])[:-1] if len(ws) else np.empty(0, np.int64)
        self.ranges = RangeHashes(hashes.of([w for x in ws for w in x]))
        self.window = window
        grams = self.ranges.grams(gram)
        per_window = window - gram + 1
        counts = np.maximum(sizes - window + 1, 0)
        rows = np.repeat(np.arange(len(ws)), counts)
        # starts of all windows that lie within one document
        starts = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts) + self.first_word[rows]
        if not len(starts):
            self.row = self.start = self.count = self.anchor = self.phrase = np.empty(0, np.int64)
            return
        least = np.lib.stride_tricks.sliding_window_view(grams, per_window).argmin(1)
        anchor = starts + least[starts]
        new = np.flatnonzero(np.diff(anchor, prepend=-1))
        end = np.append(new[1:], len(starts))
        self.row, self.start, self.count = rows[new], starts[new], end - new
        self.anchor = grams[anchor[new]]
        self.phrase = self.ranges.of(self.start, self.start + self.count - 1 + window)

    def place(self) -> np.ndarray:
        return self.start - self.first_word[self.row]


def _pack(place: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (place.astype(np.int64) << COUNT_BITS) | count.astype(np.int64)


def _place() -> Column:
    return F.shiftright("at", COUNT_BITS)


def phrases(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``anchor, phrase, doc_id, tag, at, known``: the first copy of each phrase in each
    batch, and the other copies with ``known`` (an earlier one is in the batch)."""
    src = _with_tag(docs.select("doc_id", "text"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for part in _slices(b):
                t = pa.Table.from_batches([part])
                # in document order, each document once: the first copy in the batch is the earliest
                t = t.take(pc.sort_indices(t, [("doc_id", "ascending"), ("_tag", "ascending")], null_placement="at_start"))
                ids, tags = t.column("doc_id"), t.column("_tag").to_numpy()
                if t.num_rows > 1:
                    same = pc.equal(ids[1:], ids[:-1])
                    same = pc.fill_null(same, False).to_numpy(zero_copy_only=False) if t.num_rows else np.empty(0)
                    nulls = ids.is_null().to_numpy(zero_copy_only=False)
                    fresh = ~((same | (nulls[1:] & nulls[:-1])) & (tags[1:] == tags[:-1]))
                    keep = np.append(True, fresh)
                    t, tags = t.filter(pa.array(keep)), tags[keep]
                    ids = t.column("doc_id")
                p = _Parsed(t.column("text").to_pylist(), hashes, window, gram)
                if not len(p.row):
                    continue
                _, first = np.unique(p.phrase, return_index=True)
                known = np.ones(len(p.row), dtype=bool)
                known[first] = False
                # settled copies are spread evenly; nothing needs them together
                anchor = np.where(known, p.phrase ^ (np.arange(len(p.row)).astype(np.uint64) << np.uint64(20)), p.anchor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(p.phrase.view(np.int64)),
                     ids.combine_chunks().take(pa.array(p.row)) if ids.num_chunks else ids,
                     pa.array(tags[p.row]), pa.array(_pack(p.place(), p.count)), pa.array(known)],
                    names=["anchor", "phrase", "doc_id", "tag", "at", "known"])

    return src.mapInArrow(trimmed(run), f"anchor long, phrase long, doc_id {id_type}, tag long, at long, known boolean")


def _boundary_windows(docs: DataFrame, open_phrases: DataFrame, window: int) -> DataFrame:
    """``hash, doc_id, tag, at`` for the windows of phrases at factor boundaries."""
    per_doc = (open_phrases.groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_t"))
               .agg(F.array_distinct(F.collect_list("at")).alias("ats")))
    src = _with_tag(docs.select("doc_id", "text"))
    joined = (src.join(per_doc.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tag") == F.col("_t")))
              .select("doc_id", "text", "_tag", "ats"))
    id_type = joined.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for part in _slices(b):
                ws = [words(t) for t in part.column("text").to_pylist()]
                ranges = RangeHashes(hashes.of([w for x in ws for w in x]))
                first = np.concatenate([[0], np.cumsum([len(w) for w in ws])]).astype(np.int64)
                ats = part.column("ats")
                flat = ats.flatten().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(part.num_rows), np.diff(ats.offsets.to_numpy()))
                count = flat & ((1 << COUNT_BITS) - 1)
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                row, place = np.repeat(row, count), np.repeat(flat >> COUNT_BITS, count) + step
                start = first[row] + place
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ranges.of(start, start + window).view(np.int64)), part.column("doc_id").take(pa.array(row)),
                     part.column("_tag").take(pa.array(row)), pa.array(_pack(place, np.ones_like(place)))],
                    names=["hash", "doc_id", "tag", "at"])

    return joined.mapInArrow(trimmed(run), f"hash long, doc_id {id_type}, tag long, at long")


def factors(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, tag, at``: every duplicate span as a packed (start, windows)."""
    rows = phrases(docs, window=window, gram=gram).repartition("anchor")
    order = [F.col("doc_id").asc_nulls_first(), F.col("tag").asc(), _place().asc()]
    copies = Window.partitionBy("anchor", "phrase").orderBy(*order)
    # rank, not row number: a repeated row is the same document, not a later copy
    ranked = rows.withColumn("_rank", F.rank().over(copies))
    fresh = (F.col("_rank") == 1) & ~F.col("known")
    ranked = ranked.withColumn("_new", F.min(F.when(fresh, F.col("phrase"))).over(Window.partitionBy("anchor"))
                               != F.max(F.when(fresh, F.col("phrase"))).over(Window.partitionBy("anchor")))
    # a factor: not the first copy; an open phrase: first, but its anchor has other phrases too
    parsed = stage(ranked.select("doc_id", "tag", "at", (F.col("known") | (F.col("_rank") > 1)).alias("factor"),
                                 F.col("_new").alias("_open"))
                   .where(F.col("factor") | F.col("_open")).select("doc_id", "tag", "at", "factor"), "dedup-phrases")
    release(docs.sparkSession)
    windows = _boundary_windows(docs, parsed.where(~F.col("factor")), window)
    again = windows.withColumn("_rank", F.rank().over(Window.partitionBy("hash").orderBy(*order))).where(F.col("_rank") > 1)
    return parsed.where("factor").select("doc_id", "tag", "at").unionByName(again.select("doc_id", "tag", "at"))


def spans(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, tag, start, n_words`` of every duplicate span (they may overlap);
    ``tag`` is the hash of the document's text."""
    return factors(docs, window=window, gram=gram).select(
        "doc_id", "tag", _place().alias("start"),
        (F.pmod(F.col("at"), F.lit(1 << COUNT_BITS)) + window - 1).alias("n_words")).distinct()


def _stretches(text: str, stay: list[int]) -> str:
    """The text between the first and last word of every run of kept words."""
    at = [m.span() for m in WORD_RE.finditer(text)]
    runs: list[list[int]] = []
    for i in stay:
        if runs and i == runs[-1][1] + 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    return "\n".join(text[at[a][0]:at[b][1]] for a, b in runs)


def deduplicate(docs: DataFrame, *, window: int, gram: int = GRAM) -> DataFrame:
    """``docs`` with duplicate passages cut from ``text`` (``n_chars`` follows) and
    without the documents of which nothing is left."""
    # the row travels as one value, so no column of it can clash with those of the result
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in others]).alias("_doc"))
    out = remove(packed, window=window, gram=gram, with_text=True)
    out = out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    values = {c: F.col("_doc").getField(c) for c in others} | {"text": F.col("kept_text")}
    if "n_chars" in others:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(kind)).otherwise(values["n_chars"])
    return out.select(*[values[c].alias(c) for c in docs.columns])


def remove(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """``docs`` without its text, plus ``n_words, n_removed, kept_sha256`` (and, if
    asked for, ``kept_text``: the text itself, or its kept stretches on lines of
    their own if words were removed).  Columns of these names, or ``_id, _t, _tag,
    _ats``, are not returned; ``deduplicate`` keeps all."""
    own = {"n_words", "n_removed", "kept_sha256", "kept_text", "_id", "_t", "_tag", "_ats"}
    found = factors(docs, window=window, gram=gram)
    per_doc = found.groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_t")).agg(F.collect_list("at").alias("_ats"))
    others = [c for c in docs.columns if c != "text" and c not in own]
    src = _with_tag(docs.select(*[F.col(f"`{c}`") for c in others], "text"))
    joined = (src.join(per_doc.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tag") == F.col("_t")), "left")
              .select(*[F.col(f"`{c}`") for c in others], "text", "_ats"))
    from pyspark.sql import types as T
    schema = T.StructType([f for f in joined.schema.fields if f.name in others]
                          + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                             T.StructField("kept_sha256", T.StringType())]
                          + [T.StructField("kept_text", T.StringType())] * with_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b):
                n_words, n_removed, digest, kept = [], [], [], []
                for text, ats in zip(part.column("text").to_pylist(), part.column("_ats"), strict=True):
                    ws, out = words(text), text
                    n_words.append(len(ws))
                    if ats.is_valid:
                        at = np.array(ats.as_py(), dtype=np.int64)
                        edge = np.zeros(len(ws) + 1, dtype=np.int64)
                        place = at >> COUNT_BITS
                        np.add.at(edge, place, 1)
                        np.add.at(edge, place + (at & ((1 << COUNT_BITS) - 1)) + window - 1, -1)
                        stay = np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()
                        ws = [ws[i] for i in stay]
                        if with_text:
                            out = _stretches(text, stay)
                    n_removed.append(n_words[-1] - len(ws))
                    digest.append(hashlib.sha256(" ".join(ws).encode("utf-8", "surrogatepass")).hexdigest())
                    kept.append(out)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in others] + [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                                        pa.array(digest, pa.string())] + [pa.array(kept, pa.string())] * with_text,
                    names=[f.name for f in schema.fields])

    return joined.mapInArrow(trimmed(run), schema)
