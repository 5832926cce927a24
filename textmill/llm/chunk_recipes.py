"""Exact dedup by content-defined chunk recipes.

Every normalised text is cut where a hash of eight bytes says so, whatever lies
before, so equal texts are cut alike.  A text's recipe is the ordered list of its
chunks' 128-bit identifiers (one binary value of 16 bytes a chunk); texts are equal
if their recipes are.  The identifiers are verified: all distinct (identifier, bytes)
pairs are brought together once, and should an identifier stand for two different
byte strings, everything is cut again with identifiers under another seed.  Chunk
bytes move once, deduplicated before the shuffle; after that only recipes move, a
sixtieth of the text.

Null counts as the empty text (an empty recipe).  A null id counts as the smallest.
Rows that repeat id and text are rows of one group, of which one stays.  Other
columns of the input are never looked at by ``groups``; ``deduplicate`` returns them.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

MIN_CHUNK, MAX_CHUNK, MASK_BITS = 256, 8192, 10  # a cut every 2**10 bytes or so beyond the least
HEAVY = 1000  # a group above a thousandth of all rows is heavy: fewer than a thousand can be
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 20  # window hashes computed at once


def cut_places(data: bytes) -> list[int]:
    """Ends of all eight-byte windows whose hash asks for a cut, ascending."""
    n = len(data) - 7
    if n <= 0:
        return []
    at8 = np.ndarray(shape=(n,), dtype="<u8", buffer=data, strides=(1,))
    out = []
    with np.errstate(over="ignore"):
        for s in range(0, n, _BLOCK):
            h = (at8[s:s + _BLOCK] * _MULTIPLIER) >> np.uint64(64 - MASK_BITS)
            out.append(np.flatnonzero(h == 0) + (s + 8))
    return np.concatenate(out).tolist()


def chunk_ends(places: list[int], start: int, end: int) -> list[int]:
    """Ends of the chunks of the text at ``start:end`` of a buffer with these places:
    at least ``MIN_CHUNK`` (but the last), at most ``MAX_CHUNK`` bytes each."""
    out, at = [], start
    while end - at > MIN_CHUNK:
        i = bisect_left(places, at + MIN_CHUNK)
        cut = min(places[i] if i < len(places) else end, at + MAX_CHUNK, end)
        out.append(cut)
        at = cut
    if at < end:
        out.append(end)
    return out


def _recipes(docs: DataFrame, id_col: str, text: str, seed: int, key_bytes: int) -> DataFrame:
    """Rows of two kinds: a row a text (``uid`` set) with its hash and recipe, and a
    row a distinct chunk of each batch (``key``, ``chunk``)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("uid"))
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "uid", "text_sha256", "recipe", "key", "chunk"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "").cast(pa.large_binary())
            sha, recipes, seen, extra = [], [], {}, []
            for value in texts:
                data = value.as_py().translate(_LOWER)
                sha.append(hashlib.sha256(data).hexdigest())
                places = cut_places(data) if len(data) > MIN_CHUNK else []
                at, keys = 0, []
                for end in chunk_ends(places, 0, len(data)):
                    chunk = data[at:end]
                    key = xxhash.xxh3_128_digest(chunk, seed=seed)[:key_bytes]
                    keys.append(key)
                    known = seen.setdefault(key, chunk)
                    if known is not chunk and known != chunk:
                        extra.append((key, chunk))
                    at = end
                recipes.append(b"".join(keys))
            n, pairs = len(sha), [*seen.items(), *extra]
            none = [None] * len(pairs)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([batch.column(0), pa.nulls(len(pairs), batch.column(0).type)]),
                pa.concat_arrays([batch.column(2), pa.nulls(len(pairs), pa.int64())]),
                pa.array(sha + none, pa.string()), pa.array(recipes + none, pa.binary()),
                pa.array([None] * n + [k for k, _ in pairs], pa.binary()),
                pa.array([None] * n + [c for _, c in pairs], pa.binary())], names=names)

    return rows.mapInArrow(run, f"id {kind}, uid long, text_sha256 string, recipe binary, key binary, chunk binary")


def verified_recipes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", key_bytes: int = 16) -> DataFrame:
    """``id, uid, text_sha256, recipe`` of every row, under identifiers that were
    found to stand for one byte string each.  ``key_bytes`` under 16 makes
    collisions likely (tests); each new attempt doubles it and changes the seed."""
    for seed in range(32):
        both = stage(_recipes(docs, id_col, text, seed, min(16, key_bytes << seed)), "recipes")
        chunks = both.filter(F.col("key").isNotNull()).select("key", "chunk").distinct()
        if chunks.groupBy("key").count().filter("count > 1").limit(1).count() == 0:
            return both.filter(F.col("uid").isNotNull()).select("id", "uid", "text_sha256", "recipe")
    raise RuntimeError("chunk identifiers kept colliding")


def groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", key_bytes: int = 16) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id, group_size, kept, text_sha256``.
    Of rows with equal recipes the one with the largest id stays.

    Groups are counted with partial sums in every task.  Rows meet their group by a
    broadcast of the fewer than ``HEAVY`` groups that hold over 1/HEAVY of all
    rows, and by a shuffle for the rest, where no key is heavy."""
    rows = verified_recipes(docs, id_col, text, key_bytes)
    g = stage(rows.groupBy("recipe").agg(F.max(F.struct("id", "uid")).alias("top"), F.count(F.lit(1)).alias("size")),
              "recipe-groups")
    bound = g.agg(F.sum("size")).first()[0] or 0
    # at most HEAVY - 1 rows by the definition of heavy
    heavy = g.filter(F.col("size") * HEAVY > bound)
    light = rows.join(F.broadcast(heavy.select("recipe")), "recipe", "left_anti")
    both = rows.join(F.broadcast(heavy), "recipe").unionByName(
        light.join(g.filter(F.col("size") * HEAVY <= bound), "recipe"))
    return both.select(F.col("id").alias(id_col), F.col("top.id").alias("keep_id"), F.col("size").alias("group_size"),
                       (F.col("uid") == F.col("top.uid")).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose row stays, with all columns.  Rows that share an id are
    one document here: an id stays whole if any of its rows stays."""
    kept = groups(docs, id_col, text).filter("kept").select(F.col(id_col).alias("_keep")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_keep"]), "left_semi")
