"""Helpers shared by the corpus operators.

``WORD`` is the word rule of every operator here: a maximal run of characters
other than space and the controls 0x09-0x0D.  ``words`` is its exact Python
twin (``str.split`` would also split at other Unicode spaces).
"""

from __future__ import annotations

import gc
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.session import cut_lineage, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
# Characters that str.split takes for spaces and the word rule does not.
_OTHER_SPACES = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
WORD_RE = re.compile(WORD)


def words(text: str | None) -> list[str]:
    """Words of a text; empty for null and for blank texts."""
    if not text:
        return []
    return text.split() if _OTHER_SPACES.search(text) is None else WORD_RE.findall(text)


def word_count(text: Column) -> Column:
    """Number of words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a stage table that no later plan reads."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished jobs now; by itself
    it waits for the driver's next full collection (every 30 minutes)."""
    gc.collect()
    spark._jvm.System.gc()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back."""
    return cut_lineage(df, name)


def stage_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stage``, with the path, for tables that are dropped afterwards."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


def free_memory() -> None:
    """Give a worker's free pages back: allocators keep them for the next task, and a
    reused worker would hold the largest of all its tasks."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def trimmed(run):
    """An Arrow batch function that frees its worker's memory when its task ends."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            free_memory()
    return wrapped


def source_key(source: Column) -> Column:
    """Non-null text key of a source that sorts by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to ``limit`` words."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, ws: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), dtype=np.uint64, count=len(ws))


class RangeHashes:
    """64-bit hashes of any word range of one array of word hashes.

    Polynomial hashes modulo 2**64 by prefix sums; the factor of the range's
    start is divided out, so equal word sequences have equal hashes.
    """

    _BASE = 0x9E3779B97F4A7C15
    _powers = np.ones(1, dtype=np.uint64)
    _inverses = np.ones(1, dtype=np.uint64)

    def __init__(self, h: np.ndarray):
        cls, n = type(self), len(h) + 1
        if len(cls._powers) < n:
            cls._powers = self._series(cls._BASE, 2 * n)  # shared by a worker's batches
            cls._inverses = self._series(pow(cls._BASE, -1, 1 << 64), 2 * n)
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(h * cls._powers[:n - 1], out=self.sums[1:])

    @staticmethod
    def _series(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self._inverses[starts]
        return mix64(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return self.of(np.arange(n), np.arange(k, n + k)) if n > 0 else np.empty(0, dtype=np.uint64)


def running_offsets(rows: DataFrame, levels: list[str], value: str, name: str) -> DataFrame:
    """``levels, name``: per cell (one combination of ``levels``) the sum of
    ``value`` over all cells before it, in level order, within the first level.

    The sum is taken down a tree: at each level one window over the children of
    one parent, so no partition holds more rows than a parent has children (the
    children of the first level are ordered by the second, and so on).
    """
    from pyspark.sql import Window
    cells = rows.groupBy(*levels).agg(F.sum(value).alias("_v"))
    cells = stage(cells, f"cells-{name.strip('_')}")
    out, total = None, cells
    for depth in range(len(levels), 1, -1):
        keys = levels[:depth]
        if depth < len(levels):
            total = cells.groupBy(*keys).agg(F.sum("_v").alias("_v"))
        w = Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
        part = total.select(*keys, F.coalesce(F.sum("_v").over(w), F.lit(0)).alias(f"_o{depth}"))
        out = part if out is None else out.join(part, keys)
    parts = [F.col(f"_o{d}") for d in range(len(levels), 1, -1)]
    return out.select(*levels, sum(parts[1:], parts[0]).alias(name))
