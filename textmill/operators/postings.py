"""Postings table of the context corpora: phrases look their terms up instead of
scanning every text (J4).

Layout: ``<path>/batch-<number>/`` holds what one :func:`sync_postings` changed:
``held`` (``corpus, id, hash`` of the texts it added), ``closed`` (``corpus, id, batch``
of texts it replaced or found gone) and ``postings`` (in folders by hash of the term;
a row holds the postings of a few thousand texts of a corpus in that folder: their
ids, the terms, and for each term the places of its texts among them).  A batch is written beside the table and moved in by one rename, so
the table is whole at every moment; a dead sync leaves a ``building-`` folder that
nobody reads.  One writer at a time; a second one that took the same number fails and
may be run again.

A lookup reads the term folders of its phrases only.  What moves is a number for each
document and phrase term it holds, keyed by the document, so frequent words make no
document-phrase pairs and no hot key; each task keeps its top rows of a phrase.
A text is known by its id and 64-bit hash: an edit that kept the hash would be missed.

Defined cases: rows without id or text have no postings; of several texts of one id
the one of the largest hash counts; a text without terms is held without postings; the
same sync twice adds nothing.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.operators.keyed import BUCKET, _fs, _names, _path
from textmill.operators.summary import _terms
from textmill.session import cut_lineage

PLACE = ["corpus", "id", "batch"]
HELD, CLOSED = "corpus string, id string, hash long", "corpus string, id string, batch long"


def _batches(spark: SparkSession, path: str) -> list[tuple[int, int, str]]:
    """(number, buckets, folder) of every whole batch."""
    found = [n for n in _names(spark, path) if n.startswith("batch-")]
    return [(int(n.split("-")[1]), int(n.split("-")[2]), f"{path}/{n}") for n in found]


def _union(frames: list[DataFrame]) -> DataFrame | None:
    return reduce(DataFrame.unionByName, frames) if frames else None


def _closed(spark: SparkSession, batches: list[tuple[int, int, str]]) -> DataFrame:
    return spark.read.schema(CLOSED).parquet(*[f"{p}/closed" for _, _, p in batches])


def held_texts(spark: SparkSession, path: str) -> DataFrame | None:
    """``corpus, id, hash, batch`` of the texts that count now; None before the first sync."""
    batches = _batches(spark, path.rstrip("/"))
    rows = _union([spark.read.schema(HELD).parquet(f"{p}/held").withColumn("batch", F.lit(n).cast("long"))
                   for n, _, p in batches])
    return None if rows is None else rows.join(_closed(spark, batches), PLACE, "left_anti")


LISTS = "bucket int, corpus string, ids array<string>, terms array<string>, counts array<int>, places binary"
TEXTS = 4096  # of a row: their places are numbers of 16 bits


def _term_lists(batch: pa.RecordBatch) -> pa.RecordBatch:
    """``corpus, id, terms, buckets`` of texts of one corpus -> a row of ``LISTS`` a bucket: neither ids
    nor terms are repeated for each pair of them."""
    terms = batch.column(2)
    texts = np.repeat(np.arange(len(batch)), np.diff(terms.offsets.to_numpy()))
    words = terms.flatten().dictionary_encode()
    word, bucket = words.indices.to_numpy(), batch.column(3).flatten().to_numpy()
    order = np.lexsort((texts, word, bucket))
    texts, word, bucket = texts[order], word[order], bucket[order]
    starts = np.flatnonzero(np.r_[True, (word[1:] != word[:-1])]) if len(word) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(word)))
    rows: list[tuple] = []
    for k in np.unique(bucket):
        lo, hi = np.searchsorted(bucket, [k, k + 1])
        f, t = np.searchsorted(starts, [lo, hi])
        held, place = np.unique(texts[lo:hi], return_inverse=True)
        rows.append((int(k), held, word[starts[f:t]], counts[f:t], place.astype("<u2").tobytes()))

    def lists(values, at):
        offsets = np.concatenate([[0], np.cumsum([len(r[at]) for r in rows])]).astype(np.int32)
        flat = np.concatenate([r[at] for r in rows]) if rows else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)) if values is None else values.take(pa.array(flat)))

    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), batch.column(0).take(pa.array([0] * len(rows), pa.int64())), lists(batch.column(1), 1), lists(words.dictionary, 2),
         lists(None, 3), pa.array([r[4] for r in rows], pa.binary())], names=["bucket", "corpus", "ids", "terms", "counts", "places"])


def _cut(batches):
    for batch in batches:
        for name in batch.column(0).unique().to_pylist():
            mine = np.flatnonzero(np.array(batch.column(0).to_pylist(), object) == name)
            for s in range(0, len(mine), TEXTS):
                yield _term_lists(batch.take(pa.array(mine[s:s + TEXTS])))


def _look_up(numbers: dict[str, int]):
    """``LISTS`` with a batch number -> ``corpus, id, batch, _t`` of the terms in ``numbers``."""
    def run(batches):
        for batch in batches:
            corpus, ids, terms, counts, places, number = (batch.column(c).to_pylist() if c == 4 else batch.column(c) for c in range(6))
            for i in range(len(batch)):
                wanted = [numbers.get(t, -1) for t in terms[i].as_py()]
                times = counts[i].values.to_numpy() if len(counts[i]) else np.zeros(0, np.int32)
                t = np.repeat(np.array(wanted, np.int32), times)
                keep = np.flatnonzero(t >= 0)
                if len(keep):
                    at = pa.array(np.frombuffer(places[i], "<u2")[keep])
                    yield pa.RecordBatch.from_arrays(
                        [corpus.take(pa.array(np.full(len(keep), i))), ids[i].values.take(at), pa.array(np.full(len(keep), number[i].as_py(), np.int64)),
                         pa.array(t[keep])], names=["corpus", "id", "batch", "_t"])
    return run


def sync_postings(corpora: dict[str, DataFrame], path: str, complete: bool = False, buckets: int = 64) -> tuple[int, int]:
    """Bring the table at ``path`` up to ``corpora`` (``id, text`` each); returns how many
    texts were added and how many closed.

    New and changed texts get postings, the postings of a replaced text are closed and
    unchanged texts are not cut into terms again.  ``complete``: ids that a given corpus
    no longer holds are closed too.  ``buckets`` is fixed by the first sync."""
    path = path.rstrip("/")
    rows = _union([c.select(F.lit(name).alias("corpus"), F.col("id").cast("string").alias("id"), "text",
                            F.xxhash64("text").alias("hash")) for name, c in corpora.items()])
    if rows is None:
        return 0, 0
    spark = rows.sparkSession
    rows = rows.where(F.col("id").isNotNull() & F.col("text").isNotNull())
    batches = _batches(spark, path)
    n = batches[0][1] if batches else buckets
    number = max([b[0] for b in batches], default=0) + 1
    building = f"{path}/building-{uuid.uuid4().hex}"
    now = rows.groupBy("corpus", "id").agg(F.max("hash").alias("hash"))  # no text moves
    held = held_texts(spark, path)
    if held is None:
        held = spark.createDataFrame([], HELD + ", batch long")
    both = now.join(held.withColumnRenamed("hash", "old"), ["corpus", "id"], "full")
    if not complete:
        both = both.where(F.col("hash").isNotNull())
    diff = cut_lineage(both.where(F.col("corpus").isin(*corpora) & ~F.col("hash").eqNullSafe(F.col("old"))), "postings-diff")
    added = diff.where(F.col("hash").isNotNull()).select("corpus", "id", "hash")
    gone = diff.where(F.col("batch").isNotNull()).select(*PLACE)
    counts = added.count(), gone.count()
    if not any(counts):
        return counts
    added.write.parquet(f"{building}/held")
    gone.write.parquet(f"{building}/closed")
    # texts move only if some of them are left out
    new = rows if rows.count() == counts[0] else rows.join(added, ["corpus", "id", "hash"], "left_semi")
    cut = new.select("corpus", "id", _terms(F.col("text")).alias("terms"))
    cut = cut.withColumn("buckets", F.transform("terms", lambda t: F.pmod(F.xxhash64(t), F.lit(n)).cast("int")))
    (cut.mapInArrow(_cut, LISTS).withColumnRenamed("bucket", BUCKET)
     .hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET)
     .write.partitionBy(BUCKET).parquet(f"{building}/postings"))
    batch, fs = f"{path}/batch-{number:06d}-{n}", _fs(spark, path)
    if fs.exists(_path(spark, batch)) or not fs.rename(_path(spark, building), _path(spark, batch)):
        raise OSError(f"could not move {building} to {batch}")
    return counts


def postings_hits(phrases: DataFrame, path: str, limits: dict[str, int], key: str = "canonical") -> DataFrame:
    """``key, corpus, rank, id, hits`` as ``summary.context_hits`` gives them, from the
    postings at ``path``; ``phrases`` are bounded (top clusters x phrase width)."""
    spark, path = phrases.sparkSession, path.rstrip("/")
    batches = _batches(spark, path)
    # phrases and their terms by number: a few thousand rows at most
    names = phrases.select(key).distinct().withColumn("_p", F.row_number().over(Window.orderBy(key)))
    lists = (names.select("_p", F.explode(_terms(F.col(key))).alias("term"))
             .groupBy("term").agg(F.array_sort(F.collect_list("_p")).alias("_ps"))
             .withColumn("_t", F.row_number().over(Window.orderBy("term"))))
    lookup = lists.agg(F.map_from_entries(F.collect_list(F.struct("_t", "_ps"))).alias("_m")).scalar()
    if batches:
        n = batches[0][1]
        asked = {r[0] for r in lists.select(F.pmod(F.xxhash64("term"), F.lit(n)).cast("int")).distinct().collect()}
        parts = []  # at most n folders a batch
        for number, _, p in batches:
            mine = [f"{p}/postings/{b}" for b in _names(spark, f"{p}/postings")
                    if b.startswith(f"{BUCKET}=") and int(b.split("=")[1]) in asked]
            if mine:
                parts.append(spark.read.schema(LISTS).parquet(*mine).drop("bucket").withColumn("batch", F.lit(number).cast("long")))
        found = _union(parts)
    else:
        found = None
    if found is None:
        found = spark.createDataFrame([], LISTS + ", batch long").drop("bucket")
    numbers = {r["term"]: r["_t"] for r in lists.select("term", "_t").collect()}
    found = found.mapInArrow(_look_up(numbers), "corpus string, id string, batch long, _t int").where(F.col("corpus").isin(*limits))
    if batches:
        found = found.join(_closed(spark, batches), PLACE, "left_anti")
    per_text = found.groupBy(*PLACE).agg(F.collect_set("_t").alias("_ts")).withColumn("_m", lookup)
    hit = F.flatten(F.transform("_ts", lambda t: F.try_element_at("_m", t)))
    per = F.transform(F.array_distinct("_h"), lambda p: F.struct(
        p.alias("_p"), F.size(F.filter("_h", lambda q: q == p)).cast("long").alias("hits")))
    rows = (per_text.select("corpus", "id", hit.alias("_h")).select("corpus", "id", F.explode(per).alias("_x"))
            .select("corpus", "id", "_x._p", "_x.hits"))
    w = Window.partitionBy("corpus", "_p").orderBy(F.desc("hits"), F.asc("id"))
    most = F.create_map(*[F.lit(x) for item in limits.items() for x in item])[F.col("corpus")]
    return (rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max(limits.values()))
            .where(F.col("rank") <= most).join(F.broadcast(names), "_p").select(key, "corpus", "rank", "id", "hits"))
