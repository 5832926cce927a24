"""Keyed table in hash buckets: a merge rewrites only the buckets it touches.

Layout: ``<path>/buckets-<n>/merge-<number>/_bucket=<b>/``.  A merge writes the whole
new content of the touched buckets beside the table and moves it into place by one
rename; a reader takes every bucket from the last merge that holds it.  So files of
untouched buckets are never read, moved or written, and the table is whole at every
moment: a merge that dies leaves a ``building-`` folder that nobody reads.  One writer
at a time; a second one that took the same number fails and may be run again.

The number of buckets is fixed by the first merge.  It bounds the listing on the
driver (one name a bucket and merge), not the table: a bucket is written by as many
tasks as its size asks for.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.sinks import dedupe
from textmill.session import cut_lineage

BUCKET = "_bucket"


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _fs(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder), _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _merges(spark: SparkSession, root: str) -> list[tuple[str, list[str]]]:
    """Whole merges in order, with the names in their folders."""
    found = [(m, _names(spark, f"{root}/{m}")) for m in _names(spark, root) if m.startswith("merge-")]
    return [(m, inside) for m, inside in found if "_SUCCESS" in inside]


def layout(spark: SparkSession, path: str) -> tuple[int | None, dict[int, str]]:
    """(number of buckets, folder of each bucket's last content)."""
    n = [int(x.split("-")[1]) for x in _names(spark, path) if x.startswith("buckets-")]
    if not n:
        return None, {}
    root = f"{path.rstrip('/')}/buckets-{n[0]}"
    return n[0], {int(b.split("=")[1]): f"{root}/{m}/{b}" for m, inside in _merges(spark, root)
                  for b in inside if b.startswith(f"{BUCKET}=")}


def read_keyed(spark: SparkSession, path: str) -> DataFrame | None:
    """The table's rows; None before the first merge that held a row."""
    _, held = layout(spark, path)
    return spark.read.parquet(*held.values()) if held else None


def merge_keyed(source: DataFrame, path: str, key: str, order: str = "rank", on_duplicate: str = "first",
                buckets: int = 64) -> list[int]:
    """Merge ``source`` into the table at ``path``; returns the touched buckets.

    Source rows of a key replace the table's, new keys are added, other rows stay.
    Source rows that share a key are reduced by :func:`dedupe` where ``order`` is a
    column, else to any one of them.  Columns that the source doesn't send keep their
    values (null for new keys); columns that the table doesn't have are refused.
    A null key is a key like any other.  The same merge twice changes no row."""
    spark = source.sparkSession
    if BUCKET in source.columns:
        raise ValueError(f"{BUCKET} names the table's folders and can't be a column")
    n, held = layout(spark, path)
    n = n or buckets
    schema = spark.read.parquet(*held.values()).schema if held else source.schema
    extra = [c for c in source.columns if c not in schema.names]
    if extra:
        raise ValueError(f"the table has no columns {extra}")
    # equal keys of different types would hash to different buckets
    source = source.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema if f.name in source.columns])
    src = dedupe(source, key, order, on_duplicate) if order in source.columns else source.dropDuplicates([key])
    src = cut_lineage(src.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(n)).cast("int")), "merge-source")
    touched = sorted(r[0] for r in src.select(BUCKET).distinct().collect())  # at most n numbers
    if not touched:
        return []
    rows, old = src, [held[b] for b in touched if b in held]
    unsent = [f for f in schema if f.name not in source.columns]
    if old:
        target = spark.read.schema(schema).parquet(*old)
        sent = src.select(F.col(key).alias("_k"))
        same = F.col(key).eqNullSafe(F.col("_k"))
        kept = target.join(sent, same, "left_anti")
        kept = kept.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
        if unsent:
            rows = src.join(target.select(F.col(key).alias("_k"), *[f.name for f in unsent]), same, "left").drop("_k")
        rows = kept.unionByName(rows)
    elif unsent:
        rows = src.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in unsent])
    root = f"{path.rstrip('/')}/buckets-{n}"
    building = f"{root}/building-{uuid.uuid4().hex}"
    rows = rows.select(*schema.names, BUCKET)
    # few files a bucket, and a large bucket over several tasks
    rows.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(building)
    number = max([int(m.split("-")[1]) for m in _names(spark, root) if m.startswith("merge-")], default=0) + 1
    merge = f"{root}/merge-{number:06d}"
    fs = _fs(spark, root)
    if fs.exists(_path(spark, merge)) or not fs.rename(_path(spark, building), _path(spark, merge)):
        raise OSError(f"could not move {building} to {merge}")
    return touched


def clean_keyed(spark: SparkSession, path: str) -> int:
    """Delete replaced buckets and what dead merges left; returns the folders deleted.
    For times without writers and without readers that began before the last merge."""
    n, held = layout(spark, path)
    if n is None:
        return 0
    root, keep, gone = f"{path.rstrip('/')}/buckets-{n}", set(held.values()), []
    for m, inside in _merges(spark, root):
        gone += [f"{root}/{m}/{b}" for b in inside if b.startswith(f"{BUCKET}=") and f"{root}/{m}/{b}" not in keep]
    gone += [f"{root}/{x}" for x in _names(spark, root) if x.startswith("building-")]
    for g in gone:
        _fs(spark, g).delete(_path(spark, g), True)
    return len(gone)
