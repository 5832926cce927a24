"""Sinks and write-side operators."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.text import output_name
from textmill.session import cut_lineage


def write_json(df: DataFrame, path: str, by: str | list[str] | None = None,
               mode: str = "overwrite") -> str:
    """JSON lines (UTF-8, non-ASCII unescaped), one folder; ``by`` writes one
    sub-folder per value (e.g. per document).  For many values give a bucket
    column (see :func:`write_document_json`)."""
    w = df.write.mode(mode)
    if by:
        w = w.partitionBy(*([by] if isinstance(by, str) else by))
    w.json(path)
    return path


def write_json_array(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON array files (``.json``), one a partition, an element a line."""
    rows = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))

    def run(batches):
        first = True
        for b in batches:
            out = [("[" if first and not i else ",") + v for i, v in enumerate(b.column(0).to_pylist())]
            first = first and not out
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], names=["value"])

    # a line is one cell: JSON text holds no control characters, so nothing is quoted
    # (the text writer can't name its files .json, the CSV writer can)
    (rows.mapInArrow(run, "value string").write.mode(mode).option("extension", "json").option("sep", "\u0001")
     .option("quote", "").option("escapeQuotes", False).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def write_document_json(chunks: DataFrame, path: str, buckets: int = 64, mode: str = "overwrite") -> str:
    """Chunks as JSON lines in ``buckets`` folders by document, each row with the
    document's file name ``<stem>.chunks.json`` in ``file_name``: a reader finds a
    document in one folder, and a million documents don't make a million files.
    A document's rows stay together and in chunk order."""
    name = output_name(F.col("document_id").cast("string"))
    b = F.pmod(F.xxhash64("document_id"), F.lit(buckets)).cast("int")
    (chunks.withColumn("file_name", name).withColumn("bucket", b).repartition("bucket", "document_id")
     .sortWithinPartitions("bucket", "file_name", "page_number", "chunk_index")
     .write.mode(mode).partitionBy("bucket").json(path))
    return path


def dedupe(df: DataFrame, key: str, order: str = "rank", on_duplicate: str = "first",
           sum_cols: tuple[str, ...] = ("frequency",)) -> DataFrame:
    """One row per key.  ``first`` keeps the row lowest in ``order``;
    ``sum`` keeps that row but adds up ``sum_cols`` over the duplicates.
    A grouped aggregate (partial on the map side), so a key repeated in
    every task is reduced before the shuffle."""
    others = [c for c in df.columns if c != key]
    agg = [F.min_by(F.struct(*others), F.col(order)).alias("_row")]
    if on_duplicate == "sum":
        agg += [F.sum(c).alias(f"_sum_{c}") for c in sum_cols]
    elif on_duplicate != "first":
        raise ValueError(f"unknown duplicate policy: {on_duplicate!r}")
    g = df.groupBy(key).agg(*agg)
    cols = [F.col(key)]
    for c in others:
        if on_duplicate == "sum" and c in sum_cols:
            cols.append(F.col(f"_sum_{c}").cast(dict(df.dtypes)[c]).alias(c))
        else:
            cols.append(F.col(f"_row.{c}").alias(c))
    return g.select(*cols)


def upsert(target: DataFrame, source: DataFrame, key: str, order: str = "rank",
           on_duplicate: str = "first") -> DataFrame:
    """Merge ``source`` into ``target`` on ``key``: source rows replace
    matching target rows, new keys are inserted, other target rows stay
    (never deleted).  Running it again with the same source changes
    nothing.  An anti-join plus a union: two shuffles by key, no broadcast
    of either side unless the planner has measured it small."""
    src = dedupe(source, key, order, on_duplicate) if order in source.columns else source.dropDuplicates([key])
    kept = target.join(src.select(key), key, "left_anti")
    unsent = [c for c in target.columns if c not in src.columns]
    if unsent:  # an update touches only the columns it sends
        src = src.join(target.select(key, *unsent).dropDuplicates([key]), key, "left")
    return kept.unionByName(src, allowMissingColumns=True)


def write_upsert(spark, target_path: str | None, source: DataFrame, key: str, out_path: str,
                 order: str = "rank") -> str:
    """Merge into the table at ``target_path`` by writing the merged table to
    ``out_path``; when both are the same folder, the merged table is written
    beside it first and replaces it by a rename."""
    if target_path:
        merged = upsert(spark.read.parquet(target_path), source, key, order)
    else:
        merged = dedupe(source, key, order) if order in source.columns else source.dropDuplicates([key])
    if target_path != out_path:
        merged.write.mode("errorifexists").parquet(out_path)
        return out_path
    new = f"{out_path.rstrip('/')}.new-{uuid.uuid4().hex}"
    merged.write.mode("errorifexists").parquet(new)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(out_path).getFileSystem(spark._jsc.hadoopConfiguration())
    old = f"{out_path.rstrip('/')}.old-{uuid.uuid4().hex}"
    if not (fs.rename(path(out_path), path(old)) and fs.rename(path(new), path(out_path))):
        raise OSError(f"could not swap {new} into {out_path}")
    fs.delete(path(old), True)
    return out_path


def number_rows(df: DataFrame, order: list[str], out: str = "row_index") -> DataFrame:
    """Exact global 0-based row numbers in ``order`` without a one-partition
    window: range-partition and sort, count rows per partition (a table with
    one row per partition), turn the counts into offsets and add each row's
    place inside its partition.

    The sorted table is written once, with each row's partition and place, and
    counts and rows both come from what was written: two evaluations could cut
    the ranges differently.  Ties in ``order`` are numbered in any order."""
    t = (df.repartitionByRange(*order).sortWithinPartitions(*order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()))
    t = cut_lineage(t, "numbered")
    counts = t.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.withColumn("_off", F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["_off"])
    # one row per partition of the sorted table
    j = t.join(F.broadcast(offs.select("_pid", "_off")), "_pid")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return j.withColumn(out, (F.col("_off") + local).cast("long")).drop("_pid", "_mid", "_off")


def number_batches(df: DataFrame, order: list[str], size: int = 50) -> DataFrame:
    """Add ``batch = row_index // size`` (50 for inserts, 500 for upserts)."""
    n = number_rows(df, order)
    return n.withColumn("batch", F.floor(F.col("row_index") / size).cast("long"))


def batch_report(batched: DataFrame, failed) -> DataFrame:
    """Per batch: ``rows, ok, failed``.  A batch fails as a whole when any
    of its rows meets ``failed`` (a boolean Column)."""
    g = batched.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"),
                                     F.max(F.when(failed, 1).otherwise(0)).alias("_bad"))
    return g.select("batch", "rows",
                    F.when(F.col("_bad") == 0, F.col("rows")).otherwise(0).cast("long").alias("ok"),
                    F.when(F.col("_bad") == 1, F.col("rows")).otherwise(0).cast("long").alias("failed"))


def batch_totals(report: DataFrame) -> DataFrame:
    return report.agg(F.sum("ok").alias("successful"), F.sum("failed").alias("failed"))


def pending(chunks: DataFrame, done: DataFrame,
            keys=("document_id", "page_number", "chunk_index", "content_hash", "embedding_model")) -> DataFrame:
    """Rows of ``chunks`` with no finished counterpart in ``done`` (row-level
    incremental re-run: a changed text changes its hash)."""
    keys = list(keys)
    return chunks.join(done.select(*keys), keys, "left_anti")


def append(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Plain append (no key, a re-run appends again)."""
    df.write.mode("append").format(fmt).save(path)
    return path


def insert_batches(df: DataFrame, order: list[str], path: str, size: int = 50, failed=None,
                   fmt: str = "parquet") -> DataFrame:
    """Insert in batches of ``size`` rows (in ``order``): a batch with any
    row meeting ``failed`` is counted as failed and skipped, the others are
    appended; returns the per-batch report (a failed batch is not fatal)."""
    b = number_batches(df, order, size)
    bad = failed if failed is not None else F.lit(False)
    # a batch holds at most `size` rows: this window's groups are bounded
    flagged = b.withColumn("_bad", F.max(F.when(bad, 1).otherwise(0)).over(Window.partitionBy("batch")))
    flagged = cut_lineage(flagged, "insert")  # the insert and the report see the same rows
    flagged.filter(F.col("_bad") == 0).drop("_bad", "row_index").write.mode("append").format(fmt).save(path)
    return batch_report(flagged, F.col("_bad") == 1)


def write_page_parts(pages: DataFrame, path: str, size: int = 100, fmt: str = "parquet",
                     buckets: int = 64) -> str:
    """Write pages with their part of ``size`` pages (``part = (page_number - 1) //
    size``) in ``buckets`` folders by document and part, rows in page order: the
    number of files follows the buckets, not the documents."""
    b = F.pmod(F.xxhash64("document_id", "part"), F.lit(buckets)).cast("int")
    (pages.withColumn("part", F.floor((F.col("page_number") - 1) / size).cast("long")).withColumn("bucket", b)
     .repartition("bucket", "document_id", "part").sortWithinPartitions("bucket", "document_id", "page_number")
     .write.mode("overwrite").partitionBy("bucket").format(fmt).save(path))
    return path
