"""Inserts that can be repeated after a failure (K4).

A load is a named input cut into batches of a fixed size.  Every stored row carries
its load, batch number and the batch's digest, so a second run of the load knows which
batches are there and appends the others only.  A batch is written by one task into
one file, which appears whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators.sinks import number_batches
from textmill.session import cut_lineage, path_exists

MARKS = ("load", "batch", "batch_digest")


def insert_resumable(df: DataFrame, order: list[str], path: str, load: str, size: int = 50, failed=None,
                     fmt: str = "parquet") -> DataFrame:
    """Append the batches of ``load`` that the table at ``path`` doesn't hold yet;
    returns the report ``batch, rows, ok, failed, present`` (rows appended now, refused
    now, there before).

    A batch with a row that meets ``failed`` is refused whole and stays open for the
    next run.  Rows that tie in ``order`` are ordered by content, so the same input
    always makes the same batches; other input under a known ``load`` raises a
    ValueError before anything is written (give it another name).  An empty input
    appends nothing.  The columns ``load, batch, batch_digest`` are the table's own."""
    spark = df.sparkSession
    clash = [c for c in df.columns if c in (*MARKS, "row_index", "_row", "_bad")]
    if clash:
        raise ValueError(f"columns of the table's own: {clash}")
    content = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))
    bad = F.coalesce(failed, F.lit(False)) if failed is not None else F.lit(False)
    rows = number_batches(df.withColumn("_row", content).withColumn("_bad", bad), [*order, "_row"], size).drop("row_index")
    # at most `size` short digests a batch
    digest = F.md5(F.array_join(F.sort_array(F.collect_list("_row")), ""))
    batches = rows.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"), F.max("_bad").alias("_bad"),
                                        digest.alias("batch_digest"))
    out = rows.drop("_row", "_bad").withColumn("load", F.lit(load)).withColumn("batch_digest", F.lit(None).cast("string"))
    there = out.limit(0)
    if path_exists(spark, path):
        there = spark.read.schema(out.schema).format(fmt).load(path)
    there = (there.filter(F.col("load") == load).groupBy("batch")
             .agg(F.count(F.lit(1)).alias("_n"), F.min("batch_digest").alias("_d"), F.max("batch_digest").alias("_d2")))
    # the report and the insert see the table as it was before the insert
    plan = cut_lineage(batches.join(there, "batch", "full"), "load-batches")
    known = F.col("_n").isNotNull()
    differs = known & ~(F.col("_d").eqNullSafe(F.col("batch_digest")) & (F.col("_d2") == F.col("_d"))
                        & F.col("rows").eqNullSafe(F.col("_n")))
    other = plan.filter(differs).select("batch").first()
    if other is not None:
        raise ValueError(f"load {load!r}: batch {other['batch']} of the table is not a batch of this input")
    todo = plan.filter(~known & ~F.col("_bad")).select("batch", "batch_digest")
    (out.drop("batch_digest").join(todo, "batch").select(*out.columns).repartition("batch")
     .write.mode("append").format(fmt).save(path))
    n = F.col("rows")
    return plan.select("batch", "rows", F.when(~known & ~F.col("_bad"), n).otherwise(0).cast("long").alias("ok"),
                       F.when(~known & F.col("_bad"), n).otherwise(0).cast("long").alias("failed"),
                       F.when(known, n).otherwise(0).cast("long").alias("present"))
