"""Versioned table of embedded chunks (F9, J3, K3): changed text replaces, it never piles up.

The table is a log of events, only appended to: a row a chunk position and version,
either alive (with its text and vector) or closed.  The current rows are those whose
position's last event is alive.  A run (:func:`sync_embeddings`) compares its chunks
with the current rows by position, content hash and model: what is new or changed is
embedded and appended, what is gone is closed, what is the same costs nothing.  A
chunk whose embedding fails closes the text it replaces and is tried again next time.

A run is one append.  If it dies half way, the next run compares with what did get
there and appends the rest; readers see a position's old or new row, never both.
:func:`compact` writes the current rows as a new generation of the table; readers
take the last generation that was written whole.  Until a run appends to it, it is
marked as holding nothing else, and is read without looking for last events.

Texts and vectors move only where a position has more than one row; all else is
decided on positions, hashes and versions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.chunking import chunk_hash
from textmill.operators.embed import embed
from textmill.session import cut_lineage, path_exists

POSITION = ("document_id", "page_number", "chunk_index")
_GENERATION = "generation-"


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def generation(spark: SparkSession, path: str) -> str | None:
    """Folder of the last generation written whole; None before the first run."""
    p, fs = _files(spark, path)
    if not fs.exists(p):
        return None
    whole = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith(_GENERATION) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            whole.append(name)
    return f"{path.rstrip('/')}/{max(whole)}" if whole else None


def events(spark: SparkSession, path: str) -> DataFrame | None:
    folder = generation(spark, path)
    return None if folder is None else spark.read.parquet(folder)


def last_events(log: DataFrame, keys: tuple[str, ...] = POSITION) -> DataFrame:
    """The last event of every position (partial aggregates: a position with many
    versions costs one row a task)."""
    others = [c for c in log.columns if c not in keys]
    order = F.struct("version", "alive", "event")
    return (log.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_e"))
            .select(*keys, *[F.col("_e").getField(c).alias(c) for c in others]))


def _split_repeats(rows: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame | None]:
    """Rows that are alone in their position, and the others (None if there are none).
    Positions only are grouped; ``rows`` should be a written table."""
    several = cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys), "repeated")
    if several.isEmpty():
        return rows, None
    same = [rows[k].eqNullSafe(several[k]) for k in keys]
    return rows.join(several, same, "left_anti"), rows.join(several, same, "left_semi")


def live(log: DataFrame, keys: tuple[str, ...] = POSITION) -> DataFrame:
    """The rows of ``log`` that are their position's last event, and alive.  The newest
    version's rows stay where they are, older ones meet the events that still count."""
    rows = log.filter("alive")
    last = cut_lineage(last_events(log.select(*keys, "version", "alive", "event"), keys)
                       .filter("alive").select("event", "version"), "last-events")
    newest = last.agg(F.max("version")).first()[0]
    if newest is None:
        return rows.limit(0)
    here = F.col("version") == newest
    if rows.filter(here).count() != last.filter(here).count():  # two runs wrote this version
        return rows.join(last.select("event"), "event", "left_semi").select(*log.columns)
    older = rows.filter(F.col("version") < newest).join(last.filter(~here).select("event"), "event", "left_semi")
    return rows.filter(here).unionByName(older.select(*log.columns))


_COMPACTED = "_COMPACTED"  # in a generation's folder: nothing was appended since it was written


def current(spark: SparkSession, path: str, keys: tuple[str, ...] = POSITION) -> DataFrame | None:
    """The current chunks, without the columns of the log; None before the first run."""
    folder = generation(spark, path)
    if folder is None:
        return None
    log = spark.read.parquet(folder)  # lists the files: the mark counts if it is still there after that
    rows = log.filter("alive") if path_exists(spark, f"{folder}/{_COMPACTED}") else live(log, keys)
    return rows.drop("alive", "version", "event")


def sync_embeddings(chunks: DataFrame, path: str, text_col: str = "content", provider: str = "hashing",
                    model: str = "hashing-tf-64", prefix: str = "", normalize: bool = True,
                    keys: tuple[str, ...] = POSITION, scope: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Bring the table at ``path`` up to date with ``chunks``; returns (current rows,
    report: ``embedded, closed, rejected, unchanged``).

    ``chunks`` is the whole corpus, unless ``scope`` names a column (``document_id``):
    then positions are closed only within the scopes that occur in ``chunks``.  Of
    rows that share a position the one of the smallest content hash counts."""
    spark = chunks.sparkSession
    if "content_hash" not in chunks.columns:
        chunks = chunk_hash(chunks)
    others = [c for c in chunks.columns if c not in keys]
    chunks, several = _split_repeats(cut_lineage(chunks, "sync-chunks"), keys)
    if several is not None:
        one = several.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct("content_hash")).alias("_r"))
        one = one.select(*keys, *[F.col("_r").getField(c).alias(c) for c in others])
        chunks = cut_lineage(chunks.unionByName(one.select(*chunks.columns)), "sync-single")
    log = events(spark, path)
    now = None
    version = 1
    if log is not None:
        now = cut_lineage(last_events(log.select(*keys, "content_hash", "embedding_model", "version", "alive", "event"), keys), "sync-now")
        version = (now.agg(F.max("version")).first()[0] or 0) + 1
    same = None if now is None else now.filter("alive").filter(F.col("embedding_model") == model).select(*keys, "content_hash")
    todo, unchanged = chunks, 0
    if same is not None:
        kept = cut_lineage(chunks.select(*keys, "content_hash").join(same, [*keys, "content_hash"], "left_semi").select(*keys), "sync-same")
        unchanged = kept.count()
        if unchanged:
            todo = chunks.join(kept, list(keys), "left_anti")  # a position has one row
    ok, rejects = embed(todo, text_col, provider, model, prefix, normalize)
    mark = [F.lit(version).cast("long").alias("version"), F.expr("uuid()").alias("event")]
    out = ok.select("*", F.lit(True).alias("alive"), *mark)
    rejects = cut_lineage(rejects.select(*keys, "content_hash", "embedding_model"), "sync-rejects")
    shut = None
    if now is not None:
        gone = now.filter("alive").join(chunks.select(*keys), list(keys), "left_anti")
        if scope is not None:
            gone = gone.join(chunks.select(scope).distinct(), scope, "left_semi")
        failed = now.filter("alive").join(rejects.select(*keys), list(keys), "left_semi")
        shut = cut_lineage(gone.unionByName(failed).select(*keys, "content_hash", "embedding_model"), "sync-shut")
        out = out.unionByName(shut.select("*", F.lit(False).alias("alive"), *mark), allowMissingColumns=True)
    folder = generation(spark, path) or f"{path.rstrip('/')}/{_GENERATION}{1:06d}"
    mark_file, fs = _files(spark, f"{folder}/{_COMPACTED}")
    fs.delete(mark_file, False)  # before the first file is appended
    out.write.mode("append").parquet(folder)
    failed_rows = rejects.count()
    counts = {"embedded": chunks.count() - unchanged - failed_rows, "closed": 0 if shut is None else shut.count(),
              "rejected": failed_rows, "unchanged": unchanged}
    report = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} long" for k in counts))
    return current(spark, path, keys), report


def compact(spark: SparkSession, path: str, keys: tuple[str, ...] = POSITION) -> str:
    """Write the current rows as the next generation and drop the ones before.  A
    crash leaves the old generation in place, or both (then the new one counts)."""
    old = generation(spark, path)
    if old is None:
        raise FileNotFoundError(f"no table at {path}")
    rows = live(spark.read.parquet(old), keys)
    number = int(old.rsplit("-", 1)[1]) + 1
    new = f"{path.rstrip('/')}/{_GENERATION}{number:06d}"
    building = f"{path.rstrip('/')}/building-{uuid.uuid4().hex}"
    rows.write.parquet(building)
    mark_file, fs = _files(spark, f"{building}/{_COMPACTED}")
    fs.create(mark_file).close()
    p, fs = _files(spark, new)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(building), p):
        raise OSError(f"could not move {building} to {new}")
    root, _ = _files(spark, path)
    for s in fs.listStatus(root):
        name = s.getPath().getName()
        if name.startswith(_GENERATION) and name < f"{_GENERATION}{number:06d}":
            fs.delete(s.getPath(), True)
    return new
