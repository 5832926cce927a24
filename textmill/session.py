"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job needs for correct results (timestamps are naive wall clock,
# compared in UTC) and for a sane plan (AQE re-plans joins and skew at runtime).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows of whole texts: the default of 10,000 a batch is held by JVM and worker at once
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


def get_session(master: str | None = None, app: str = "textmill",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects.

    On a cluster, ``master`` stays None and the launcher decides; tests pass
    ``local[N]``.  The UI stays off: nothing here needs a web server.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    apply_conf(spark)
    return spark


PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``textmill`` importable in Python workers (pandas UDF steps).

    Workers take PYTHONPATH from the environment the driver wraps functions
    with; on a non-local master the package also goes out as a zip through
    ``addPyFile`` (once per context).
    """
    sc = spark.sparkContext
    env = sc.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])
    if id(sc) in _SHIPPED or (sc.master or "").startswith("local"):
        return
    import shutil
    base = tempfile.mkdtemp(prefix="textmill-pkg-")
    archive = shutil.make_archive(os.path.join(base, "textmill"), "zip", PACKAGE_ROOT, "textmill")
    sc.addPyFile(archive)
    _SHIPPED.add(id(sc))


def apply_conf(spark: SparkSession) -> None:
    """Set the session-level options on an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ship_package(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session leaves it unset (local tests) do we pick a fresh
    scratch folder of our own and register it.
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="textmill-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/textmill/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists (by the file system Spark itself uses)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def cut_lineage(df, name: str = "stage"):
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and continue from it.

    Reliable (survives executor loss, unlike a local checkpoint), and the
    re-read table carries statistics from its real file sizes: iterative
    loops whose joins would otherwise compound size estimates stay sane.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # the schema is known: no job to read footers


FULL_SPLIT = 128 << 20


def spread(df):
    """Deal rows over all cores where the input is smaller than one full split a
    core (such a scan may be a single row group, that is a single task); larger
    inputs already have a task a split and are returned as they are.

    The size is the planner's estimate; nothing is run."""
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * FULL_SPLIT else df


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
