"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins and coalesces
# partitions at runtime and splits skewed join partitions; Arrow carries the
# few Python stages (MIME parsing, plug-in summarizers) in batches.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "tidings",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the defaults above.

    On a cluster the master and memory come from ``spark-submit``; only
    local runs (tests, bench) pass ``master``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names a folder every executor can reach; we only read it. Where
    it is unset we use a folder in the warehouse, which executors share too,
    and set it."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), *parts)


def co_partition_by(df, key: str):
    """Hash-partition ``df`` by ``key`` (a document id) once, so that the
    aggregations and windows keyed by ``key`` plus something else (term,
    sentence, window) reuse this partitioning instead of shuffling term
    occurrences again. A document is one row, so this cannot put more than
    one document's rows under a hot key.

    Joins keep Spark's default of co-partitioning on all their keys
    (``spark.sql.requireAllClusterKeysForCoPartition``): relaxing it lets a
    (doc, term) join reuse a partitioning by ``term`` alone, which puts every
    occurrence of a frequent term into one task."""
    return df.repartition(key)


def deal_by_key(df, key: str):
    """``df`` dealt to ``spark.sql.shuffle.partitions`` tasks by ``key``. Projections above run
    in all of them, and `materialize_by_key` writes a bucket from each without another shuffle."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def materialize_by_key(df, key: str, name: str):
    """Write ``df``, which `deal_by_key` has dealt by ``key``, once as a table bucketed by it
    under the shared checkpoint folder and read it back.

    Like ``checkpoint()`` it cuts the lineage (a lost executor re-reads the
    files), and unlike it the read keeps a known hash partitioning by
    ``key``, so aggregations, windows and joins keyed by ``key`` downstream
    need no shuffle. Tasks and buckets are hashed alike, so
    there is at most one file for each bucket. The table leaves the catalog at
    once: the returned DataFrame holds its files, which follow the checkpoint
    folder's retention."""
    import uuid
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.bucketBy(n, key).mode("overwrite")
       .option("path", scratch_path(spark, "tables", table)).saveAsTable(table))
    staged = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return staged


def written(df):
    """``df`` written once to the shared checkpoint folder and read back, for narrow rows that
    several steps read or filter: a filter on a computed column would otherwise be pushed below
    its projections and compute them again."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a file: a table may also be a folder of part files."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isFile()


# Bytes of an Arrow batch that become Python objects at a time.
SLICE_BYTES = 4 << 20


def slices(batch, most: int = SLICE_BYTES):
    """``batch`` in slices of at most ``most`` bytes (or one row), in order. Spark's batches hold up to
    64 MB; what a step makes of them, objects and results, is several times that if made at once."""
    if batch.num_rows > 1 and batch.nbytes > most:
        half = batch.num_rows // 2
        yield from slices(batch.slice(0, half), most)
        yield from slices(batch.slice(half), most)
    else:
        yield batch


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidings`` importable in the Python workers, once per application.

    The Arrow-batched steps (MIME parsing, plug-in summarizers and
    tokenizers) are pickled by reference to their module, so a worker must
    be able to import the package. The package's sources are zipped on the
    driver and added with ``SparkContext.addPyFile``, which Spark ships to
    every executor (on a cluster as well as in local mode)."""
    import zipfile

    import tidings
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(tidings.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidings-pkg-"), "tidings.zip")
    with zipfile.ZipFile(path, "w") as z:
        for base, _, files in os.walk(root):
            for fn in files:
                if fn.endswith(".py"):
                    full = os.path.join(base, fn)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
