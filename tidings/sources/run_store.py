"""Tables of runs that become visible all at once, and the ledger over them.

A run writes each of its tables to a folder of its own attempt and then publishes one
manifest: a finished file that is renamed into ``runs/``. Readers go by manifests
alone, so they see all of a run's tables or none of them; what a killed attempt left
behind is never read. A published run is final: publishing it again is refused, and
``published`` tells a rerun that there is nothing left to do.

Layout below ``root``::

    <table>/run=<run>/attempt=<uuid>/    parquet of one attempt
    runs/epoch=<n>/<run>.json            manifests of the runs since epoch n began
    epochs/<n>.json                      the ledger's segments when epoch n began
    segments/<uuid>/bucket=<b>/          ledger rows of earlier epochs, one file a bucket

The ledger (ids marked read) is the segments and the ``ledger`` tables of the
current epoch's runs. After ``compact_every`` runs these become a segment, and a
segment up to ``FANOUT`` times as large before it is merged in, so that a row is rewritten
O(log n) times and there are O(log n) segments. A segment is hashed by
id into buckets of about ``ROWS_PER_BUCKET`` rows; a reader that says which ids it
is about reads their buckets only. One writer at a time works on a root, as a
scheduled poll does; readers need no lock.
"""

from __future__ import annotations

import json
import os
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BUCKET = 1_000_000
FANOUT = 4


class Files:
    """The few file operations of a store, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self.path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, pattern: str) -> list[str]:
        """Paths that match, in order; none where a folder is missing."""
        return sorted(s.getPath().toString() for s in self.fs.globStatus(self.path(pattern)) or [])

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            size = self.fs.getFileStatus(self.path(name)).getLen()
            return bytes(stream.readNBytes(size)).decode()
        finally:
            stream.close()

    def publish(self, name: str, content: str) -> None:
        """A new file that is there whole or not at all; an error if it is there already."""
        part = self.path(f"{os.path.dirname(name)}/.{uuid.uuid4().hex}.part")
        stream = self.fs.create(part, False)
        stream.write(content.encode())
        stream.close()
        if self.fs.exists(self.path(name)) or not self.fs.rename(part, self.path(name)):
            raise FileExistsError(name)


class Attempt:
    """One attempt at a run: tables written here show only once `publish` has returned."""

    def __init__(self, store: RunStore, run_id: str):
        self.store, self.run_id, self.id, self.tables = store, run_id, uuid.uuid4().hex, {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table of the run, with its ``run_id``, and read it back."""
        path = f"{self.store.root}/{name}/run={self.run_id}/attempt={self.id}"
        df.withColumn("run_id", F.lit(self.run_id)).write.parquet(path)
        self.tables[name] = path
        return self.store.spark.read.schema(df.schema).parquet(path)

    def publish(self) -> None:
        epoch, _ = self.store.epoch()
        content = json.dumps({"run": self.run_id, "tables": self.tables})
        self.store.files.publish(f"{self.store.root}/runs/epoch={epoch:08d}/{self.run_id}.json", content)


class RunStore:
    def __init__(self, spark: SparkSession, root: str, compact_every: int = 16):
        self.spark, self.root, self.compact_every = spark, root.rstrip("/"), compact_every
        self.files = Files(spark, root)

    def begin(self, run_id: str) -> Attempt:
        if not re.fullmatch(r"[\w.-]+", run_id):
            raise ValueError(f"run id {run_id!r} is not a file name")
        return Attempt(self, run_id)

    def published(self, run_id: str) -> bool:
        return bool(self.files.names(f"{self.root}/runs/epoch=*/{run_id}.json"))

    def attempted(self, name: str, run_id: str) -> list[str]:
        """Finished tables ``name`` of all attempts at a run, published or not."""
        return [os.path.dirname(p) for p in self.files.names(f"{self.root}/{name}/run={run_id}/attempt=*/_SUCCESS")]

    def manifests(self) -> DataFrame:
        """(run, tables) of all published runs; ``tables`` maps names to folders."""
        names = self.files.names(f"{self.root}/runs/epoch=*/*.json")
        schema = T.StructType.fromDDL("run string, tables map<string,string>")
        return self.spark.read.schema(schema).json(names) if names else self.spark.createDataFrame([], schema)

    def table(self, name: str, schema: T.StructType | None = None) -> DataFrame | None:
        """The rows of a table in all published runs; None without one."""
        return self._read([r[0] for r in self.manifests().select(F.col("tables")[name]).collect() if r[0]], schema)

    def _read(self, paths: list[str], schema: T.StructType | None = None) -> DataFrame | None:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*sorted(paths)) if paths else None

    # --- the ledger ---------------------------------------------------------

    def epoch(self) -> tuple[int, list[dict]]:
        """The current epoch's number and the segments it began with."""
        names = self.files.names(f"{self.root}/epochs/*.json")
        if not names:
            return 0, []
        return int(os.path.basename(names[-1])[:-5]), json.loads(self.files.read(names[-1]))

    def _recent(self) -> list[str]:
        """Manifests of the current epoch, ``compact_every`` at most."""
        return self.files.names(f"{self.root}/runs/epoch={self.epoch()[0]:08d}/*.json")

    def _deltas(self, manifests: list[str]) -> list[str]:
        """The ``ledger`` tables of some manifests."""
        every = [json.loads(self.files.read(m))["tables"] for m in manifests]
        return [t["ledger"] for t in every if "ledger" in t]

    def ledger(self, uid: T.DataType, about: DataFrame | None = None) -> DataFrame:
        """(msg_uid, run_id) marked read by published runs. With ``about`` (rows with a
        ``msg_uid``) segments are read only in the buckets of those ids."""
        schema = T.StructType([T.StructField("msg_uid", uid), T.StructField("run_id", T.StringType())])
        _, segments = self.epoch()
        most, wanted = max([s["buckets"] for s in segments], default=1), None
        if about is not None and most > 1:
            # at most one number a bucket; bucket counts are powers of two
            wanted = [r[0] for r in about.select(bucket_of(most)).distinct().collect()]
        out = self._read(self._deltas(self._recent()), schema)
        for s in segments:
            rows = self.spark.read.schema(_with_bucket(schema)).parquet(s["path"])
            if wanted is not None:
                rows = rows.where(F.col("bucket").isin(sorted({b % s["buckets"] for b in wanted})))
            rows = rows.drop("bucket")
            out = rows if out is None else out.unionByName(rows)
        return self.spark.createDataFrame([], schema) if out is None else out

    def compact_if_due(self) -> bool:
        """Begin a new epoch once this one has ``compact_every`` runs."""
        number, segments = self.epoch()
        recent = self._recent()
        if len(recent) < self.compact_every:
            return False
        rows = self._read(self._deltas(recent))
        if rows is not None:
            rows = rows.select("msg_uid", "run_id")
            n = rows.count()
            while segments and segments[-1]["rows"] <= FANOUT * n:
                last = segments.pop()
                rows = rows.unionByName(self.spark.read.parquet(last["path"]).drop("bucket"))
                n += last["rows"]
            buckets = 1 << max(0, -(-n // ROWS_PER_BUCKET) - 1).bit_length()
            path = f"{self.root}/segments/{uuid.uuid4().hex}"
            (rows.withColumn("bucket", bucket_of(buckets)).repartition(buckets, "bucket")
             .write.partitionBy("bucket").parquet(path))
            if n:
                segments.append({"path": path, "rows": n, "buckets": buckets})
        self.files.publish(f"{self.root}/epochs/{number + 1:08d}.json", json.dumps(segments))
        return True


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("msg_uid"), F.lit(buckets)).cast("int").alias("bucket")


def _with_bucket(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
