"""Incremental polling (I1-I4) with Structured Streaming.

A scheduled run takes whatever arrived since the last one: a file-source
``readStream`` with ``trigger(availableNow=True)`` processes the new files
and stops. Each micro-batch is one run of `tidings.plans.digest.commit_run` in
``foreachBatch``: its tables show together once its manifest is published in the
`RunStore` below ``out_dir``:

* ``outbox``, ``sends``: digests and what became of their delivery;
* ``outcomes``: one row per message and status, with ``attempts``, the runs that tried it;
* the ledger: ids whose delivery was confirmed;
* ``retry``: the messages that were not delivered, carried into the next
  batch (a checkpoint never re-reads a file, so failed mail would otherwise
  be lost to the stream; the reference leaves such mail unread). A poll that
  finds no new file runs them alone.

Replay safety: a run is named by the query id kept in the checkpoint (stable across
restarts of one checkpoint, new for a fresh one) and its batch number. A batch that is
replayed after its run was published does nothing; one whose run was not published
runs again, and nothing the dead attempt wrote is seen. A replay from a fresh checkpoint
sees the whole ledger and sends nothing twice.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from tidings.operators.body import PART_TYPE
from tidings.operators.deliver import to_outbox
from tidings.operators.state import sender_matches
from tidings.plans.digest import RunConfig, commit_run, run_digest
from tidings.session import is_file
from tidings.sources.run_store import RunStore

def documents_as_messages(df: DataFrame) -> DataFrame:
    """``documents`` rows as single-part plain-text messages."""
    part = F.struct(F.lit(0).alias("part_ix"), F.lit("text/plain").alias("content_type"),
                    F.lit(None).cast("string").alias("disposition"),
                    F.lit("utf-8").alias("charset"), F.col("text").alias("text"),
                    F.lit(True).alias("decode_ok"))
    return df.select(F.col("doc_id").alias("msg_uid"), F.col("source").alias("sender"),
                     F.substring_index("text", "\n", 1).alias("subject"),
                     F.lit(False).alias("is_multipart"),
                     F.array(part).cast(PART_TYPE).alias("parts"))


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The query id the checkpoint keeps (its ``metadata`` file)."""
    return json.loads(spark.read.text(os.path.join(checkpoint, "metadata")).first()[0])["id"]


def _last_run(store: RunStore, sid: str) -> dict | None:
    """The manifest of the stream's last published run, from the newest epoch that has one."""
    number, _ = store.epoch()
    for epoch in range(number, -1, -1):
        if names := store.files.names(f"{store.root}/runs/epoch={epoch:08d}/{sid}-*.json"):
            return json.loads(store.files.read(names[-1]))
    return None


def pending(store: RunStore, sid: str, schema: ST.StructType) -> DataFrame | None:
    """The messages that the stream's last run left undelivered, with their ``attempts`` so far."""
    last = _last_run(store, sid)
    if last is None:
        return None
    kept = ST.StructType([*schema.fields, ST.StructField("attempts", ST.IntegerType())])
    return store.spark.read.schema(kept).parquet(last["tables"]["retry"])


def _commit(store: RunStore, run_id: str, msgs: DataFrame, tried: DataFrame | None, cfg: RunConfig,
            initial_ledger: DataFrame | None, summarizer, deliver, plan) -> None:
    """One run over ``msgs``; ``tried`` counts the runs before (msg_uid, attempts)."""
    # other senders' messages are left where they are
    msgs = msgs.where(sender_matches("sender", cfg.sender)).dropDuplicates(["msg_uid"])
    ledger = store.ledger(msgs.schema["msg_uid"].dataType, msgs).select("msg_uid")
    if initial_ledger is not None:
        ledger = ledger.unionByName(initial_ledger.select("msg_uid"))

    def counted(messages, ledger, cfg, summarizer, **options):
        outbox, outcomes = plan(messages, ledger, cfg, summarizer, **options)
        if tried is None:
            return outbox, outcomes.withColumn("attempts", F.lit(1))
        before = F.coalesce(F.col("attempts"), F.lit(0))
        return outbox, outcomes.join(tried, "msg_uid", "left").withColumn("attempts", before + 1)
    commit_run(store, run_id, msgs, ledger, cfg, summarizer, deliver, counted, keep=msgs)


def make_batch_fn(out_dir: str, checkpoint: str, cfg: RunConfig,
                  initial_ledger: DataFrame | None, to_messages=documents_as_messages,
                  summarizer=None, deliver=to_outbox, plan=run_digest):
    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store, sid = RunStore(spark, out_dir), _stream_id(spark, checkpoint)
        run_id = f"{sid}-{batch_id:012d}"
        if store.published(run_id):
            return
        msgs, tried = to_messages(batch), None
        left = pending(store, sid, msgs.schema)
        if left is not None:
            # a message that arrives again is taken as it is now and keeps its count
            tried = left.select("msg_uid", "attempts")
            msgs = msgs.unionByName(left.drop("attempts").join(msgs.select("msg_uid"), "msg_uid", "left_anti"))
        _commit(store, run_id, msgs, tried, cfg, initial_ledger, summarizer, deliver, plan)
    return process


def retry_pending(spark: SparkSession, out_dir: str, checkpoint: str, cfg: RunConfig,
                  initial_ledger: DataFrame | None, schema: ST.StructType,
                  summarizer=None, deliver=to_outbox, plan=run_digest) -> None:
    """A run over the undelivered messages alone, for a poll without new files (I4).

    It is named after the stream's last run, so that runs sort in the order they took place;
    a pass that died is rewritten by the next one."""
    store, sid = RunStore(spark, out_dir), _stream_id(spark, checkpoint)
    last, left = _last_run(store, sid), pending(store, sid, schema)
    if last is None or left.isEmpty():
        return
    batch, _, passes = last["run"].partition(".retry")
    _commit(store, f"{batch}.retry{int(passes or 0) + 1:08d}", left.drop("attempts"), left.select("msg_uid", "attempts"),
            cfg, initial_ledger, summarizer, deliver, plan)


def parquet_files(source: str, glob: str = "*.parquet", max_files: int | None = None):
    """A source for `poll`: new parquet files below a folder, or a table that is one file."""
    def stream(spark: SparkSession) -> DataFrame:
        # Spark's file source watches folders: a file is the only match of its name in its folder
        folder, names = os.path.split(source) if is_file(spark, source) else (source, glob)
        schema = spark.read.option("pathGlobFilter", names).parquet(folder).schema
        reader = spark.readStream.format("parquet").schema(schema).option("pathGlobFilter", names)
        return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(folder)
    return stream


def poll(spark: SparkSession, source: str | Callable[[SparkSession], DataFrame], out_dir: str, checkpoint: str,
         cfg: RunConfig, glob: str = "*.parquet",
         initial_ledger: DataFrame | None = None, max_files: int | None = None,
         to_messages=documents_as_messages, summarizer=None, deliver=to_outbox, plan=run_digest) -> RunStore:
    """Process every file not yet seen by ``checkpoint``, then stop (I1/I2);
    without such a file, try the undelivered messages again (I4).

    ``source`` is a folder of parquet files, one such file, or gives a streaming DataFrame; ``to_messages``
    turns its rows into what ``plan`` runs on (`run_digest`, or `run_raw` for raw mail)."""
    stream = (parquet_files(source, glob, max_files) if isinstance(source, str) else source)(spark)
    process = make_batch_fn(out_dir, checkpoint, cfg, initial_ledger, to_messages, summarizer, deliver, plan)
    batches = []

    def counted(batch: DataFrame, batch_id: int) -> None:
        batches.append(batch_id)
        process(batch, batch_id)
    q = (stream.writeStream
         .foreachBatch(counted)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if not batches:
        messages = to_messages(spark.createDataFrame([], stream.schema)).schema
        retry_pending(spark, out_dir, checkpoint, cfg, initial_ledger, messages, summarizer, deliver, plan)
    return RunStore(spark, out_dir)
