"""Incremental poll (I1-I4): a stream run equals a batch run, and replays
add nothing."""

import os
import shutil
import tempfile

from pyspark.sql import functions as F

import tidings.plans  # noqa: F401  (registers every query)
from tidings.plans.digest import RunConfig
from tidings.plans.registry import QUERIES
from tidings.sources.run_store import RunStore
from tidings.streaming.poll import poll

CFG = RunConfig(sender="src", max_tokens=400, overlap=50)


def _outbox_ids(spark, out):
    return [r.msg_uid for r in RunStore(spark, out).table("outbox").select("msg_uid").collect()]


def test_poll_first_idle_overlap_replay(spark, sf_small):
    base = tempfile.mkdtemp(prefix="tidings-stream-")
    src, out = os.path.join(base, "src"), os.path.join(base, "out")
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    docs.where(F.col("doc_id") < 100).coalesce(1).write.parquet(os.path.join(src, "a"))
    ck1 = os.path.join(base, "ck1")
    poll(spark, os.path.join(src, "a"), out, ck1, CFG)
    first = _outbox_ids(spark, out)
    assert sorted(first) == list(range(100))
    # idle run: nothing new, nothing written
    poll(spark, os.path.join(src, "a"), out, ck1, CFG)
    assert sorted(_outbox_ids(spark, out)) == list(range(100))
    # a new file that overlaps the first: only the new ids are sent
    docs.where((F.col("doc_id") >= 50) & (F.col("doc_id") < 150)).coalesce(1) \
        .write.parquet(os.path.join(src, "b"))
    part = [f for f in os.listdir(os.path.join(src, "b")) if f.endswith(".parquet")][0]
    shutil.copy(os.path.join(src, "b", part), os.path.join(src, "a", "part-b.parquet"))
    poll(spark, os.path.join(src, "a"), out, ck1, CFG)
    ids = _outbox_ids(spark, out)
    assert len(ids) == len(set(ids)) == 150
    # replay everything from a fresh checkpoint: the ledger stops every resend
    poll(spark, os.path.join(src, "a"), out, os.path.join(base, "ck2"), CFG)
    ids = _outbox_ids(spark, out)
    assert len(ids) == len(set(ids)) == 150


def test_failed_messages_come_back_next_batch(spark, sf_small):
    base = tempfile.mkdtemp(prefix="tidings-retry-")
    src, out, ck = (os.path.join(base, x) for x in ("src", "out", "ck"))
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").withColumn(
        "text", F.when(F.col("doc_id") % 10 == 0, F.lit("   ")).otherwise(F.col("text")))
    docs.where(F.col("doc_id") < 50).coalesce(1).write.parquet(os.path.join(base, "a"))
    os.makedirs(src)
    for name, d in (("a", os.path.join(base, "a")),):
        part = [f for f in os.listdir(d) if f.endswith(".parquet")][0]
        shutil.copy(os.path.join(d, part), os.path.join(src, f"part-{name}.parquet"))
    poll(spark, src, out, ck, CFG)
    oc = RunStore(spark, out).table("outcomes")
    assert sorted(r.msg_uid for r in oc.where("status = 'no_body'").collect()) == \
        [0, 10, 20, 30, 40]
    docs.where((F.col("doc_id") >= 50) & (F.col("doc_id") < 60)).coalesce(1) \
        .write.parquet(os.path.join(base, "b"))
    part = [f for f in os.listdir(os.path.join(base, "b")) if f.endswith(".parquet")][0]
    shutil.copy(os.path.join(base, "b", part), os.path.join(src, "part-b.parquet"))
    poll(spark, src, out, ck, CFG)
    oc = RunStore(spark, out).table("outcomes")
    last = oc.where(F.col("run_id") == oc.agg(F.max("run_id")).first()[0])
    got = {r.msg_uid: r.status for r in last.collect()}
    # the failures of the first batch are tried again with the new file
    assert {0, 10, 20, 30, 40} <= set(got) and got[0] == "no_body"
    assert {r.msg_uid: r.attempts for r in last.collect()} == {u: 2 if u < 50 else 1 for u in got}
    assert {u for u, st in got.items() if st == "sent"} == set(range(51, 60))
    sent = _outbox_ids(spark, out)
    assert len(sent) == len(set(sent)) == 45 + 9


def test_idle_poll_tries_undelivered_messages_again(spark, sf_small):
    base = tempfile.mkdtemp(prefix="tidings-idle-")
    src, out, ck = (os.path.join(base, x) for x in ("src", "out", "ck"))
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    docs.where("doc_id < 20").coalesce(1).write.parquet(src)

    def down(requests):
        raise ConnectionError("down")

    def up(requests):
        return ["short" for _ in requests]
    poll(spark, src, out, ck, CFG, summarizer=down)
    assert _outbox_ids(spark, out) == []
    # still down: the pass fails again and leaves the messages pending
    poll(spark, src, out, ck, CFG, summarizer=down)
    assert _outbox_ids(spark, out) == []
    poll(spark, src, out, ck, CFG, summarizer=up)
    assert sorted(_outbox_ids(spark, out)) == list(range(20))
    # delivered: neither an idle pass nor the next batch sends them again
    poll(spark, src, out, ck, CFG, summarizer=up)
    docs.where("doc_id between 20 and 29").coalesce(1).write.mode("append").parquet(src)
    poll(spark, src, out, ck, CFG, summarizer=up)
    assert sorted(_outbox_ids(spark, out)) == list(range(30))


def _tables_in_parts(spark, folder):
    """``documents`` and ``labels`` as folders of part files, as large tables come."""
    docs = [(i, "src1" if i % 2 else "other", None if i == 5 else f"Title {i}\nA word. Two words.") for i in range(20)]
    spark.createDataFrame(docs, "doc_id bigint, source string, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i == 3), int(i in (7, 8))) for i in range(20)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").repartition(2).write.parquet(f"{folder}/labels.parquet")
    return folder


def test_incremental_poll_of_a_table_in_parts(spark, tmp_path):
    got = QUERIES["incremental_poll"](spark, _tables_in_parts(spark, str(tmp_path / "t"))).collect()
    assert sorted((r.msg_uid, r.status) for r in got) == [
        (i, "no_body" if i == 5 else "sent") for i in range(1, 20, 2) if i != 3]


def test_poll_attempts_of_a_table_in_parts(spark, tmp_path):
    got = QUERIES["poll_attempts"](spark, _tables_in_parts(spark, str(tmp_path / "t"))).collect()
    want = {i: ("sent", 1) for i in range(1, 20, 2) if i != 3} | {5: ("no_body", 2), 7: ("send_failed", 2)}
    assert {r.msg_uid: (r.status, r.attempts) for r in got} == want
