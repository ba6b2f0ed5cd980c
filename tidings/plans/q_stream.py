"""The incremental poll as a query."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tidings.plans.digest import raw_statuses, run_raw
from tidings.plans.q_digest import CFG, SQL_STAGE
from tidings.plans.q_mail import sql_strip
from tidings.plans.q_text import SENDER
from tidings.plans.registry import query
from tidings.session import scratch_path
from tidings.sources import tables as T
from tidings.sources.mail_files import mbox_files, mbox_messages, mbox_records, write_mbox
from tidings.sources.mailbox import raw_mails
from tidings.streaming.poll import poll


@query("incremental_poll", f"""
SELECT d.doc_id AS msg_uid,
       CASE WHEN coalesce({sql_strip('d.text')}, '') = '' THEN 'no_body' ELSE 'sent' END AS status
FROM documents d
WHERE contains(lower(d.source), lower('{SENDER}'))
  AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.quality = 1 AND l.doc_id = d.doc_id)
""")
def q_incremental_poll(spark, sf_dir):
    """Stream the documents, a file or a folder of part files, through the digest run
    (availableNow), in a fresh folder under the shared checkpoint folder; the outcomes
    equal the batch run's."""
    base = scratch_path(spark, "poll", uuid.uuid4().hex)
    store = poll(spark, T.path(sf_dir, "documents"), os.path.join(base, "out"), os.path.join(base, "checkpoint"), CFG,
                 glob="*", initial_ledger=T.read_ledger(spark, sf_dir))
    return store.table("outcomes").select("msg_uid", "status")


SQL_FILES = f"""{SQL_STAGE}
SELECT msg_uid, sender, status, n_chars, n_tokens, n_chunks FROM oc
"""


def _mail_folder(spark, sf_dir):
    """The derived mailbox as mbox files, in a fresh folder under the shared checkpoint folder."""
    path = scratch_path(spark, "mbox", uuid.uuid4().hex)
    write_mbox(raw_mails(spark, sf_dir), path)
    return path


def _id(name: str = "msg_uid"):
    return F.col(name).cast("bigint").alias("msg_uid")


def _ledger(spark, sf_dir):
    return T.read_ledger(spark, sf_dir).select(F.col("msg_uid").cast("string").alias("msg_uid"))


@query("mail_files_outcomes", SQL_FILES)
def q_mail_files_outcomes(spark, sf_dir):
    """The outcomes of a run on a folder of mbox files, broken fetches with them."""
    oc = raw_statuses(mbox_files(spark, _mail_folder(spark, sf_dir), glob="*.txt"), _ledger(spark, sf_dir), CFG)
    return oc.select(_id(), "sender", "status", "n_chars", "n_tokens", "n_chunks")


@query("mail_files_poll", SQL_FILES)
def q_mail_files_poll(spark, sf_dir):
    """The same folder polled: the stream's outcomes equal the batch run's."""
    folder, base = _mail_folder(spark, sf_dir), scratch_path(spark, "poll", uuid.uuid4().hex)
    store = poll(spark, lambda s: mbox_records(s, folder, stream=True, glob="*.txt"), os.path.join(base, "out"),
                 os.path.join(base, "checkpoint"), CFG, initial_ledger=_ledger(spark, sf_dir),
                 to_messages=mbox_messages, plan=run_raw)
    return store.table("outcomes").select(_id(), "sender", "status", "n_chars", "n_tokens", "n_chunks")


# Deliveries of the query below: in the first poll a message labelled toxic is refused, and those with an odd id again
# in the second, which has no new file and so tries the undelivered messages alone.
@query("poll_attempts", f"""
WITH m AS (SELECT d.doc_id AS msg_uid, coalesce({sql_strip('d.text')}, '') <> '' AS body,
             EXISTS (SELECT 1 FROM labels l WHERE l.toxic = 1 AND l.doc_id = d.doc_id) AS refused
           FROM documents d
           WHERE contains(lower(d.source), lower('{SENDER}'))
             AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.quality = 1 AND l.doc_id = d.doc_id))
SELECT msg_uid, CASE WHEN NOT body THEN 'no_body' WHEN refused AND msg_uid % 2 = 1 THEN 'send_failed' ELSE 'sent' END AS status,
       CAST(CASE WHEN body AND NOT refused THEN 1 ELSE 2 END AS INTEGER) AS attempts FROM m
""")
def q_poll_attempts(spark, sf_dir):
    """Two polls whose deliveries are refused in part: each message's last outcome and how many runs tried it."""
    base = scratch_path(spark, "poll", uuid.uuid4().hex)
    toxic = T.table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("msg_uid")).distinct()

    def refusing(which):
        def deliver(outbox):
            no = toxic.where(which).withColumn("refused", F.lit(True))
            return outbox.select("msg_uid").join(no, "msg_uid", "left").select(
                "msg_uid", F.col("refused").isNull().alias("delivered"), F.lit(None).cast("string").alias("send_error"))
        return deliver

    for which in ("true", "msg_uid % 2 = 1"):
        store = poll(spark, T.path(sf_dir, "documents"), os.path.join(base, "out"), os.path.join(base, "checkpoint"), CFG,
                     glob="*", initial_ledger=T.read_ledger(spark, sf_dir), deliver=refusing(which))
    return (store.table("outcomes").groupBy("msg_uid")
            .agg(F.max_by("status", "attempts").alias("status"), F.max("attempts").alias("attempts")))
