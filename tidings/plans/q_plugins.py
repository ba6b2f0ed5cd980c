"""Queries over the plug-in paths: tokenizer windows (T1-T6) and the
many-subscription sender match."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.operators.subscriptions import match_subscriptions
from tidings.operators.tokenize import get_tokenizer, tokenizer_windows
from tidings.plans.q_text import WIN_M, WIN_O, _sql_windows
from tidings.plans.registry import query
from tidings.sources import tables as T

# --- fixed values -----------------------------------------------------------
# Subscriptions of the match query: (subscription, sender pattern). The empty
# pattern matches every sender, as an empty mailbox search does.
SUBSCRIPTIONS = [("s-src1", "SRC1"), ("s-src2", "src2"), ("s-c1", "c1"),
                 ("s-rc19", "rc19"), ("s-all", ""), ("s-none", "zz")]
# ---------------------------------------------------------------------------


@query("tokenizer_windows", _sql_windows(WIN_M, WIN_O))
def q_tokenizer_windows(spark, sf_dir):
    """The plug-in tokenizer path with the word tokenizer: the same windows
    as the built-in JVM path, cut in Arrow batches."""
    d = T.documents(spark, sf_dir).select("doc_id", "text")
    w = tokenizer_windows(d, "doc_id", "text", WIN_M, WIN_O, get_tokenizer("words"))
    return w.select("doc_id", F.inline("chunks")).select(
        "doc_id", F.col("chunk_ix").cast("bigint").alias("chunk_ix"),
        F.col("start_tok").cast("bigint").alias("start_tok"),
        F.col("n_tok").cast("bigint").alias("n_tok"), "chunk")


_VALUES = ", ".join(f"('{s}', '{p}')" for s, p in SUBSCRIPTIONS)


@query("subscription_match", f"""
WITH subs(subscription, sender_pattern) AS (VALUES {_VALUES})
SELECT d.doc_id AS msg_uid, d.source AS sender, s.subscription
FROM documents d JOIN subs s ON contains(lower(d.source), lower(s.sender_pattern))
""")
def q_subscription_match(spark, sf_dir):
    msgs = T.documents(spark, sf_dir).select(
        F.col("doc_id").alias("msg_uid"), F.col("source").alias("sender"))
    subs = spark.createDataFrame(SUBSCRIPTIONS, "subscription string, sender_pattern string")
    return match_subscriptions(msgs, subs).select("msg_uid", "sender", "subscription")
