"""Run outcomes (O1-O4): one row per message, first matching status wins.

Every stage leaves columns behind instead of raising, so one bad message
never fails the job (O4); the status is a ``CASE`` over those columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions.text import col_

# --- fixed values -----------------------------------------------------------
# Statuses in the order they are tested.
STATUSES = ("fetch_failed", "no_body", "tokenizer_error", "no_chunks",
            "api_error", "llm_error", "empty_summary", "send_failed",
            "send_error", "unexpected_error", "sent")
# Summarizer error kinds counted as api_error; any other kind is llm_error.
API_ERROR_KINDS = ("connection", "rate_limit", "authentication",
                   "bad_request", "api")
# ---------------------------------------------------------------------------


def classify(fetch_ok, body, chunks, error_kind, summary,
             delivered=None, send_error=None) -> Column:
    """O1: exhaustive, exclusive status per message.

    * ``fetch_ok`` False: the raw mail was missing or unparsable;
    * ``body`` empty: no usable text part;
    * ``chunks`` NULL: the window settings or tokenizer failed;
    * ``chunks`` empty: no tokens;
    * ``error_kind`` set: the summarizer failed for this message;
    * ``summary`` empty: nothing to send;
    * ``delivered`` False / ``send_error`` set: the outbox write failed.
    """
    dl = F.lit(True) if delivered is None else F.coalesce(col_(delivered), F.lit(False))
    se = F.lit(None).cast("string") if send_error is None else col_(send_error)
    ek = col_(error_kind)
    return (F.when(~F.coalesce(col_(fetch_ok), F.lit(False)), F.lit("fetch_failed"))
            .when(F.coalesce(col_(body), F.lit("")) == "", F.lit("no_body"))
            .when(col_(chunks).isNull(), F.lit("tokenizer_error"))
            .when(F.size(col_(chunks)) == 0, F.lit("no_chunks"))
            .when(ek.isin(*API_ERROR_KINDS), F.lit("api_error"))
            .when(ek.isNotNull(), F.lit("llm_error"))
            .when(F.coalesce(col_(summary), F.lit("")) == "", F.lit("empty_summary"))
            .when(se.isNotNull(), F.lit("send_error"))
            .when(~dl, F.lit("send_failed"))
            .otherwise(F.lit("sent")))


def confirm_sends(outcomes: DataFrame, deliveries: DataFrame, uid: str = "msg_uid") -> DataFrame:
    """Outcomes after sending. ``deliveries`` has, for each message that was handed
    over, ``uid``, ``delivered`` and ``send_error`` (one row each; of several, any
    delivery counts). A digest is ``sent`` only if its delivery is confirmed;
    else it is ``send_error`` with an error and ``send_failed`` without one,
    and its message stays unread. Other statuses stand."""
    said = deliveries.groupBy(uid).agg(
        F.coalesce(F.max("delivered"), F.lit(False)).alias("_delivered"),
        F.max("send_error").alias("_send_error"))
    done = (F.when((F.col("status") != "sent") | F.col("_delivered"), F.col("status"))
            .when(F.col("_send_error").isNotNull(), F.lit("send_error"))
            .otherwise(F.lit("send_failed")))
    return (outcomes.join(said, uid, "left").withColumn("status", done)
            .drop("_delivered", "_send_error"))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """O2: messages per status."""
    return outcomes.groupBy("status").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_messages"))


# Percentiles are exact in groups of up to this many rows, and within 1/ACCURACY of the rank beyond.
ACCURACY = 100_000


def percentiles(value: str, name: str, accuracy: int = ACCURACY) -> list[Column]:
    """Median and 95th percentile (values that occur) by a quantile sketch: partial sketches
    are merged, so no task keeps a group's values."""
    return [F.percentile_approx(value, q, accuracy).cast("bigint").alias(f"p{round(100 * q)}_{name}") for q in (0.5, 0.95)]


def size_stats(outcomes: DataFrame, by: str = "sender") -> DataFrame:
    """O3: size measures per sender. All are mergeable partial aggregates,
    so a sender with a third of all messages is combined map-side."""
    return outcomes.groupBy(by).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_messages"),
        F.min("n_chars").cast("bigint").alias("min_chars"),
        F.max("n_chars").cast("bigint").alias("max_chars"),
        F.sum("n_chars").cast("bigint").alias("sum_chars"),
        F.round(F.avg("n_chars"), 3).alias("avg_chars"),
        F.sum("n_chunks").cast("bigint").alias("sum_chunks"),
        F.max("n_tokens").cast("bigint").alias("max_tokens"),
        *percentiles("n_chars", "chars"), *percentiles("n_tokens", "tokens"), *percentiles("n_chunks", "chunks"))


def summary_stats(outcomes: DataFrame, by: str = "sender") -> DataFrame:
    """O3: lengths of the summaries that were made, per sender; ``outcomes`` has ``summary_chars``.

    Outcomes without a summary count as null, not by a filter on the rows: that would be pushed
    below the projections with the summary written out in it, and make every summary again."""
    made = outcomes.select(by, F.nullif("summary_chars", F.lit(0)).alias("summary_chars"))
    return made.groupBy(by).agg(
        F.count("summary_chars").cast("bigint").alias("n_summaries"),
        F.min("summary_chars").cast("bigint").alias("min_chars"),
        F.max("summary_chars").cast("bigint").alias("max_chars"),
        F.round(F.avg("summary_chars"), 3).alias("avg_chars"),
        *percentiles("summary_chars", "chars")).where("n_summaries > 0")
