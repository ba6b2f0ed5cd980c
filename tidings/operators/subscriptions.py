"""Many subscriptions in one run: which messages each sender pattern takes.

A subscription names its sender as a pattern, matched like the mailbox
search: case-insensitive substring. ``contains(sender, pattern)`` as a join
condition would be a nested-loop (cross) join. Instead:

1. take the distinct lower-cased senders (far fewer than messages);
2. cut each into its substrings of the pattern lengths in use (the set of
   lengths is bounded by the longest address, so it is collected);
3. equi-join those substrings with the lower-cased patterns;
4. equi-join the (sender, subscription) pairs back to the messages.

Step 4 is keyed by sender; a sender holding a third of all messages is a hot
key, which AQE's skew-join handling splits (the pairs side per sender is a
handful of rows). The result is exact: every (message, subscription) pair
with ``contains(lower(sender), lower(pattern))``, each once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cut(ln: int):
    """Substring of length ``ln`` at a 1-based position (a one-argument
    lambda: ``transform`` reads a second argument as the element index)."""
    return lambda i: F.substr(F.col("_s"), i, F.lit(ln))


def match_subscriptions(messages: DataFrame, subs: DataFrame,
                        sender: str = "sender", pattern: str = "sender_pattern",
                        key: str = "subscription") -> DataFrame:
    """``messages`` with a ``key`` column, one row per matching subscription."""
    pats = subs.select(key, F.lower(F.col(pattern)).alias("_p")).where(F.col("_p").isNotNull())
    lengths = sorted(r[0] for r in pats.select(F.length("_p")).distinct().collect())
    senders = messages.select(F.lower(F.col(sender)).alias("_s")).where(
        F.col("_s").isNotNull()).distinct()
    cuts = []
    for ln in lengths:
        if ln == 0:
            cuts.append(F.array(F.lit("")))
        else:
            # senders shorter than the pattern have no cut of that length
            # (``sequence(1, 0)`` would count down, so it is guarded)
            cuts.append(F.when(F.length("_s") >= ln, F.transform(
                F.sequence(F.lit(1), F.length("_s") - ln + 1), _cut(ln)))
                .otherwise(F.array().cast("array<string>")))
    if not cuts:
        return messages.withColumn(key, F.lit(None).cast(subs.schema[key].dataType)).limit(0)
    subs_of = (senders.select("_s", F.explode(F.array_distinct(F.flatten(F.array(*cuts))))
                              .alias("_p")))
    pairs = subs_of.join(pats, "_p").select("_s", key).distinct()
    return (messages.withColumn("_s", F.lower(F.col(sender)))
            .join(pairs, "_s").drop("_s"))
