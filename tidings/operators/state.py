"""Unread filter and read state.

The mailbox's read flag becomes a ledger of ids (kept by
``tidings.sources.run_store``). Unread means "no ledger row",
a ``left_anti`` join that Catalyst plans as a broadcast hash join when the
ledger's measured size is under the broadcast threshold and as a sort-merge
join otherwise; nothing here forces a broadcast, since the ledger grows with
every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions.text import col_


def sender_matches(sender, pattern: str | Column) -> Column:
    """IMAP ``FROM "x"``: a case-insensitive substring match, not equality."""
    p = pattern if isinstance(pattern, Column) else F.lit(pattern)
    return F.contains(F.lower(col_(sender)), F.lower(p))


def unread(messages: DataFrame, ledger: DataFrame,
           uid: str = "msg_uid") -> DataFrame:
    """Messages with no row in the ledger."""
    return messages.join(ledger.select(uid), on=uid, how="left_anti")


def unread_from_sender(messages: DataFrame, ledger: DataFrame, sender: str,
                       sender_col: str = "sender",
                       uid: str = "msg_uid") -> DataFrame:
    """Unread messages from one sender. The filter runs before the
    join, so only matching rows reach the shuffle."""
    return unread(messages.where(sender_matches(sender_col, sender)),
                  ledger, uid)


def delivered_ids(outcomes: DataFrame, uid: str = "msg_uid") -> DataFrame:
    """K2: ids whose digest was delivered."""
    return outcomes.where(F.col("status") == "sent").select(uid)


def ledger_after_run(ledger: DataFrame, outcomes: DataFrame, run_id: str,
                     uid: str = "msg_uid") -> DataFrame:
    """K3/K4: the ledger after one run: old rows plus newly delivered ids.

    Only delivered messages are marked; every other outcome leaves the
    message unread, so the next run finds it again (at-least-once).
    Ids already in the ledger are not added twice.
    """
    old = ledger.select(uid, F.lit("previous").alias("marked_by"))
    new = (delivered_ids(outcomes, uid)
           .join(ledger.select(uid), on=uid, how="left_anti")
           .select(uid, F.lit(run_id).alias("marked_by")))
    return old.unionByName(new)
