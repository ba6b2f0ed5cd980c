"""The ordered summary fold (M3-M8) and the running context.

Fold rule: ``ctx_0 = initial``; ``r_i = strip(reply_i)``; ``ctx_{i+1} = r_i``
when ``r_i`` is non-empty, else ``ctx_i``; the result is ``ctx_k``. So the
result is the last non-empty reply, and the context a window sees is the
last non-empty reply before it. Three forms:

* ``fold_last_nonempty``: replies as rows, one group per document; a
  ``max`` over ``struct(order, reply)`` with map-side partial aggregation,
  so a hot document is combined before the shuffle;
* ``running_context``: the context before every row, as a blocked prefix
  scan (window inside fixed-size blocks of the order key + a carry from the
  blocks before), so one huge group is spread over many tasks;
* ``fold_array``: replies as an array column, ``aggregate`` in the JVM.

``model_fold`` runs a plug-in summarizer window by window: the round-batched
fold, see there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.functions.text import col_, py_strip

# --- fixed values -----------------------------------------------------------
BLOCK_ROWS = 1024
# ---------------------------------------------------------------------------


def reply_value(text, keep: Column | None = None) -> Column:
    """A reply's contribution: stripped text, NULL when blank or not kept."""
    s = py_strip(col_(text))
    ok = s != F.lit("")
    if keep is not None:
        ok = ok & keep
    return F.when(ok, s)


def fold_last_nonempty(df: DataFrame, key: str, order: str, value: Column,
                       initial: str = "", out: str = "summary") -> DataFrame:
    """(key, out, n_replies): the fold result per group.

    ``value`` is NULL for rows that are not replies or are blank."""
    best = F.max(F.when(value.isNotNull(), F.struct(F.col(order).alias("o"),
                                                    value.alias("v"))))
    return df.groupBy(key).agg(
        F.coalesce(best["v"], F.lit(initial)).alias(out),
        F.count(value).cast("bigint").alias("n_replies"))


def running_context(df: DataFrame, key: str, order: str, value: Column,
                    out: str = "context", initial: str = "",
                    block: int = BLOCK_ROWS) -> DataFrame:
    """Add ``out``: the last non-NULL ``value`` strictly before each row of
    its ``key`` group in ``order`` (an integer), else ``initial``.

    1. rows are cut into blocks ``order div block``; a window per
       (key, block) gives the last value before the row inside its block;
    2. each (key, block) keeps its own last value (partial aggregation);
    3. a window over the block table (``block`` times fewer rows) carries
       the last value of all earlier blocks;
    4. the carry joins back on (key, block).
    """
    blk = F.floor(F.col(order) / F.lit(block))
    d = df.withColumn("_v", value).withColumn("_blk", blk)
    inner = Window.partitionBy(key, "_blk").orderBy(order) \
                  .rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_inner", F.last("_v", ignorenulls=True).over(inner))
    last_in_block = (d.groupBy(key, "_blk").agg(F.max(F.when(
        F.col("_v").isNotNull(), F.struct(F.col(order).alias("o"),
                                          F.col("_v").alias("v"))))["v"]
        .alias("_blast")))
    before = Window.partitionBy(key).orderBy("_blk") \
                   .rowsBetween(Window.unboundedPreceding, -1)
    carry = last_in_block.select(
        key, "_blk", F.last("_blast", ignorenulls=True).over(before).alias("_carry"))
    return (d.join(carry, on=[key, "_blk"], how="left")
             .withColumn(out, F.coalesce("_inner", "_carry", F.lit(initial)))
             .drop("_v", "_blk", "_inner", "_carry"))


def fold_array(replies, initial: str | Column = "") -> Column:
    """Fold an array of replies in order (M3-M5). A NULL reply is an error
    (M6), reported by ``fold_array_error``."""
    init = initial if isinstance(initial, Column) else F.lit(initial)
    return F.aggregate(col_(replies), init, lambda acc, r: F.when(
        F.coalesce(py_strip(r), F.lit("")) == F.lit(""), acc)
        .otherwise(py_strip(r)))


def fold_array_error(replies) -> Column:
    """True when any reply is NULL (the fold fails for that document)."""
    return F.exists(col_(replies), lambda r: r.isNull())
