"""Overlapping token windows (T1-T5) as array expressions.

A body of ``n`` tokens is cut into windows of ``m`` tokens that advance by
``step`` tokens; the last window may be short and the cut stops once a window
reaches the end. The loop has a closed form, so the whole cut is one
``transform(sequence(...))`` in the JVM:

    step    = m - o        when m > o
            = m div 2      when m <= o and m > 1      (progress guard, T5)
            = 1            otherwise
    count   = 0 when n = 0; 1 when n <= m; ((n - m) + step - 1) div step + 1
    start_i = i * step;  n_tok_i = least(m, n - start_i)

A body that fits in one window is passed through verbatim (T3); longer
bodies are re-joined from their tokens with single spaces, which is what a
word tokenizer's decode gives. ``m`` and ``o`` may be literals or columns
(per-subscription settings).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings.functions.text import col_, words

# --- fixed values -----------------------------------------------------------
# Window size and overlap used by the digest run.
DEFAULT_MAX_TOKENS = 4000
DEFAULT_OVERLAP_RUN = 200
# ---------------------------------------------------------------------------

CHUNK_TYPE = ("array<struct<chunk_ix:int,start_tok:int,n_tok:int,"
              "chunk:string>>")


def _lit(x) -> Column:
    """A column, a column name, or an integer literal."""
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(int(x))


def chunk_step(m, o) -> Column:
    m, o = _lit(m), _lit(o)
    return (F.when(m > o, m - o)
            .when(m > 1, F.floor(m / 2).cast("int"))
            .otherwise(F.lit(1)))


def chunk_count(n, m, o) -> Column:
    n, m = _lit(n), _lit(m)
    step = chunk_step(m, o)
    return (F.when(n <= 0, F.lit(0))
            .when(n <= m, F.lit(1))
            .otherwise(F.floor((n - m + step - 1) / step).cast("int") + 1))


def settings_ok(m, o) -> Column:
    """Bad chunk settings (m < 1 or o < 0) are rejected, not cut."""
    m, o = _lit(m), _lit(o)
    return m.isNotNull() & o.isNotNull() & (m >= 1) & (o >= 0)


def chunks_from_tokens(text, tok, m, o) -> Column:
    """Array of ``struct(chunk_ix, start_tok, n_tok, chunk)``.

    ``tok`` should be a column already holding the token array, so the
    tokenizer runs once per row.
    """
    text, tok = col_(text), col_(tok)
    m, o = _lit(m), _lit(o)
    n = F.coalesce(F.size(tok), F.lit(0))
    step = chunk_step(m, o)
    cnt = chunk_count(n, m, o)

    def window(i):
        start = i * step
        ln = F.least(m, n - start)
        return F.struct(i.alias("chunk_ix"), start.alias("start_tok"),
                        ln.alias("n_tok"),
                        F.array_join(F.slice(tok, start + 1, ln),
                                     " ").alias("chunk"))

    one = F.array(F.struct(F.lit(0).alias("chunk_ix"),
                           F.lit(0).alias("start_tok"),
                           n.alias("n_tok"), text.alias("chunk")))
    many = F.transform(F.sequence(F.lit(0), cnt - 1), window)
    empty = F.array().cast(CHUNK_TYPE)
    return (F.when(~settings_ok(m, o), F.lit(None).cast(CHUNK_TYPE))
            .when(n == 0, empty)
            .when(n <= m, one)
            .otherwise(many)).cast(CHUNK_TYPE)


def chunk_text(df, text_col: str, m, o, tok_col: str = "tok",
               out_col: str = "chunks"):
    """Add ``tok`` (word tokens) and ``chunks`` columns to ``df``."""
    return (df.withColumn(tok_col, words(text_col))
              .withColumn(out_col, chunks_from_tokens(text_col, tok_col, m, o)))


def explode_chunks(df, keep: list[str], chunks_col: str = "chunks"):
    """One row per window, keeping only ``keep`` columns.

    ``inline_outer`` plus a NOT NULL filter, instead of ``inline``: the inner
    generator makes the optimizer infer ``size(chunks) > 0`` and push it
    below the projection, which would evaluate the tokenizer again.
    """
    cols = [F.col(c) for c in keep]
    return (df.select(*cols, F.inline_outer(F.col(chunks_col)))
              .where(F.col("chunk_ix").isNotNull()))
