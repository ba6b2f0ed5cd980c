"""Queries over sources, tokens and windows: S1/S2, T1-T5."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.functions.chunk import chunk_text, explode_chunks
from tidings.functions.text import WS_RUN, n_words
from tidings.operators.state import unread_from_sender
from tidings.plans.registry import query
from tidings.sources import tables as T

# --- fixed values -----------------------------------------------------------
# Query parameters. The sender is matched as a case-insensitive substring,
# as the mailbox search does, so 'SRC1' also takes src10..src19. Windows of
# 400 words with 50 overlap make the tables' longer bodies span several
# windows; the guard query uses m <= o.
SENDER = "SRC1"
WIN_M, WIN_O = 400, 50
GUARD_M, GUARD_O = 300, 400
# ---------------------------------------------------------------------------

# DuckDB forms of the shared expressions.
SQL_WORDS = f"list_filter(string_split_regex({{x}}, '{WS_RUN}'), lambda t: t <> '')"


def sql_words(x: str) -> str:
    return SQL_WORDS.replace("{x}", x)


@query("unread_from_sender", f"""
SELECT d.doc_id AS msg_uid, d.source AS sender, CAST(d.n_chars AS BIGINT) AS n_chars
FROM documents d
WHERE contains(lower(d.source), lower('{SENDER}'))
  AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.quality = 1 AND l.doc_id = d.doc_id)
""")
def q_unread_from_sender(spark, sf_dir):
    msgs = T.documents(spark, sf_dir).select(
        F.col("doc_id").alias("msg_uid"), F.col("source").alias("sender"),
        F.col("n_chars").cast("bigint").alias("n_chars"))
    return unread_from_sender(msgs, T.read_ledger(spark, sf_dir), SENDER)


@query("token_count", f"""
SELECT doc_id, CAST(coalesce(len({sql_words('text')}), 0) AS BIGINT) AS n_tokens
FROM documents
""")
def q_token_count(spark, sf_dir):
    return T.documents(spark, sf_dir).select(
        "doc_id", n_words("text").alias("n_tokens"))


@query("token_totals", f"""
SELECT source, CAST(count(*) AS BIGINT) AS n_docs,
       CAST(sum(n) AS BIGINT) AS total_tokens, CAST(max(n) AS BIGINT) AS max_tokens
FROM (SELECT source, coalesce(len({sql_words('text')}), 0) AS n FROM documents)
GROUP BY source
""")
def q_token_totals(spark, sf_dir):
    d = T.documents(spark, sf_dir).select("source", n_words("text").alias("n"))
    return d.groupBy("source").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"),
        F.sum("n").cast("bigint").alias("total_tokens"),
        F.max("n").cast("bigint").alias("max_tokens"))


def _sql_windows(m: int, o: int, src: str = "documents") -> str:
    step = f"CASE WHEN {m} > {o} THEN {m} - {o} WHEN {m} > 1 THEN {m} // 2 ELSE 1 END"
    return f"""
WITH t AS (
  SELECT doc_id, text, {sql_words('text')} AS tok FROM {src}),
n AS (SELECT doc_id, text, tok, coalesce(len(tok), 0) AS n, {step} AS step FROM t),
c AS (SELECT *, CASE WHEN n = 0 THEN 0 WHEN n <= {m} THEN 1
                     ELSE (n - {m} + step - 1) // step + 1 END AS cnt FROM n),
w AS (SELECT doc_id, text, tok, n, step, unnest(range(cnt)) AS i FROM c)
SELECT doc_id, CAST(i AS BIGINT) AS chunk_ix, CAST(i * step AS BIGINT) AS start_tok,
       CAST(least({m}, n - i * step) AS BIGINT) AS n_tok,
       CASE WHEN n <= {m} THEN text
            ELSE array_to_string(tok[i * step + 1 : i * step + least({m}, n - i * step)], ' ')
       END AS chunk
FROM w
"""


def _windows(spark, sf_dir, m, o):
    d = chunk_text(T.documents(spark, sf_dir).select("doc_id", "text"),
                   "text", m, o)
    return explode_chunks(d, ["doc_id"]).select(
        "doc_id", F.col("chunk_ix").cast("bigint").alias("chunk_ix"),
        F.col("start_tok").cast("bigint").alias("start_tok"),
        F.col("n_tok").cast("bigint").alias("n_tok"), "chunk")


@query("chunk_windows", _sql_windows(WIN_M, WIN_O))
def q_chunk_windows(spark, sf_dir):
    return _windows(spark, sf_dir, WIN_M, WIN_O)


@query("chunk_guard", _sql_windows(GUARD_M, GUARD_O))
def q_chunk_guard(spark, sf_dir):
    return _windows(spark, sf_dir, GUARD_M, GUARD_O)
