"""Queries over the fold, the prompt and the extractive sections:
M1, M3-M5, M8, X1-X6."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.functions.chunk import chunk_text
from tidings.functions.text import SENTENCE_RE, TERM_MIN_LEN, TERM_SPLIT_RE
from tidings.operators import extractive as X
from tidings.operators.fold import fold_last_nonempty, reply_value, running_context
from tidings.operators.prompt import DEFAULT_FOCUS, prompt_text, sql_prompt
from tidings.plans.q_mail import sql_strip
from tidings.plans.q_text import WIN_M, WIN_O, _sql_windows
from tidings.plans.registry import query
from tidings.session import co_partition_by
from tidings.sources import tables as T

SQL_REPLY = f"CASE WHEN role = 'assistant' AND {sql_strip('text')} <> '' THEN {sql_strip('text')} END"
SQL_CONTEXT = f"""coalesce(last_value({SQL_REPLY} IGNORE NULLS) OVER (
    PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')"""


def _replies(spark, sf_dir):
    c = T.conversations(spark, sf_dir)
    return c, reply_value("text", F.col("role") == "assistant")


@query("running_context", f"""
SELECT conv_id, turn, role, {SQL_CONTEXT} AS context FROM conversations
""")
def q_running_context(spark, sf_dir):
    c, v = _replies(spark, sf_dir)
    return running_context(c, "conv_id", "turn", v).select(
        "conv_id", "turn", "role", "context")


@query("fold_last_nonempty", f"""
WITH f AS (
  SELECT conv_id,
         coalesce(arg_max({SQL_REPLY}, turn) FILTER (WHERE ({SQL_REPLY}) IS NOT NULL), '') AS summary,
         CAST(count({SQL_REPLY}) AS BIGINT) AS n_replies
  FROM conversations GROUP BY conv_id)
SELECT conv_id, summary, n_replies,
       CASE WHEN summary = '' THEN 'empty_summary' ELSE 'ok' END AS status
FROM f
""")
def q_fold_last_nonempty(spark, sf_dir):
    c, v = _replies(spark, sf_dir)
    f = fold_last_nonempty(c, "conv_id", "turn", v)
    return f.select("conv_id", "summary", "n_replies",
                    F.when(F.col("summary") == "", F.lit("empty_summary"))
                     .otherwise(F.lit("ok")).alias("status"))


@query("prompt_build", f"""
WITH r AS (SELECT conv_id, turn, role, text, {SQL_CONTEXT} AS context FROM conversations),
p AS (SELECT conv_id, turn, {sql_prompt("''", 'context', 'text')} AS prompt FROM r WHERE role = 'user')
SELECT conv_id, turn, md5(prompt) AS prompt_md5, CAST(length(prompt) AS BIGINT) AS prompt_chars FROM p
""")
def q_prompt_build(spark, sf_dir):
    c, v = _replies(spark, sf_dir)
    r = running_context(c, "conv_id", "turn", v).where(F.col("role") == "user")
    p = prompt_text(F.lit(DEFAULT_FOCUS), "context", "text")
    return r.select("conv_id", "turn", F.md5(p).alias("prompt_md5"),
                    F.length(p).cast("bigint").alias("prompt_chars"))


@query("title_and_date", f"""
SELECT page_id,
  nullif({sql_strip("CASE WHEN strpos(lower(html), '<title>') > 0 THEN regexp_extract(html, '(?i)<title>([^<]*)</title>', 1) ELSE split_part(html, chr(10), 1) END")}, '') AS title,
  nullif(regexp_extract(html, '{X.DATE_RE}', 0), '') AS article_date
FROM pages
""")
def q_title_and_date(spark, sf_dir):
    return T.pages(spark, sf_dir).select(
        "page_id", X.title_of("html").alias("title"),
        X.date_of("html").alias("article_date"))


# Dates written into the bodies of the query below, by page_id % 6: three forms of a day of 2024, an ISO date, an impossible
# date before a possible one, an impossible date alone. The day is page_id % 28 + 1, the month page_id % 12 + 1.
SQL_DATE = "make_date(2024, CAST(page_id % 12 + 1 AS INTEGER), CAST(page_id % 28 + 1 AS INTEGER))"


@query("article_date", f"""
SELECT page_id, CASE WHEN page_id % 6 = 5 THEN NULL ELSE {SQL_DATE} END AS article_date FROM pages
""")
def q_article_date(spark, sf_dir):
    """Dates of several written forms, normalised; impossible ones are passed over."""
    day = F.make_date(F.lit(2024), (F.col("page_id") % 12 + 1).cast("int"), (F.col("page_id") % 28 + 1).cast("int"))
    form = F.col("page_id") % 6
    stamp = (F.when(form == 0, F.date_format(day, "yyyy-MM-dd")).when(form == 1, F.date_format(day, "MMMM d, yyyy"))
             .when(form == 2, F.concat(F.date_format(day, "d"), F.lit("th "), F.date_format(day, "MMM yyyy")))
             .when(form == 3, F.concat(F.upper(F.date_format(day, "MMM")), F.date_format(day, ". d yyyy")))
             .when(form == 4, F.concat(F.lit("February 30, 2024, then "), F.date_format(day, "yyyy/M/d")))
             .otherwise(F.lit("2023-02-29 and 31 June 2024")))
    body = F.concat(F.lit("<p>Issue of "), stamp, F.lit(". No. 12345-2024-01-01-7.</p>"), F.col("html"))
    return T.pages(spark, sf_dir).select("page_id", body.alias("body")).select(
        "page_id", X.written_date("body").alias("article_date"))


def sql_terms(x: str) -> str:
    return (f"list_filter(string_split_regex(lower({x}), '{TERM_SPLIT_RE}'), "
            f"lambda t: length(t) >= {TERM_MIN_LEN})")


def sql_weights(src: str = "documents") -> str:
    """CTEs ending in ``w(doc_id, term, score)``: tf-idf over ``src(doc_id, text)``."""
    return f"""
tt AS (SELECT doc_id, unnest({sql_terms('text')}) AS term FROM {src}),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tt GROUP BY doc_id, term),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
nd AS (SELECT count(*) AS n FROM {src}),
w AS (SELECT tf.doc_id, tf.term, round(tf.tf * ln((nd.n + 1) / (dfq.df + 1)), 6) AS score
      FROM tf JOIN dfq ON tf.term = dfq.term CROSS JOIN nd)"""


SQL_WEIGHTS = sql_weights()


def _docs_by_id(spark, sf_dir):
    """documents hash-partitioned by id (the term, sentence and ranking steps
    below are keyed by document and reuse this partitioning), and the
    document count taken from the plain scan (parquet metadata, no shuffle)."""
    raw = T.table(spark, sf_dir, "documents").select("doc_id", "text")
    return co_partition_by(raw, "doc_id"), raw.select(F.count(F.lit(1))).scalar()


@query("keywords_topk", f"""
WITH {SQL_WEIGHTS},
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS kw_rank FROM w)
SELECT doc_id, CAST(kw_rank AS BIGINT) AS kw_rank, term, score FROM r WHERE kw_rank <= 5
""")
def q_keywords_topk(spark, sf_dir):
    d, n = _docs_by_id(spark, sf_dir)
    kw = X.keywords(X.term_weights(d, n_docs=n))
    return kw.select("doc_id", F.col("kw_rank").cast("bigint").alias("kw_rank"),
                     "term", "score")


def _sql_top_sentences(units: str, keys: list[str], k: int, p: str = "") -> str:
    """CTEs ``{p}s``..``{p}pk`` picking the best ``k`` sentences of each
    ``keys`` group of the ``units(keys.., text)`` relation, scored with
    ``w``."""
    kc = ", ".join(keys)
    on = " AND ".join(f"s.{c} = sc.{c}" for c in keys)
    return f"""
{p}sx AS (SELECT {kc}, list_filter(list_transform(regexp_extract_all(text, '{SENTENCE_RE}'),
          lambda x: {sql_strip('x')}), lambda x: x <> '') AS sents FROM {units}),
{p}si AS (SELECT {kc}, sents, unnest(range(len(sents))) AS i FROM {p}sx),
{p}s AS (SELECT {kc}, i AS s_ix, sents[i + 1] AS sentence FROM {p}si),
{p}o AS (SELECT {kc}, s_ix, unnest({sql_terms('sentence')}) AS term FROM {p}s),
{p}sc AS (SELECT {', '.join('o.' + c for c in keys)}, o.s_ix, avg(w.score) AS a FROM {p}o o
       JOIN w ON o.doc_id = w.doc_id AND o.term = w.term
       GROUP BY {', '.join('o.' + c for c in keys)}, o.s_ix),
{p}ss AS (SELECT {', '.join('s.' + c for c in keys)}, s.s_ix, s.sentence,
              round(coalesce(sc.a, 0), 6) AS s_score
       FROM {p}s s LEFT JOIN {p}sc sc ON {on} AND s.s_ix = sc.s_ix),
{p}rk AS (SELECT *, row_number() OVER (PARTITION BY {kc} ORDER BY s_score DESC, s_ix) AS r
       FROM {p}ss),
{p}pk AS (SELECT {kc}, string_agg(sentence, ' ' ORDER BY s_ix) AS picked FROM {p}rk
       WHERE r <= {k} GROUP BY {kc})"""


@query("executive_summary", f"""
WITH {SQL_WEIGHTS},
docs AS (SELECT doc_id, text FROM documents),
{_sql_top_sentences('docs', ['doc_id'], X.EXEC_SENTENCES)}
SELECT d.doc_id, pk.picked AS exec_summary FROM documents d LEFT JOIN pk ON d.doc_id = pk.doc_id
""")
def q_executive_summary(spark, sf_dir):
    d, n = _docs_by_id(spark, sf_dir)
    w = X.term_weights(d, n_docs=n)
    return X.top_sentences(d, w, X.EXEC_SENTENCES).withColumnRenamed("picked", "exec_summary")


def detailed(d, w, m=WIN_M, o=WIN_O):
    """Per document, each window's best sentences, in window order."""
    return X.top_window_sentences(chunk_text(d, "text", m, o), w, X.DETAIL_SENTENCES)


@query("detailed_summary", f"""
WITH {SQL_WEIGHTS},
cw AS ({_sql_windows(WIN_M, WIN_O)}),
units AS (SELECT doc_id, chunk_ix, chunk AS text FROM cw),
{_sql_top_sentences('units', ['doc_id', 'chunk_ix'], X.DETAIL_SENTENCES)},
dd AS (SELECT doc_id, string_agg(picked, ' ' ORDER BY chunk_ix) AS detailed,
              CAST(count(*) AS BIGINT) AS n_windows FROM pk GROUP BY doc_id)
SELECT d.doc_id, dd.detailed, dd.n_windows FROM documents d LEFT JOIN dd ON d.doc_id = dd.doc_id
""")
def q_detailed_summary(spark, sf_dir):
    d, n = _docs_by_id(spark, sf_dir)
    w = X.term_weights(d, n_docs=n)
    return detailed(d, w)
