"""Queries over the digest run: M2-M7 (plug-in fold), R1-R6, O1-O3, K1-K4,
and the flagship run."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidings.functions.chunk import chunk_text
from tidings.functions.text import SENTENCE_RE
from tidings.operators.model import Kept, LeadSentence, SummarizerError, model_fold
from tidings.operators.outcomes import confirm_sends, outcome_counts, size_stats, summary_stats
from tidings.operators.render import (ATTACH_FAILED, DEFAULT_MODEL, ORIGINAL_SEPARATOR,
                                      SUBJECT_DEFAULT, SUBJECT_PREFIX,
                                      elements_text, info_header, inject_header,
                                      original_elements)
from tidings.operators.state import ledger_after_run
from tidings.plans.digest import RunConfig, raw_statuses, run_digest, run_raw, run_statuses
from tidings.plans.q_mail import SQL_MAIL, sql_strip
from tidings.plans.q_text import SENDER, WIN_M, WIN_O, _sql_windows, sql_words
from tidings.plans.registry import query
from tidings.session import deal_by_key, scratch_path, written
from tidings.sources import tables as T
from tidings.sources.mailbox import mail_view, raw_mails, raw_with_attachments
from tidings.sources.mime import parse_mime

# --- fixed values -----------------------------------------------------------
RUN_ID = "run-0001"
# Page variants for the render rules, by page_id % 10:
#   1 '<body>' written '<BODY>'; 2 '<body class="main">'; 3 the page wrapped
#   in a "```html" fence; 4 no body tag at all.
# ---------------------------------------------------------------------------

_HDR = f"LLM Model: {DEFAULT_MODEL}<br><br>"
_NL = "chr(10) || '--' || chr(10)"

CFG = RunConfig(sender=SENDER, from_addr="digest@localhost", to_addr="reader@localhost",
                max_tokens=WIN_M, overlap=WIN_O)


def _run(spark, sf_dir, cfg=CFG, summarizer=None):
    return run_digest(mail_view(spark, sf_dir), T.read_ledger(spark, sf_dir), cfg,
                      summarizer)


def _statuses(spark, sf_dir, cfg=CFG):
    return run_statuses(mail_view(spark, sf_dir), T.read_ledger(spark, sf_dir), cfg)


SQL_STAGE = f"""
WITH {SQL_MAIL},
u AS (SELECT * FROM b WHERE contains(lower(sender), lower('{SENDER}'))
      AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.quality = 1 AND l.doc_id = b.msg_uid)),
bd AS (SELECT msg_uid, sender, fetched,
         CASE WHEN plain <> '' THEN {sql_strip('plain')} WHEN html <> '' THEN {sql_strip('html')} END AS body
       FROM u),
tk AS (SELECT msg_uid, sender, fetched, body, coalesce(len({sql_words('body')}), 0) AS n FROM bd),
oc AS (SELECT msg_uid, sender,
         CASE WHEN NOT fetched THEN 'fetch_failed' WHEN coalesce(body, '') = '' THEN 'no_body'
              WHEN n = 0 THEN 'no_chunks' ELSE 'sent' END AS status,
         CAST(coalesce(length(body), 0) AS BIGINT) AS n_chars, CAST(n AS BIGINT) AS n_tokens,
         CAST(CASE WHEN n = 0 THEN 0 WHEN n <= {WIN_M} THEN 1
                   ELSE (n - {WIN_M} + {WIN_M - WIN_O} - 1) // {WIN_M - WIN_O} + 1 END AS BIGINT) AS n_chunks
       FROM tk)"""


def _sql_percentiles(value, name):
    return ", ".join(f"CAST(quantile_disc({value}, {q}) AS BIGINT) AS p{round(100 * q)}_{name}" for q in (0.5, 0.95))


@query("outcomes", f"""{SQL_STAGE}
SELECT msg_uid, sender, status, n_chars, n_tokens, n_chunks FROM oc
""")
def q_outcomes(spark, sf_dir):
    return _statuses(spark, sf_dir).drop("subject")


@query("outcome_counts", f"""{SQL_STAGE}
SELECT status, CAST(count(*) AS BIGINT) AS n_messages FROM oc GROUP BY status
""")
def q_outcome_counts(spark, sf_dir):
    return outcome_counts(_statuses(spark, sf_dir))


@query("size_stats", f"""{SQL_STAGE}
SELECT sender, CAST(count(*) AS BIGINT) AS n_messages,
       CAST(min(n_chars) AS BIGINT) AS min_chars, CAST(max(n_chars) AS BIGINT) AS max_chars,
       CAST(sum(n_chars) AS BIGINT) AS sum_chars, round(avg(n_chars), 3) AS avg_chars,
       CAST(sum(n_chunks) AS BIGINT) AS sum_chunks,
       CAST(max(n_tokens) AS BIGINT) AS max_tokens,
       {_sql_percentiles('n_chars', 'chars')}, {_sql_percentiles('n_tokens', 'tokens')},
       {_sql_percentiles('n_chunks', 'chunks')}
FROM oc GROUP BY sender
""")
def q_size_stats(spark, sf_dir):
    return size_stats(_statuses(spark, sf_dir))


@query("ledger_after_run", f"""{SQL_STAGE}
SELECT doc_id AS msg_uid, 'previous' AS marked_by FROM labels WHERE quality = 1
UNION ALL
SELECT msg_uid, '{RUN_ID}' AS marked_by FROM oc WHERE status = 'sent'
  AND msg_uid NOT IN (SELECT doc_id FROM labels WHERE quality = 1)
""")
def q_ledger_after_run(spark, sf_dir):
    return ledger_after_run(T.read_ledger(spark, sf_dir), written(_statuses(spark, sf_dir)), RUN_ID)


@query("raw_run_outcomes", f"""{SQL_STAGE}
SELECT msg_uid, sender, status, n_chars, n_tokens, n_chunks FROM oc
""")
def q_raw_run_outcomes(spark, sf_dir):
    """The outcomes of the run on raw mail, failed fetches with them."""
    return raw_statuses(raw_mails(spark, sf_dir), T.read_ledger(spark, sf_dir), CFG).drop("subject")


# The send results of the two queries below: a message labelled toxic is refused,
# with an error where its id is odd; the others are delivered.
SQL_CONFIRMED = f"""{SQL_STAGE},
rf AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
cs AS (SELECT oc.msg_uid, CASE WHEN status <> 'sent' OR rf.doc_id IS NULL THEN status
                               WHEN msg_uid % 2 = 1 THEN 'send_error' ELSE 'send_failed' END AS status
       FROM oc LEFT JOIN rf ON oc.msg_uid = rf.doc_id)"""


def _confirmed(spark, sf_dir):
    oc = written(_statuses(spark, sf_dir))
    outbox = oc.where("status = 'sent'")
    refused = T.table(spark, sf_dir, "labels").where("toxic = 1").select(
        F.col("doc_id").alias("msg_uid"), F.lit(True).alias("refused")).distinct()
    no = F.col("refused").isNotNull()
    sends = outbox.select("msg_uid").join(refused, "msg_uid", "left").select(
        "msg_uid", (~no).alias("delivered"),
        F.when(no & (F.col("msg_uid") % 2 == 1), F.lit("refused")).alias("send_error"))
    return confirm_sends(oc, sends)


@query("outcomes_delivery", f"""{SQL_CONFIRMED}
SELECT msg_uid, status FROM cs
""")
def q_outcomes_delivery(spark, sf_dir):
    return _confirmed(spark, sf_dir).select("msg_uid", "status")


@query("ledger_delivery", f"""{SQL_CONFIRMED}
SELECT doc_id AS msg_uid, 'previous' AS marked_by FROM labels WHERE quality = 1
UNION ALL
SELECT msg_uid, '{RUN_ID}' AS marked_by FROM cs WHERE status = 'sent'
  AND msg_uid NOT IN (SELECT doc_id FROM labels WHERE quality = 1)
""")
def q_ledger_delivery(spark, sf_dir):
    return ledger_after_run(T.read_ledger(spark, sf_dir), _confirmed(spark, sf_dir), RUN_ID)


def _esc(x: str) -> str:
    return (f"replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), "
            f"'>', '&gt;'), '\"', '&quot;')")


def _sec(title: str, x: str) -> str:
    return (f"CASE WHEN coalesce({x}, '') <> '' THEN '<h3>{title}</h3><p>' || {_esc(x)} "
            f"|| '</p>' ELSE '' END")


def _sql_digest() -> str:
    """The whole digest in SQL: the run's bodies, tf-idf over them, the
    sections, the HTML, the header, the subject and the forwarded original."""
    from tidings.operators import extractive as X
    from tidings.plans.q_summary import _sql_top_sentences, sql_weights
    t_exec, t_kw, t_det = X.SECTION_TITLES
    head = (f"CASE WHEN title IS NOT NULL THEN '<h2>' || {_esc('title')} || '</h2>' || "
            f"CASE WHEN adate IS NOT NULL THEN '<p>' || {_esc('adate')} || '</p>' ELSE '' END "
            f"ELSE '' END")
    return f"""
WITH {SQL_MAIL},
u AS (SELECT * FROM b WHERE contains(lower(sender), lower('{SENDER}'))
      AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.quality = 1 AND l.doc_id = b.msg_uid)),
runq AS (SELECT msg_uid AS doc_id, v, has_doc, has_page, pt, html, subj,
           CASE WHEN plain <> '' THEN {sql_strip('plain')} WHEN html <> '' THEN {sql_strip('html')} END AS text
         FROM u),
{sql_weights('runq')},
kwr AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS r FROM w),
kw AS (SELECT doc_id, string_agg(term, '{X.KEYWORD_SEP}' ORDER BY r) AS keywords FROM kwr
       WHERE r <= {X.TOP_KEYWORDS} GROUP BY doc_id),
{_sql_top_sentences('runq', ['doc_id'], X.EXEC_SENTENCES, 'ex_')},
cw AS ({_sql_windows(WIN_M, WIN_O, 'runq')}),
cu AS (SELECT doc_id, chunk_ix, chunk AS text FROM cw),
{_sql_top_sentences('cu', ['doc_id', 'chunk_ix'], X.DETAIL_SENTENCES, 'dt_')},
dd AS (SELECT doc_id, string_agg(picked, ' ' ORDER BY chunk_ix) AS detailed FROM dt_pk GROUP BY doc_id),
sec AS (SELECT r.doc_id, r.subj, r.v, r.has_doc, r.has_page, r.pt, r.html,
          nullif({sql_strip(f"CASE WHEN strpos(lower(r.text), '<title>') > 0 THEN regexp_extract(r.text, '{X.TITLE_RE}', 1) ELSE split_part(r.text, chr(10), 1) END")}, '') AS title,
          nullif(regexp_extract(r.text, '{X.DATE_RE}', 0), '') AS adate,
          ex_pk.picked AS ex, kw.keywords, dd.detailed
        FROM runq r LEFT JOIN ex_pk ON r.doc_id = ex_pk.doc_id LEFT JOIN kw ON r.doc_id = kw.doc_id
        LEFT JOIN dd ON r.doc_id = dd.doc_id
        WHERE coalesce(r.text, '') <> ''),
sm AS (SELECT *, {head} || {_sec(t_exec, 'ex')} || {_sec(t_kw, 'keywords')} || {_sec(t_det, 'detailed')}
              AS summary FROM sec),
hd AS (SELECT *, strpos(summary, '<body>') AS pos FROM sm WHERE summary <> '')
SELECT doc_id AS msg_uid, '{CFG.from_addr}' AS from_addr, '{CFG.to_addr}' AS to_addr,
  coalesce(nullif('{SUBJECT_PREFIX}' || coalesce(subj, 'Email UID ' || doc_id || ' (No Subject)'), ''),
           '{SUBJECT_DEFAULT}') AS subject,
  replace(replace(CASE WHEN pos > 0 THEN substr(summary, 1, pos + 5) || '{_HDR}' || substr(summary, pos + 6)
                       ELSE '{_HDR}' || summary END, '```html', ''), '```', '') AS html,
  'text/html:{ORIGINAL_SEPARATOR}' || {_NL} ||
    CASE WHEN has_doc AND has_page THEN
           'text/plain:' || CASE WHEN v = 4 THEN '' ELSE coalesce(pt, '') END || {_NL} ||
           'text/html:' || coalesce(html, '')
         WHEN has_doc THEN
           'text/plain:' || CASE WHEN v = 4 THEN '{ATTACH_FAILED}unknown encoding: x-unknown'
                                 ELSE coalesce(pt, '') END
         ELSE 'text/html:' || coalesce(html, '') END AS original
FROM hd
"""


@query("digest_outbox", _sql_digest())
def q_digest_outbox(spark, sf_dir):
    """The whole run with the built-in summarizer: one outbox row per
    delivered message."""
    ob, _ = _run(spark, sf_dir)
    return ob.select("msg_uid", "from_addr", "to_addr", "subject", "html",
                     elements_text("original").alias("original"))


@query("summary_size_stats", _sql_digest().partition(",\nhd AS (")[0] + f"""
SELECT u.sender, CAST(count(*) AS BIGINT) AS n_summaries, CAST(min(length(summary)) AS BIGINT) AS min_chars,
       CAST(max(length(summary)) AS BIGINT) AS max_chars, round(avg(length(summary)), 3) AS avg_chars,
       {_sql_percentiles('length(summary)', 'chars')}
FROM sm JOIN u ON sm.doc_id = u.msg_uid WHERE summary <> '' GROUP BY u.sender
""")
def q_summary_size_stats(spark, sf_dir):
    """Lengths of the run's summaries, per sender."""
    _, oc = _run(spark, sf_dir)
    return summary_stats(oc)


@query("raw_run_outbox", _sql_digest())
def q_raw_run_outbox(spark, sf_dir):
    """The run on raw mail: choose, parse, summarize, render."""
    ob, _ = run_raw(raw_mails(spark, sf_dir), T.read_ledger(spark, sf_dir), CFG)
    return ob.select("msg_uid", "from_addr", "to_addr", "subject", "html",
                     elements_text("original").alias("original"))


@query("entry_flagship", _sql_digest())
def q_entry_flagship(spark, sf_dir):
    return q_digest_outbox(spark, sf_dir)


@query("model_fold", f"""
WITH cw AS ({_sql_windows(WIN_M, WIN_O)}),
r AS (SELECT doc_id, chunk_ix,
             {sql_strip(f"regexp_extract(chunk, '{SENTENCE_RE}', 0)")} AS reply FROM cw)
SELECT doc_id, coalesce(arg_max(reply, chunk_ix) FILTER (WHERE reply <> ''), '') AS summary,
       CAST(NULL AS VARCHAR) AS error_kind, CAST(count(*) AS BIGINT) AS n_calls
FROM r GROUP BY doc_id
""")
def q_model_fold(spark, sf_dir):
    d = chunk_text(T.documents(spark, sf_dir).select("doc_id", "text"), "text",
                   WIN_M, WIN_O)
    return model_fold(d, "doc_id", "chunks", LeadSentence())


# Replies of the query below, by the window's length modulo 11: 0 the call raises, 1 a rate limit
# for that request, 2 no reply, 3 a blank reply; else the first sentence.
class Faulty(LeadSentence):
    """`LeadSentence` that fails by that rule."""

    def __call__(self, requests):
        out = super().__call__(requests)
        for i, r in enumerate(requests):
            kind = len(r["chunk"]) % 11
            if kind == 0:
                raise ConnectionError("down")
            out[i] = {1: SummarizerError("rate_limit"), 2: None, 3: " \n"}.get(kind, out[i])
        return out


@query("model_fold_errors", f"""
WITH cw AS ({_sql_windows(WIN_M, WIN_O)}),
r AS (SELECT doc_id, chunk_ix, CASE WHEN length(chunk) % 11 = 3 THEN '' ELSE
               {sql_strip(f"regexp_extract(chunk, '{SENTENCE_RE}', 0)")} END AS reply,
             CASE length(chunk) % 11 WHEN 0 THEN 'connection' WHEN 1 THEN 'rate_limit' WHEN 2 THEN 'unexpected' END AS err
      FROM cw),
d AS (SELECT doc_id, min(chunk_ix) FILTER (WHERE err IS NOT NULL) AS bad, arg_min(err, chunk_ix) FILTER (WHERE err IS NOT NULL) AS kind,
             arg_max(reply, chunk_ix) FILTER (WHERE reply <> '') AS last, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY doc_id)
SELECT doc_id, CASE WHEN bad IS NULL THEN coalesce(last, '') END AS summary, kind AS error_kind,
       CASE WHEN bad IS NULL THEN n ELSE CAST(bad + 1 AS BIGINT) END AS n_calls FROM d
""")
def q_model_fold_errors(spark, sf_dir):
    """The fold with calls that raise, fail, give nothing or a blank reply (M4, M6, M7)."""
    d = chunk_text(T.documents(spark, sf_dir).select("doc_id", "text"), "text", WIN_M, WIN_O)
    return model_fold(d, "doc_id", "chunks", Faulty())


@query("model_fold_kept", f"""
WITH cw AS ({_sql_windows(WIN_M, WIN_O)}),
r AS (SELECT doc_id, chunk_ix,
             {sql_strip(f"regexp_extract(chunk, '{SENTENCE_RE}', 0)")} AS reply FROM cw)
SELECT doc_id, coalesce(arg_max(reply, chunk_ix) FILTER (WHERE reply <> ''), '') AS summary,
       CAST(NULL AS VARCHAR) AS error_kind, CAST(count(*) AS BIGINT) AS n_calls, CAST(0 AS BIGINT) AS n_asked
FROM r GROUP BY doc_id
""")
def q_model_fold_kept(spark, sf_dir):
    """The second of two folds whose replies are kept: the same rows, and nothing is asked."""
    d = deal_by_key(T.documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    d = written(chunk_text(d, "text", WIN_M, WIN_O).select("doc_id", "chunks"))
    kept = Kept(LeadSentence(), scratch_path(spark, "replies", uuid.uuid4().hex))
    model_fold(d, "doc_id", "chunks", kept)
    return model_fold(d, "doc_id", "chunks", kept)


@query("render_digest", f"""
WITH v AS (SELECT page_id, CASE page_id % 10
             WHEN 1 THEN replace(html, '<body>', '<BODY>')
             WHEN 2 THEN replace(html, '<body>', '<body class="main">')
             WHEN 3 THEN '```html' || chr(10) || html || chr(10) || '```'
             WHEN 4 THEN replace(html, '<body>', '')
             ELSE html END AS h FROM pages),
r AS (SELECT page_id, h, strpos(h, '<body>') AS pos FROM v),
o AS (SELECT page_id, pos > 0 AS after_body,
        replace(replace(CASE WHEN pos > 0 THEN substr(h, 1, pos + 5) || '{_HDR}' || substr(h, pos + 6)
                             ELSE '{_HDR}' || h END, '```html', ''), '```', '') AS out FROM r)
SELECT page_id, after_body, md5(out) AS html_md5, CAST(length(out) AS BIGINT) AS html_chars FROM o
""")
def q_render_digest(spark, sf_dir):
    p = T.pages(spark, sf_dir)
    v = F.col("page_id") % 10
    h = (F.when(v == 1, F.replace("html", F.lit("<body>"), F.lit("<BODY>")))
         .when(v == 2, F.replace("html", F.lit("<body>"), F.lit('<body class="main">')))
         .when(v == 3, F.concat(F.lit("```html\n"), F.col("html"), F.lit("\n```")))
         .when(v == 4, F.replace("html", F.lit("<body>"), F.lit("")))
         .otherwise(F.col("html")))
    out = inject_header(h, info_header(DEFAULT_MODEL))
    return p.select("page_id", (F.locate("<body>", h) > 0).alias("after_body"),
                    F.md5(out).alias("html_md5"),
                    F.length(out).cast("bigint").alias("html_chars"))


@query("append_original", f"""
WITH {SQL_MAIL}
SELECT msg_uid,
  CAST(CASE WHEN NOT fetched THEN NULL WHEN has_doc AND has_page THEN 3 ELSE 2 END AS BIGINT) AS n_elements,
  CASE WHEN fetched THEN md5('text/html:{ORIGINAL_SEPARATOR}' || {_NL} ||
    CASE WHEN has_doc AND has_page THEN
           'text/plain:' || CASE WHEN v = 4 THEN '' ELSE coalesce(pt, '') END || {_NL} ||
           'text/html:' || coalesce(html, '')
         WHEN has_doc THEN
           'text/plain:' || CASE WHEN v = 4 THEN '{ATTACH_FAILED}unknown encoding: x-unknown'
                                 ELSE coalesce(pt, '') END
         ELSE 'text/html:' || coalesce(html, '') END) END AS original_md5
FROM b
""")
def q_append_original(spark, sf_dir):
    m = mail_view(spark, sf_dir)
    e = original_elements("parts", "is_multipart")
    ok = F.col("parse_ok")
    return m.select("msg_uid", F.when(ok, F.size(e)).cast("bigint").alias("n_elements"),
                    F.when(ok, F.md5(elements_text(e))).alias("original_md5"))


_CRLF = "chr(13) || chr(10)"
SQL_FORWARDED = f"""
WITH {SQL_MAIL},
f AS (SELECT *, coalesce(pt, '') AS body,
        'Subject: Page ' || msg_uid || {_CRLF} || 'Content-Type: text/html; charset="utf-8"' || {_CRLF} ||
        'Content-Transfer-Encoding: base64' || {_CRLF} || {_CRLF} ||
        rtrim(regexp_replace(to_base64(encode(coalesce(html, ''))), '(.{{76}})', '\\1' || {_CRLF}, 'g'), {_CRLF}) AS inner_mail
      FROM b WHERE fetched)
SELECT msg_uid, CAST(0 AS BIGINT) AS element_ix, 'text/html' AS content_type, CAST(NULL AS VARCHAR) AS filename,
       md5('{ORIGINAL_SEPARATOR}') AS text_md5, CAST(NULL AS VARCHAR) AS payload_md5, CAST(NULL AS BIGINT) AS n_headers
FROM f
UNION ALL
SELECT msg_uid, 1, 'text/plain', CASE v WHEN 1 THEN 'notes.txt' WHEN 5 THEN 'NOTES.TXT' END,
       CASE WHEN v <> 4 THEN md5(body) END, CASE WHEN v = 4 THEN md5(body) END, CASE WHEN v IN (1, 5) THEN 3 ELSE 2 END
FROM f WHERE has_doc
UNION ALL
SELECT msg_uid, 2, 'application/octet-stream',
       CASE WHEN msg_uid % 2 = 1 THEN 'résumé-' || msg_uid ELSE 'doc ' || msg_uid END, NULL, md5(body), 3
FROM f WHERE has_doc
UNION ALL
SELECT msg_uid, CASE WHEN has_doc THEN 3 ELSE 1 END, 'message/rfc822', NULL, NULL, md5(inner_mail), 1
FROM f WHERE has_page
"""


@query("forwarded_original", SQL_FORWARDED)
def q_forwarded_original(spark, sf_dir):
    """Whole forwarded originals, an element a row: texts, attachments and nested mails by
    their bytes, with filename and number of headers."""
    m = parse_mime(raw_with_attachments(spark, sf_dir), tree=True).where("parse_ok")
    e = m.select("msg_uid", F.posexplode(original_elements("parts", "is_multipart", "tree")).alias("element_ix", "e"))
    return e.select("msg_uid", F.col("element_ix").cast("bigint").alias("element_ix"), "e.content_type", "e.filename",
                    F.md5("e.text").alias("text_md5"), F.md5("e.payload").alias("payload_md5"),
                    F.when(F.col("e.headers").isNotNull(), F.size("e.headers")).cast("bigint").alias("n_headers"))
