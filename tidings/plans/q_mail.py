"""Queries over messages: P1-P8, R4."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.functions.text import WHITESPACE
from tidings.operators.body import select_body, subject_or_fallback
from tidings.operators.render import SUBJECT_DEFAULT, SUBJECT_PREFIX, digest_subject
from tidings.plans.registry import query
from tidings.sources.mailbox import mail_view, raw_mails
from tidings.sources.mime import parse_mime

SQL_WS = "||".join(f"chr({ord(c)})" for c in WHITESPACE)


def sql_strip(x: str) -> str:
    return f"trim({x}, {SQL_WS})"


# The mail view of ``tidings.sources.mailbox`` written out in SQL.
SQL_MAIL = """
m AS (
  SELECT coalesce(d.doc_id, p.page_id) AS msg_uid,
         d.doc_id IS NOT NULL AS has_doc, p.page_id IS NOT NULL AS has_page,
         d.text, p.html, coalesce(d.doc_id, p.page_id) % 10 AS v,
         coalesce(d.source, p.url) AS sender
  FROM documents d FULL OUTER JOIN pages p ON d.doc_id = p.page_id),
b AS (
  SELECT msg_uid, v, has_doc, has_page, sender, v <> 9 AS fetched,
    CASE WHEN NOT has_doc THEN NULL
         WHEN v = 2 THEN ''
         WHEN v = 3 THEN ' ' || chr(9) || chr(10) || chr(160)
         WHEN v = 6 THEN chr(12288) || chr(9) || text || chr(10) || chr(160)
         ELSE text END AS pt,
    CASE WHEN NOT has_doc OR v IN (4, 9) OR (has_page AND v = 1) THEN NULL
         WHEN v = 2 THEN ''
         WHEN v = 3 THEN ' ' || chr(9) || chr(10) || chr(160)
         WHEN v = 6 THEN chr(12288) || chr(9) || text || chr(10) || chr(160)
         ELSE text END AS plain,
    CASE WHEN v = 9 THEN NULL ELSE html END AS html,
    CASE WHEN v IN (7, 9) THEN NULL WHEN v = 8 THEN ''
         WHEN has_page THEN regexp_extract(html, '(?i)<title>([^<]*)</title>', 1)
         ELSE split_part(text, chr(10), 1) END AS subj
  FROM m)"""

SQL_BODY = f"""
WITH {SQL_MAIL}
SELECT msg_uid,
  CASE WHEN plain <> '' THEN {sql_strip('plain')} WHEN html <> '' THEN {sql_strip('html')} END AS body,
  CASE WHEN plain <> '' THEN 'plain' WHEN html <> '' THEN 'html' END AS body_kind
FROM b
"""

SQL_SUBJECT = f"""
WITH {SQL_MAIL},
s AS (SELECT msg_uid, coalesce(subj, 'Email UID ' || msg_uid || ' (No Subject)') AS subject FROM b)
SELECT msg_uid, subject,
       coalesce(nullif('{SUBJECT_PREFIX}' || subject, ''), '{SUBJECT_DEFAULT}') AS digest_subject
FROM s
"""

SQL_MIME = f"""
WITH {SQL_MAIL}
SELECT msg_uid,
  coalesce(subj, 'Email UID ' || msg_uid || ' (No Subject)') AS subject,
  CASE WHEN plain <> '' THEN {sql_strip('plain')} WHEN html <> '' THEN {sql_strip('html')} END AS body,
  CASE WHEN plain <> '' THEN 'plain' WHEN html <> '' THEN 'html' END AS body_kind
FROM b
"""


@query("body_select", SQL_BODY)
def q_body_select(spark, sf_dir):
    return select_body(mail_view(spark, sf_dir)).select(
        "msg_uid", "body", "body_kind")


@query("subject_fallback", SQL_SUBJECT)
def q_subject_fallback(spark, sf_dir):
    m = mail_view(spark, sf_dir).select(
        "msg_uid", subject_or_fallback("subject", "msg_uid").alias("subject"))
    return m.select("msg_uid", "subject",
                    digest_subject(F.col("subject")).alias("digest_subject"))


@query("mime_parse", SQL_MIME)
def q_mime_parse(spark, sf_dir):
    parsed = parse_mime(raw_mails(spark, sf_dir))
    return select_body(parsed).select(
        "msg_uid", subject_or_fallback("subject", "msg_uid").alias("subject"),
        "body", "body_kind")
