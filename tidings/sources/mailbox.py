"""A mailbox derived from the driver tables.

``mail_source`` joins ``documents`` (plain bodies) and ``pages`` (HTML
bodies) on id into one row per message. The tables hold none of the awkward
cases the body rules are about, so a fixed rule on ``msg_uid % 10`` turns
some of the rows into them (see ``VARIANTS``). Every row of both tables is
kept; the rule changes a part's headers or text, never drops a message.

From that one source come two equal views of the same mail:

* ``mail_view``: parts as an array column, built with Spark expressions
  (``parse_ok`` False and no parts where the fetch failed);
* ``raw_mails``: real RFC 822 bytes (base64 parts, RFC 2047 subject), for
  the MIME parser to take apart again.

``raw_with_attachments`` has the same messages with their text attached once more as a
file, and with the page as a mail inside the mail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.operators.body import PART_TYPE
from tidings.sources import tables as T

# --- fixed values -----------------------------------------------------------
# Variant of a message, by msg_uid % 10:
#   1 plain part disposition 'attachment; filename="notes.txt"'
#   2 plain part empty
#   3 plain part blank (space, tab, newline, no-break space)
#   4 plain part in an unknown charset, so its decode fails
#   5 plain part disposition 'ATTACHMENT; filename="NOTES.TXT"' (capitals)
#   6 plain text wrapped in ideographic space + tab ... newline + no-break space
#   7 no Subject header
#   8 empty Subject header
#   9 the fetch failed: no raw bytes, nothing parsed (a fetch_failed outcome)
VARIANT_MOD = 10
FETCH_FAILED = 9
ATTACH_LOWER = 'attachment; filename="notes.txt"'
ATTACH_UPPER = 'ATTACHMENT; filename="NOTES.TXT"'
BLANK_TEXT = " \t\n\u00a0"
WRAP_HEAD, WRAP_TAIL = "\u3000\t", "\n\u00a0"
UNKNOWN_CHARSET = "x-unknown"
BOUNDARY = "=_tidings_part_boundary"
# ---------------------------------------------------------------------------

CRLF = "\r\n"
_TITLE_RE = "(?i)<title>([^<]*)</title>"


def mail_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per message: ids, sender, subject and the raw part fields."""
    # plain scans: the full outer join below shuffles both sides by id, which
    # already spreads the rows (a round-robin spread first would be wasted)
    d = T.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "source", "text",
        F.lit(True).alias("has_doc"))
    p = T.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), "url", "html",
        F.lit(True).alias("has_page"))
    j = d.join(p, on="id", how="full_outer")
    v = F.col("id") % VARIANT_MOD
    has_doc = F.coalesce(F.col("has_doc"), F.lit(False))
    has_page = F.coalesce(F.col("has_page"), F.lit(False))
    text = F.col("text")
    plain = (F.when(v == 2, F.lit(""))
             .when(v == 3, F.lit(BLANK_TEXT))
             .when(v == 6, F.concat(F.lit(WRAP_HEAD), text, F.lit(WRAP_TAIL)))
             .otherwise(text))
    subject = F.when(has_page, F.regexp_extract("html", _TITLE_RE, 1)) \
               .otherwise(F.substring_index(text, "\n", 1))
    fetched = v != FETCH_FAILED
    subject = (F.when((v == 7) | ~fetched, F.lit(None).cast("string"))
               .when(v == 8, F.lit("")).otherwise(subject))
    return j.select(
        F.col("id").alias("msg_uid"),
        F.coalesce(F.col("source"), F.col("url")).alias("sender"),
        fetched.alias("fetched"),
        subject.alias("subject"),
        has_doc.alias("has_doc"), has_page.alias("has_page"),
        F.when(has_doc, plain).alias("plain_text"),
        F.when(v == 1, F.lit(ATTACH_LOWER))
         .when(v == 5, F.lit(ATTACH_UPPER)).alias("plain_disposition"),
        F.when(v == 4, F.lit(UNKNOWN_CHARSET))
         .otherwise(F.lit("utf-8")).alias("plain_charset"),
        F.col("html"))


def _part(ix: int | Column, ctype: str | None, disp, charset, text, ok):
    def c(x, t):
        return x if isinstance(x, Column) else F.lit(x).cast(t)
    return F.struct(c(ix, "int").alias("part_ix"),
                    c(ctype, "string").alias("content_type"),
                    c(disp, "string").alias("disposition"),
                    c(charset, "string").alias("charset"),
                    c(text, "string").alias("text"),
                    c(ok, "boolean").alias("decode_ok"))


def mail_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with ``parts`` in walk order, as the MIME parser gives them:
    a multipart message lists its container first, then the leaves."""
    s = mail_source(spark, sf_dir)
    multi = F.col("has_doc") & F.col("has_page")
    decoded = F.col("plain_charset") != F.lit(UNKNOWN_CHARSET)
    plain_ix = F.when(multi, 1).otherwise(0)
    html_ix = F.when(multi, 2).otherwise(0)
    plain = _part(plain_ix, "text/plain", F.col("plain_disposition"),
                  F.col("plain_charset"),
                  F.when(decoded, F.col("plain_text")), decoded)
    html = _part(html_ix, "text/html", None, "utf-8", F.col("html"), True)
    container = _part(0, "multipart/alternative", None, None, None, None)
    parts = (F.when(~F.col("fetched"), F.lit(None).cast(PART_TYPE))
             .when(multi, F.array(container, plain, html))
             .when(F.col("has_doc"), F.array(plain))
             .otherwise(F.array(html))).cast(PART_TYPE)
    return s.select("msg_uid", "sender", "subject",
                    F.when(F.col("fetched"), multi).alias("is_multipart"),
                    parts.alias("parts"), F.col("fetched").alias("parse_ok"))


def _b64(text: Column) -> Column:
    """Base64 of the UTF-8 bytes; Spark breaks it into 76-character lines,
    which is valid for a MIME body."""
    return F.base64(F.encode(text, "utf-8"))


def _part_headers(ctype: str, charset: Column, disp: Column | None) -> Column:
    h = [F.lit(f"Content-Type: {ctype}; charset=\""), charset, F.lit('"' + CRLF),
         F.lit("Content-Transfer-Encoding: base64" + CRLF)]
    if disp is not None:
        h.append(F.when(disp.isNotNull(),
                        F.concat(F.lit("Content-Disposition: "), disp, F.lit(CRLF)))
                  .otherwise(F.lit("")))
    return F.concat(*h)


def raw_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope sender and RFC 822 bytes for every message of ``mail_source``."""
    s = mail_source(spark, sf_dir)
    subj = (F.when(F.col("subject").isNull(), F.lit(""))
            .when(F.col("subject") == "", F.lit("Subject: " + CRLF))
            .otherwise(F.concat(F.lit("Subject: =?utf-8?b?"),
                                F.replace(_b64(F.col("subject")), F.lit(CRLF), F.lit("")),
                                F.lit("?=" + CRLF))))
    top = F.concat(F.lit("From: "), F.col("sender"), F.lit(CRLF), subj,
                   F.lit("MIME-Version: 1.0" + CRLF))
    plain_h = _part_headers("text/plain", F.col("plain_charset"),
                            F.col("plain_disposition"))
    html_h = _part_headers("text/html", F.lit("utf-8"), None)
    plain_b = _b64(F.col("plain_text"))
    html_b = _b64(F.col("html"))
    multi = F.col("has_doc") & F.col("has_page")
    sep = F.lit(f"--{BOUNDARY}{CRLF}")
    multipart = F.concat(
        top, F.lit(f'Content-Type: multipart/alternative; boundary="{BOUNDARY}"'
                   f"{CRLF}{CRLF}"),
        sep, plain_h, F.lit(CRLF), plain_b, F.lit(CRLF),
        sep, html_h, F.lit(CRLF), html_b, F.lit(CRLF),
        F.lit(f"--{BOUNDARY}--{CRLF}"))
    single_plain = F.concat(top, plain_h, F.lit(CRLF), plain_b, F.lit(CRLF))
    single_html = F.concat(top, html_h, F.lit(CRLF), html_b, F.lit(CRLF))
    raw = (F.when(~F.col("fetched"), F.lit(None).cast("string"))
           .when(multi, multipart).when(F.col("has_doc"), single_plain)
           .otherwise(single_html))
    return s.select("msg_uid", "sender", F.encode(raw, "utf-8").alias("raw"))


def raw_with_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed messages: the document's text, the same bytes as a file (its name in RFC 2231 form
    where the id is odd), and the page as a nested mail."""
    s = mail_source(spark, sf_dir)
    uid = F.col("msg_uid").cast("string")
    sep = F.lit(f"--{BOUNDARY}{CRLF}")
    name = (F.when(F.col("msg_uid") % 2 == 1, F.concat(F.lit("*=utf-8''r%C3%A9sum%C3%A9-"), uid))
            .otherwise(F.concat(F.lit('="doc '), uid, F.lit('"'))))
    content = _b64(F.coalesce("plain_text", F.lit("")))
    plain = F.concat(sep, _part_headers("text/plain", F.col("plain_charset"), F.col("plain_disposition")),
                     F.lit(CRLF), content, F.lit(CRLF))
    attached = F.concat(sep, F.lit("Content-Type: application/octet-stream" + CRLF
                                   + "Content-Transfer-Encoding: base64" + CRLF
                                   + "Content-Disposition: attachment; filename"),
                        name, F.lit(CRLF * 2), content, F.lit(CRLF))
    inner = F.concat(F.lit("Subject: Page "), uid, F.lit(CRLF), _part_headers("text/html", F.lit("utf-8"), None),
                     F.lit(CRLF), _b64(F.coalesce("html", F.lit(""))))
    nested = F.concat(sep, F.lit("Content-Type: message/rfc822" + CRLF * 2), inner, F.lit(CRLF))
    raw = F.concat(F.lit("From: "), F.col("sender"), F.lit(CRLF + "MIME-Version: 1.0" + CRLF
                   + f'Content-Type: multipart/mixed; boundary="{BOUNDARY}"' + CRLF * 2),
                   F.when(F.col("has_doc"), F.concat(plain, attached)).otherwise(F.lit("")),
                   F.when(F.col("has_page"), nested).otherwise(F.lit("")), F.lit(f"--{BOUNDARY}--{CRLF}"))
    return s.select("msg_uid", "sender", F.encode(F.when(F.col("fetched"), raw), "utf-8").alias("raw"))
