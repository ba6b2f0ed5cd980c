"""Body choice over a message's parts.

A message carries ``parts``: an ordered array of
``struct(part_ix, content_type, disposition, charset, text, decode_ok)`` in
depth-first walk order. The rules, as array expressions:

* P2 in a multipart message a part is skipped when its disposition text
  contains ``attachment`` (case-sensitive; a missing header never does);
* P5 a single-part message is taken whatever its disposition;
* P3 the first part of each kind (plain, HTML) that decoded fills the slot;
  a failed decode leaves it open, an empty text fills it;
* P6 plain wins if non-empty *before* stripping, else HTML if non-empty,
  then the choice is stripped, so a blank plain part beats a good HTML part
  and the message ends with an empty body;
* P7 an empty body is rejected (``no_body``);
* P8 a missing subject header becomes ``Email UID <uid> (No Subject)``; an
  empty subject stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions.text import col_, nonblank, py_strip

PART_TYPE = ("array<struct<part_ix:int,content_type:string,"
             "disposition:string,charset:string,text:string,"
             "decode_ok:boolean>>")

# --- fixed values -----------------------------------------------------------
PLAIN = "text/plain"
HTML = "text/html"
ATTACHMENT_MARK = "attachment"
NO_SUBJECT = ("Email UID ", " (No Subject)")
# ---------------------------------------------------------------------------


def _first_text(parts: Column, multipart: Column, ctype: str) -> Column:
    def ok(p):
        kept = (~multipart) | ~F.contains(F.coalesce(p["disposition"], F.lit("")),
                                          F.lit(ATTACHMENT_MARK))
        return kept & (p["content_type"] == ctype) & F.coalesce(
            p["decode_ok"], F.lit(False))
    return F.try_element_at(F.filter(parts, ok), F.lit(1))["text"]


def body_columns(parts="parts", multipart="is_multipart") -> dict[str, Column]:
    parts, multipart = col_(parts), F.coalesce(col_(multipart), F.lit(False))
    plain = _first_text(parts, multipart, PLAIN)
    html = _first_text(parts, multipart, HTML)
    return {"body_plain": plain, "body_html": html}


def select_body(df: DataFrame, parts: str = "parts",
                multipart: str = "is_multipart") -> DataFrame:
    """Add ``body`` (stripped, NULL when neither kind is present) and
    ``body_kind`` ('plain', 'html' or NULL)."""
    cols = body_columns(parts, multipart)
    d = df.withColumns(cols)
    p, h = F.col("body_plain"), F.col("body_html")
    return (d.withColumn("body", F.when(nonblank(p), py_strip(p))
                         .when(nonblank(h), py_strip(h)))
             .withColumn("body_kind", F.when(nonblank(p), F.lit("plain"))
                         .when(nonblank(h), F.lit("html")))
             .drop("body_plain", "body_html"))


def subject_or_fallback(subject="subject", uid="msg_uid") -> Column:
    """A missing header gets the fallback; an empty one stays empty."""
    return F.coalesce(col_(subject),
                      F.concat(F.lit(NO_SUBJECT[0]), col_(uid).cast("string"),
                               F.lit(NO_SUBJECT[1])))
