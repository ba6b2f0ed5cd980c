"""Rendering the digest (R1-R6) as column expressions.

* R1 info header ``LLM Model: <name><br><br>``;
* R2 the header goes right after the first exact ``<body>``; ``<BODY>`` or
  ``<body class=..>`` do not count, and then it goes in front;
* R3 every "```html" is removed, then every "```";
* R4 subject prefix; an empty subject falls back to the bare prefix text;
* R5 with forwarding on, the outbox row carries the original's leaf parts in
  walk order after a separator element (each leaf once: a deliberate
  difference from attaching containers and leaves both);
  Given the message's ``tree``, elements keep their headers and filename, attachments their bytes, and
  a nested mail is one element with its bytes;
* R6 a single-part original that cannot be decoded becomes an error text
  element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings.functions.text import col_

# --- fixed values -----------------------------------------------------------
INFO_HEADER = ("LLM Model: ", "<br><br>")
MODEL_FALLBACK = "N/A"
BODY_TAG = "<body>"
FENCES = ("```html", "```")
SUBJECT_PREFIX = "tldr Summary: "
SUBJECT_DEFAULT = "tldr Summary"
ORIGINAL_SEPARATOR = "<br><hr><b>ORIGINAL EMAIL:</b><br><br>"
ATTACH_FAILED = "Could not fully process original message part. Error: "
DEFAULT_MODEL = "gpt-4o"
# ---------------------------------------------------------------------------

ELEMENT_TYPE = ("array<struct<content_type:string,text:string,filename:string,"
                "headers:array<struct<name:string,value:string>>,payload:binary>>")


def info_header(model) -> Column:
    m = model if isinstance(model, Column) else F.lit(model)
    return F.concat(F.lit(INFO_HEADER[0]), F.coalesce(m, F.lit(MODEL_FALLBACK)),
                    F.lit(INFO_HEADER[1]))


def inject_header(html, header) -> Column:
    """R2 + R3: header after the first ``<body>`` or in front; then fences."""
    h, hdr = col_(html), col_(header)
    pos = F.locate(BODY_TAG, h)
    cut = pos + F.lit(len(BODY_TAG) - 1)
    injected = F.when(pos > 0, F.concat(F.substr(h, F.lit(1), cut), hdr,
                                        F.substr(h, cut + 1)))\
                .otherwise(F.concat(hdr, h))
    out = injected
    for fence in FENCES:
        out = F.replace(out, F.lit(fence), F.lit(""))
    return out


def digest_subject(subject, prefix: str = SUBJECT_PREFIX) -> Column:
    """Prefix the subject; an empty result gets the default."""
    return F.coalesce(F.nullif(F.concat(F.lit(prefix), col_(subject)), F.lit("")),
                      F.lit(SUBJECT_DEFAULT))


def original_elements(parts="parts", multipart="is_multipart", tree=None) -> Column:
    """R5 + R6: separator, then the original's leaves in walk order.

    ``tree`` (of ``parse_mime(.., tree=True)``) has a node for each part, in the same order."""
    parts = col_(parts)
    multi = F.coalesce(col_(multipart), F.lit(False))

    def element(p, node=None):
        failed = (~multi) & F.startswith(p["content_type"], F.lit("text/")) & \
                 ~F.coalesce(p["decode_ok"], F.lit(False))
        error = F.concat(F.lit(ATTACH_FAILED), F.lit("unknown encoding: "),
                         F.coalesce(p["charset"], F.lit("utf-8")))
        kept = [F.lit(None) if node is None else node[n] for n in ("filename", "headers", "payload")]
        return F.struct(
            F.when(failed, F.lit("text/plain")).otherwise(p["content_type"]).alias("content_type"),
            F.when(failed, error).otherwise(p["text"]).alias("text"),
            *[x.alias(n) for n, x in zip(("filename", "headers", "payload"), kept)])

    if tree is None:
        leaves = F.transform(F.filter(parts, lambda p: ~F.startswith(
            F.coalesce(p["content_type"], F.lit("")), F.lit("multipart/"))), lambda p: element(p))
    else:
        # a multipart part in which no boundary was found is a leaf with its bytes
        shown = F.filter(col_(tree), lambda n: n["mail_ix"].isNull() & (n["payload"].isNotNull() | ~F.startswith(
            F.coalesce(n["content_type"], F.lit("")), F.lit("multipart/"))))
        leaves = F.transform(shown, lambda n: element(F.get(parts, n["part_ix"]), n))
    sep = F.array(F.struct(F.lit("text/html").alias("content_type"), F.lit(ORIGINAL_SEPARATOR).alias("text"),
                           *[F.lit(None).alias(n) for n in ("filename", "headers", "payload")]))
    return F.concat(sep.cast(ELEMENT_TYPE), leaves.cast(ELEMENT_TYPE))


def elements_text(elements) -> Column:
    """A flat text form of an element array (for display and hashing)."""
    return F.array_join(F.transform(col_(elements), lambda e: F.concat(
        e["content_type"], F.lit(":"), F.coalesce(e["text"], F.lit("")))),
        "\n--\n")
