"""Text expressions: strip, word tokens, terms, sentences, HTML escape.

Everything here returns a ``Column`` built from Spark SQL functions, so it is
evaluated in the JVM inside whole-stage codegen. No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# The characters Python's ``str.strip()`` and ``str.split()`` treat as
# whitespace (``str.isspace``), in code point order. ``trim`` and ``split``
# with this set give Python's results exactly; Spark's plain ``trim`` drops
# spaces only, and Java's ``\s`` misses most of these.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regex class, valid in Java regex and in RE2 (DuckDB).
WS_CLASS = (
    "[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{1F} \\x{85}\\x{A0}\\x{1680}"
    "\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
WS_RUN = WS_CLASS + "+"
# A sentence: a run of non-terminators plus its terminators. RE2 has no
# look-behind, so this form is used on both engines.
SENTENCE_RE = "[^.!?]+[.!?]*"
# A term for keyword scoring: a run of letters, lower-cased, 3 or more long.
TERM_SPLIT_RE = "[^\\p{L}]+"
TERM_MIN_LEN = 3
# ---------------------------------------------------------------------------


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: trims every Unicode whitespace character."""
    return F.trim(col_(c), F.lit(WHITESPACE))


def words(c) -> Column:
    """Python ``str.split()``: non-empty runs between whitespace.

    NULL text gives NULL; empty or blank text gives an empty array.
    """
    return F.filter(F.split(col_(c), WS_RUN), lambda t: t != F.lit(""))


def n_words(c) -> Column:
    """Token count (T1): 0 for NULL or blank text."""
    return F.coalesce(F.size(words(c)), F.lit(0)).cast("bigint")


def terms(c) -> Column:
    """Lower-cased letter runs of at least ``TERM_MIN_LEN`` characters."""
    return F.filter(F.split(F.lower(col_(c)), TERM_SPLIT_RE),
                    lambda t: F.length(t) >= F.lit(TERM_MIN_LEN))


def sentences(c) -> Column:
    """Sentences in text order, stripped, blanks dropped."""
    return F.filter(
        F.transform(F.regexp_extract_all(col_(c), F.lit(SENTENCE_RE), 0),
                    lambda s: F.trim(s, F.lit(WHITESPACE))),
        lambda s: s != F.lit(""))


def html_escape(c) -> Column:
    """Escape ``& < > "`` for an HTML text node or attribute."""
    x = col_(c)
    x = F.replace(x, F.lit("&"), F.lit("&amp;"))
    x = F.replace(x, F.lit("<"), F.lit("&lt;"))
    x = F.replace(x, F.lit(">"), F.lit("&gt;"))
    return F.replace(x, F.lit('"'), F.lit("&quot;"))


def nonblank(c) -> Column:
    """Truthy text in Python's sense: not NULL and not empty."""
    x = col_(c)
    return x.isNotNull() & (x != F.lit(""))
