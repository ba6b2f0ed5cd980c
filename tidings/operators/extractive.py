"""The default summarizer's sections as corpus-scale Spark operators.

The summary prompt asks for named sections. Without a hosted model each is
computed extractively, from the text alone, deterministically:

* X1 ``title_and_date``: ``<title>`` (or the first line) and the first ISO or
  written date, NULL when not found;
* X3 ``term_weights`` / ``keywords``: tf-idf over letter terms, top k per
  document;
* X2 ``top_sentences`` over whole texts: the best sentences by mean term
  weight, put back in text order;
* X4 ``top_window_sentences``: the same per window, folded in window order (each window's reply
  carries the context before it, so the fold result is every window's pick
  in order);
* X6 ``digest_html``: the sections as an HTML fragment, text escaped.

Term weights need one global number (the document count). It is a lazy
scalar subquery, not a driver round trip. Term statistics go through two
aggregations with map-side partial aggregation; the tf x df join is on
``term`` and hot terms are split by AQE's skew-join handling.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidings.functions.text import (TERM_MIN_LEN, TERM_SPLIT_RE, col_, html_escape,
                                    py_strip, sentences)
from tidings.session import ship_package, slices

# --- fixed values -----------------------------------------------------------
TOP_KEYWORDS = 5
EXEC_SENTENCES = 2
DETAIL_SENTENCES = 2
SCORE_DIGITS = 6
KEYWORD_SEP = ", "
TITLE_RE = "(?i)<title>([^<]*)</title>"
DATE_RE = ("[0-9]{4}-[0-9]{2}-[0-9]{2}|"
           "(January|February|March|April|May|June|July|August|September|"
           "October|November|December) [0-9]{1,2}, [0-9]{4}")
# Written forms of a date, in groups (year, month, day) or (month name, day, year) or (day, month name, year).
MONTHS = ("Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|"
          "Sep(?:t(?:ember)?)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?")
DATE_FORMS = ("([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})",
              f"({MONTHS})[.]? ([0-9]{{1,2}})(?:st|nd|rd|th)?,? ([0-9]{{4}})",
              f"([0-9]{{1,2}})(?:st|nd|rd|th)?[.]? ({MONTHS})[.]?,? ([0-9]{{4}})")
SECTION_TITLES = ("Executive Summary", "Keywords",
                  "Detailed Analysis and Contextual Summary")
# ---------------------------------------------------------------------------


def title_of(text) -> Column:
    """X1 title: ``<title>`` text, else the first line; NULL when empty."""
    t = col_(text)
    tag = F.regexp_extract(t, TITLE_RE, 1)
    first = F.substring_index(t, "\n", 1)
    return F.nullif(py_strip(F.when(F.locate("<title>", F.lower(t)) > 0, tag)
                             .otherwise(first)), F.lit(""))


def date_of(text) -> Column:
    """X1 date: the first ISO or written date, NULL when none."""
    return F.nullif(F.regexp_extract(col_(text), DATE_RE, 0), F.lit(""))


def written_date(text) -> Column:
    """X1 date as a DATE: the first date in ``text``, in any of `DATE_FORMS`, that the calendar has;
    an impossible one (30 February) is passed over. NULL when there is none."""
    # no digit or letter may touch a date, nor may it be part of a longer chain of numbers
    every = "(?i)(?<![\\p{L}0-9./-])(?:" + "|".join(DATE_FORMS).replace("(", "(?:").replace("(?:?:", "(?:") + ")(?![\\p{L}0-9]|[./-][0-9])"

    def parsed(found):
        def part(form, group):
            return F.regexp_extract(found, f"(?i){form}", group)

        def month(name):
            return F.concat(F.initcap(F.substring(F.lower(name), 1, 3)))
        year_first, month_first, day_first = DATE_FORMS
        return (F.when(F.regexp_like(found, F.lit("^[0-9]{4}")), F.try_to_date(
                    F.concat_ws("-", *(part(year_first, g) for g in (1, 2, 3))), "yyyy-M-d"))
                .when(F.regexp_like(found, F.lit("^[0-9]")), F.try_to_date(F.concat_ws(
                    " ", part(day_first, 1), month(part(day_first, 2)), part(day_first, 3)), "d MMM yyyy"))
                .otherwise(F.try_to_date(F.concat_ws(
                    " ", part(month_first, 2), month(part(month_first, 1)), part(month_first, 3)), "d MMM yyyy")))
    dates = F.transform(F.regexp_extract_all(col_(text), F.lit(every), F.lit(0)), parsed)
    return F.get(F.filter(dates, lambda d: d.isNotNull()), F.lit(0))


def term_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, term, tf): the terms of each document and how often it has them.

    A document's letter runs are sorted and counted beside it. A hash table by (document, term)
    would hold the terms of all documents of a task, many times their text; so a task needs
    memory for the texts and for the terms of one document. Rows with the same key are one document.
    ``explode_outer`` keeps the optimizer from inferring a ``size(..) > 0`` filter that would
    split the text twice."""
    d = docs.groupBy(key).agg(F.collect_list(text).alias("texts"))
    runs = F.flatten(F.transform("texts", lambda t: F.split(F.lower(t), TERM_SPLIT_RE)))
    # each step is a column of its own: an expression would be computed again for each run
    d = d.select(key, F.sort_array(runs).alias("runs"))
    starts = F.filter(F.sequence(F.lit(0), F.size("runs")),
                      lambda i: (i == 0) | ~F.get("runs", i - 1).eqNullSafe(F.get("runs", i)))
    # the last start is the end of the runs
    d = d.select(key, "runs", starts.alias("starts"))
    first = F.slice("starts", 1, F.size("starts") - 1)
    # a map, which is not cut to the fields that are read: cut, it would be computed in the steps above once more
    counts = F.map_from_arrays(F.transform(first, lambda s: F.get("runs", s)),
                               F.transform(first, lambda s, n: (F.get("starts", n + 1) - s).cast("bigint")))
    return d.select(key, F.explode_outer(counts).alias("term", "tf")).where(F.length("term") >= TERM_MIN_LEN)


def term_weights(docs: DataFrame, key: str = "doc_id",
                 text: str = "text", n_docs: Column | None = None) -> DataFrame:
    """(key, term, tf, df, score).

    ``score = round(tf * ln((n_docs + 1) / (df + 1)), 6)``, with ``n_docs``
    every row of ``docs`` (a lazy scalar subquery). Pass ``n_docs`` when
    ``docs`` is repartitioned: counting the plain scan needs no shuffle."""
    if n_docs is None:
        n_docs = docs.select(F.count(F.lit(1))).scalar()
    tf = term_counts(docs, key, text)
    df_ = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # the few rows a term has on this side are hashed, so that no task sorts its term counts
    w = tf.join(df_.hint("shuffle_hash"), on="term")
    score = F.round(F.col("tf") * F.ln((n_docs + F.lit(1)) / (F.col("df") + F.lit(1))),
                    SCORE_DIGITS)
    return w.select(key, "term", "tf", "df", score.alias("score"))


def keywords(weights: DataFrame, key: str = "doc_id",
             k: int = TOP_KEYWORDS) -> DataFrame:
    """Top ``k`` terms per key by score, ties by term: (key, kw_rank,
    term, score). ``row_number() <= k`` lets Spark add a partial
    per-partition limit before the shuffle."""
    w = Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("term"))
    return (weights.withColumn("kw_rank", F.row_number().over(w))
                   .where(F.col("kw_rank") <= k)
                   .select(key, "kw_rank", "term", "score"))


def weight_arrays(weights: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, weights): each document's terms and scores as one array of structs, no longer than its text."""
    return weights.groupBy(key).agg(F.collect_list(F.struct("term", "score")).alias("weights"))


def keyword_line(weights="weights", k: int = TOP_KEYWORDS) -> Column:
    """The top ``k`` terms of a `weight_arrays` column listed horizontally, ties by term; NULL without terms."""
    best = F.slice(F.sort_array(F.transform(col_(weights), lambda w: F.struct((-w["score"]).alias("s"), w["term"]))), 1, k)
    return F.nullif(F.array_join(F.transform(best, lambda w: w["term"]), KEYWORD_SEP), F.lit(""))


def sentence_runs(text) -> Column:
    """Each sentence's letter runs, lower-cased."""
    return F.transform(sentences(text), lambda s: F.split(F.lower(s), TERM_SPLIT_RE))


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _means(units: pa.Array, weights: pa.Array) -> pa.Array:
    """Per document and unit the mean weight of each sentence's terms (0 without any): terms are numbered
    once for the batch, and occurrences meet weights by (document, number) in sorted arrays."""
    unit, weight = units.flatten(), weights.flatten()
    sentence = unit.flatten()
    run = sentence.flatten()
    n_units, n_sentences, n_runs = _sizes(units), _sizes(unit), _sizes(sentence)
    doc = np.arange(len(units))
    doc_of_run = np.repeat(np.repeat(np.repeat(doc, n_units), n_sentences), n_runs)
    sentence_of_run = np.repeat(np.arange(len(sentence)), n_runs)
    # an empty array may come without buffers, which Arrow does not concatenate
    some = [x for x in (pc.struct_field(weight, "term") if len(weight) else [], run) if len(x)]
    term = (pa.concat_arrays(some) if some else pa.array([], pa.string())).dictionary_encode()
    number, many = term.indices.to_numpy(zero_copy_only=False), max(1, len(term.dictionary))
    known = np.repeat(doc, _sizes(weights)) * many + number[:len(weight)]
    order = np.argsort(known)
    score = pc.struct_field(weight, "score").to_numpy(zero_copy_only=False)[order] if len(weight) else np.empty(0)
    known = known[order]
    asked = doc_of_run * many + number[len(weight):]
    at = np.searchsorted(known, asked)
    hit = np.flatnonzero(np.r_[known, -1][at] == asked)
    sums = np.bincount(sentence_of_run[hit], score[at[hit]], len(sentence))
    count = np.bincount(sentence_of_run[hit], minlength=len(sentence))
    means = pa.ListArray.from_arrays(_offsets(n_sentences), pa.array(sums / np.maximum(count, 1)))
    return pa.ListArray.from_arrays(_offsets(n_units), means)


def sentence_means(units: Column, weights="weights") -> Column:
    """For each unit (an array of `sentence_runs`) the mean weight of each sentence's term occurrences.

    One Arrow step beside the document: neither occurrences nor weights leave its row."""
    def means(units: pa.Array, weights: pa.Array) -> pa.Array:
        # the numbers of all occurrences are several times the text, so slice by slice
        batch = pa.RecordBatch.from_arrays([units, weights], names=["units", "weights"])
        return pa.concat_arrays([_means(*s.columns) for s in slices(batch)])

    ship_package(SparkSession.active())
    # types given as objects, since annotations are text in this module
    means.__annotations__ = {"units": pa.Array, "weights": pa.Array, "return": pa.Array}
    return F.arrow_udf(means, "array<array<double>>")(units, F.coalesce(col_(weights), F.array().cast("array<struct<term:string,score:double>>")))


def best_sentences(means: Column, k: int) -> Column:
    """The indexes of the best ``k`` sentences by mean weight; ties go to the earlier sentence."""
    order = F.sort_array(F.transform(means, lambda m, i: F.struct((-F.round(m, SCORE_DIGITS)).alias("s"), i.alias("i"))))
    return F.transform(F.slice(order, 1, k), lambda p: p["i"])


def _picked(text: Column, picks: Column) -> Column:
    """The picked sentences of ``text`` in text order, joined by single spaces; NULL without any.
    ``picks`` is a column of its own: an expression would be computed again for each sentence."""
    return F.when(F.size(picks) > 0, F.array_join(F.filter(sentences(text), lambda s, i: F.array_contains(picks, i)), " "))


def _picked_windows(chunks: Column, picks: Column) -> Column:
    """Each window's picked sentences (NULL where it has none), in window order."""
    return F.transform(F.arrays_zip(chunks.alias("c"), picks.alias("p")), lambda w: _picked(w["c"]["chunk"], w["p"]))


def top_sentences(docs: DataFrame, weights: DataFrame, k: int, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """(key, picked), the best ``k`` sentences of each text, NULL where it has none.

    A sentence scores the mean weight of its term occurrences; a sentence without terms scores 0.
    Weights come to the documents as one array each, so documents that are partitioned by ``key``
    stay where they are."""
    d = docs.select(key, text).join(weight_arrays(weights, key), key, "left")
    d = d.withColumn("means", sentence_means(F.array(sentence_runs(text))))
    d = d.withColumn("picks", best_sentences(F.get("means", F.lit(0)), k))
    return d.select(key, _picked(F.col(text), F.col("picks")).alias("picked"))


def top_window_sentences(docs: DataFrame, weights: DataFrame, k: int,
                         key: str = "doc_id") -> DataFrame:
    """(key, detailed, n_windows), the best ``k`` sentences of each window of the
    ``chunks`` column, in window order; NULL where no window has a sentence."""
    d = docs.select(key, "chunks").join(weight_arrays(weights, key), key, "left")
    d = d.withColumn("means", sentence_means(F.transform("chunks", lambda c: sentence_runs(c["chunk"]))))
    d = d.withColumn("picks", F.transform("means", lambda m: best_sentences(m, k)))
    d = d.withColumn("windows", F.filter(_picked_windows(F.col("chunks"), F.col("picks")), lambda w: w.isNotNull()))
    some = F.size("windows") > 0
    return d.select(key, F.when(some, F.array_join("windows", " ")).alias("detailed"),
                    F.when(some, F.size("windows")).cast("bigint").alias("n_windows"))


def sections(docs: DataFrame, weights: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` (with ``chunks``) and the columns ``picked``, ``keywords`` and ``detailed``, all from one
    join with the weights.

    A text that fits in one window is that window verbatim, so its detailed pick is its executive pick
    when both take the same number of sentences: only texts of several windows have their windows scored."""
    reuse = DETAIL_SENTENCES == EXEC_SENTENCES
    windows = F.when(F.size("chunks") > (1 if reuse else 0), F.col("chunks")).otherwise(F.slice("chunks", 1, 0))
    d = docs.join(weight_arrays(weights, key), key, "left").withColumn("_windows", windows)
    units = F.concat(F.array(sentence_runs(text)), F.transform(
        F.coalesce("_windows", F.slice("chunks", 1, 0)), lambda c: sentence_runs(c["chunk"])))
    # without windows there is no unit beside the text
    d = d.withColumn("means", sentence_means(F.coalesce(units, F.array(sentence_runs(text)))))
    d = d.withColumns({"_picks": best_sentences(F.get("means", F.lit(0)), EXEC_SENTENCES),
                       "_window_picks": F.transform(F.slice("means", 2, 1 << 30), lambda m: best_sentences(m, DETAIL_SENTENCES))})
    several = F.array_join(_picked_windows(F.col("_windows"), F.col("_window_picks")), " ")
    d = d.withColumn("picked", _picked(F.col(text), F.col("_picks"))).withColumn("keywords", keyword_line())
    detailed = F.when(F.size("chunks") == 1, F.col("picked")).otherwise(several) if reuse else several
    return d.withColumn("detailed", detailed).drop("weights", "means", "_windows", "_picks", "_window_picks")


def has_digest(text) -> Column:
    """Whether `digest_html` of a nonblank text's sections has any: a title, a term (then
    there are keywords) or a sentence (then one is picked)."""
    t = col_(text)
    term = F.exists(F.split(F.lower(t), TERM_SPLIT_RE), lambda r: F.length(r) >= TERM_MIN_LEN)
    return title_of(t).isNotNull() | term | (F.size(sentences(t)) > 0)


def digest_html(title, date, exec_summary, keyword_text, detailed) -> Column:
    """The sections as an HTML fragment; empty sections are left out."""
    def sec(head, body):
        return F.when(F.coalesce(col_(body), F.lit("")) != "", F.concat(
            F.lit(f"<h3>{head}</h3><p>"), html_escape(col_(body)), F.lit("</p>")))\
            .otherwise(F.lit(""))
    head = F.when(col_(title).isNotNull(), F.concat(
        F.lit("<h2>"), html_escape(col_(title)), F.lit("</h2>"),
        F.when(col_(date).isNotNull(),
               F.concat(F.lit("<p>"), html_escape(col_(date)), F.lit("</p>")))
         .otherwise(F.lit("")))).otherwise(F.lit(""))
    return F.concat(head, sec(SECTION_TITLES[0], exec_summary),
                    sec(SECTION_TITLES[1], keyword_text),
                    sec(SECTION_TITLES[2], detailed))
