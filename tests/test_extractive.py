"""Term weights and summary sizes: right rows, and no more than one document's terms or one summary at a time."""

from pyspark.sql import functions as F

from tidings.operators import extractive as X
from tidings.operators.outcomes import summary_stats


def test_term_counts_of_odd_texts(spark):
    docs = [(1, "The cat. the DOG, the ox; été Été"), (2, None), (3, ""), (4, " .., 12 "), (5, "ab"),
            (6, "one two"), (6, "two three"), (None, "one"), (None, "one")]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    got = sorted((r.doc_id or 0, r.term, r.tf) for r in X.term_counts(df).collect())
    assert got == [(0, "one", 2), (1, "cat", 1), (1, "dog", 1), (1, "the", 3), (1, "été", 2),
                   (6, "one", 1), (6, "three", 1), (6, "two", 2)]
    w = {(r.doc_id or 0, r.term): r.df for r in X.term_weights(df).collect()}
    assert w[(6, "one")] == w[(0, "one")] == 2 and w[(1, "the")] == 1 and len(w) == len(got)


def test_term_counts_need_no_table_of_terms(spark):
    plan = X.term_counts(spark.createDataFrame([(1, "a b")], "doc_id int, text string"))._jdf.queryExecution().optimizedPlan().toString()
    # grouped by document alone, and the text is split once
    assert plan.count("Aggregate [doc_id") == 1 and "Aggregate [doc_id#" in plan and ", term#" not in plan.split("Aggregate", 1)[1].split("]")[0]
    assert plan.count("split(") == 1


def test_summaries_are_made_once_for_their_sizes(spark):
    rows = [("a", "aab"), ("a", ""), ("a", None), ("b", ""), (None, "aaaa bbb")]
    made = spark.createDataFrame(rows, "sender string, s string").select(
        "sender", F.coalesce(F.length(F.regexp_replace("s", "a+", "x")), F.lit(0)).cast("bigint").alias("summary_chars"))
    stats = summary_stats(made)
    assert stats._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 1
    got = {r.sender: (r.n_summaries, r.min_chars, r.max_chars, r.avg_chars, r.p50_chars) for r in stats.collect()}
    assert got == {"a": (1, 2, 2, 2.0, 2), None: (1, 5, 5, 5.0, 5)}
