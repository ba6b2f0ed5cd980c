"""Plan-shape regression tests: the properties the design relies on, with
broadcasts off, as at scale."""

import glob
import re

import pytest

from scripts.plan_report import final_plan
from tidings.plans.registry import QUERIES as QS

NO_BROADCAST = ("spark.sql.autoBroadcastJoinThreshold",
                "spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture(autouse=True)
def no_broadcasts(spark):
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k in NO_BROADCAST:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _plan(spark, name, sf):
    df = QS[name](spark, sf)
    df.collect()
    return final_plan(df)


def _shuffles(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)


def _keys(shuffle):
    return re.sub(r"#\d+L?", "", shuffle)


def test_initial_plans_are_left_out(spark, sf_small):
    plan = _plan(spark, "keywords_topk", sf_small)
    assert "Subquery" in plan and "Initial Plan" not in plan


def test_unread_scan_is_pruned_and_filtered(spark, sf_small):
    plan = _plan(spark, "unread_from_sender", sf_small)
    assert re.search(r"FileScan parquet \[doc_id#\d+L,source#\d+,n_chars#\d+L\]", plan)
    assert "EqualTo(quality,1)" in plan          # the ledger filter reaches the scan
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_projection_has_no_shuffle(spark, sf_small):
    assert "Exchange" not in _plan(spark, "token_count", sf_small)


def test_tf_needs_no_shuffle_of_term_occurrences(spark, sf_small):
    # the documents are repartitioned by id once, so the tf aggregation on
    # (doc, term) reuses that partitioning instead of shuffling occurrences
    plan = _plan(spark, "keywords_topk", sf_small)
    assert "REPARTITION_BY_COL" in plan
    assert "doc_id, term" not in [_keys(s) for s in _shuffles(plan)]


def test_staged_run_reads_buckets_and_leaves_no_table(spark, sf_small):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{root}/tables/*"))
    plan = _plan(spark, "digest_outbox", sf_small)
    assert "Bucketed: true" in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidings_")]
    new, = set(glob.glob(f"{root}/tables/*")) - before
    assert 0 < len(glob.glob(f"{new}/*.parquet")) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("name", ["executive_summary", "detailed_summary", "digest_outbox"])
def test_term_occurrences_are_not_shuffled_to_be_scored(spark, sf_small, name):
    # weights come to a document as one array and meet its terms there; what is shuffled by
    # term are the (document, term) pairs, for their document frequency
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    shuffles = [_keys(s) for s in _shuffles(_plan(spark, name, sf_small))]
    assert not [s for s in shuffles if "term" in s.split(", ") and s != "term"]
    assert not [s for s in shuffles if "s_ix" in s or "chunk_ix" in s]


def test_sentence_means_against_brute_force(spark):
    import random

    import pyarrow as pa

    from tidings.operators.extractive import _means
    rng = random.Random(3)
    words = ["a", "bb", "ccc", "dddd", "", "\u00e9\u00e9\u00e9"]
    docs = [[[[rng.choice(words) for _ in range(rng.randrange(5))] for _ in range(rng.randrange(4))]
             for _ in range(rng.randrange(3))] for _ in range(60)]
    weights = [[{"term": t, "score": rng.random()} for t in rng.sample(words, rng.randrange(5))] for _ in docs]
    got = _means(pa.array(docs, pa.list_(pa.list_(pa.list_(pa.string())))),
                 pa.array(weights, pa.list_(pa.struct([("term", pa.string()), ("score", pa.float64())])))).to_pylist()
    for units, ws, means in zip(docs, weights, got):
        known = {w["term"]: w["score"] for w in ws}
        want = [[sum(x) / max(1, len(x)) for s in u for x in [[known[t] for t in s if t in known]]] for u in units]
        assert [[pytest.approx(m) for m in u] for u in want] == means


def test_sentences_of_texts_without_any(spark):
    from tidings.operators.extractive import term_weights, top_sentences
    for texts in ([None, "", "  ", "..."], ["1 2 3. 4!"], []):
        d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r.doc_id: r.picked for r in top_sentences(d, term_weights(d), 2).collect()}
        assert got == {i: "1 2 3. 4!" if t and "1" in t else None for i, t in enumerate(texts)}
