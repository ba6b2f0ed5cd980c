"""Replies kept by request, calls counted, and folds balanced by windows (M2, M3, M6)."""

import os

import pytest
from pyspark.sql import functions as F

from tidings.operators.balance import balanced
from tidings.operators.model import Kept, LeadSentence, model_fold, request_hash
from tidings.plans.digest import RunConfig, run_digest

CHUNKS = "id long, chunks array<struct<chunk_ix:int,start_tok:int,n_tok:int,chunk:string>>"


def Counted(folder, heal=False):
    """Writes down each request; windows that hold ``bad`` fail unless ``heal``. A closure, so that
    workers need not import this module."""
    path, lead = os.path.join(str(folder), "calls"), LeadSentence()

    def ask(requests):
        for r in requests:
            if "bad" in r["chunk"] and not heal:
                raise ConnectionError
        for r in requests:
            with open(path, "a") as f:
                f.write(f"{r['model']} {r['temperature']} {request_hash(r)}\n")
        return lead(requests)
    return ask


def calls(folder):
    path = os.path.join(str(folder), "calls")
    return open(path).read().splitlines() if os.path.exists(path) else []


def frame(spark, texts):
    rows = [(i, [(k, 0, 1, c) for k, c in enumerate(cs)]) for i, cs in texts]
    return spark.createDataFrame(rows, CHUNKS).repartition(3)


def rows(df):
    return sorted((r.id, r.summary, r.error_kind, r.n_calls) for r in df.collect())


def test_a_rerun_asks_nothing(spark, tmp_path):
    texts = [(1, ["One. x", "Two."]), (2, ["One. x", "Two."]), (3, []), (4, ["Three."]), (5, ["ok.", "bad.", "after."]), (6, ["One. x"])]
    df, path = frame(spark, texts), str(tmp_path / "kept")
    plain = rows(model_fold(df, "id", "chunks", Counted(tmp_path)))
    os.remove(tmp_path / "calls")
    first = model_fold(df, "id", "chunks", Kept(Counted(tmp_path), path))
    assert rows(first) == plain
    # equal documents ask once: 1 and 2 share two requests; 4, 6 and 5's first window have one each
    # (in one run 6 does not know of the equal request of a longer document)
    assert len(calls(tmp_path)) == 5 and len(set(calls(tmp_path))) == 4
    again = model_fold(df, "id", "chunks", Kept(Counted(tmp_path), path))
    assert rows(again) == plain and len(calls(tmp_path)) == 5
    assert again.agg(F.sum("n_asked")).first()[0] == 0
    # an error is not kept: once the model is up, only what is missing is asked for
    healed = model_fold(df, "id", "chunks", Kept(Counted(tmp_path, heal=True), path))
    assert (5, "after.", None, 3) in rows(healed) and len(calls(tmp_path)) == 7


def test_other_settings_are_other_requests(spark, tmp_path):
    df, path = frame(spark, [(1, ["One."])]), str(tmp_path / "kept")
    for model in ("a", "b", "a"):
        model_fold(df, "id", "chunks", Kept(Counted(tmp_path), path), model=model).collect()
    assert [c.split()[:2] for c in calls(tmp_path)] == [["a", "0.7"], ["b", "0.7"]]


def test_a_run_takes_kept_replies(spark, tmp_path):
    part = "array<struct<part_ix:int,content_type:string,disposition:string,charset:string,text:string,decode_ok:boolean>>"
    msgs = spark.createDataFrame([(i, "s", "t", False, [(0, "text/plain", None, None, f"Text {i}. More.", True)]) for i in range(4)],
                                 f"msg_uid long, sender string, subject string, is_multipart boolean, parts {part}")
    none, cfg = spark.createDataFrame([], "msg_uid long"), RunConfig(sender="s", model="m1")
    for _ in range(2):
        outbox, _ = run_digest(msgs, none, cfg, Kept(Counted(tmp_path), str(tmp_path / "kept")))
        assert outbox.count() == 4
    assert len(calls(tmp_path)) == 4 and all(c.startswith("m1 ") for c in calls(tmp_path))


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_windows_are_spread_evenly(spark, parts):
    sizes = [400] + [90] * 5 + [7] * 40 + [1] * 900 + [0] * 30
    df = spark.createDataFrame(list(enumerate(sizes)), "id long, n int").withColumn("text", F.repeat(F.lit("x"), "n"))
    out = balanced(df, "id", "n", parts)
    assert out.columns == df.columns
    got = out.withColumn("p", F.spark_partition_id()).collect()
    assert sorted((r.id, r.n, len(r.text)) for r in got) == [(i, n, n) for i, n in enumerate(sizes)]
    sums = [sum(r.n for r in got if r.p == p) for p in range(parts)]
    assert max(sums) - min(sums) <= max(400, sum(sizes) / parts - min(sums))
    assert all(abs(s - sum(sizes) / parts) <= 400 for s in sums)
    if parts == 4:
        assert max(len([r for r in got if r.p == p and r.n >= 90]) for p in range(parts)) <= 6


def test_folds_are_done_in_slices():
    import pyarrow as pa

    from tidings.operators.model import _folder
    windows = [[{"chunk": f"Window {i}. " + "x" * (1 << 19)}, {"chunk": f"Last {i}. More."}] for i in range(20)] + [[], None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(22)), pa.array(windows, pa.list_(pa.struct([("chunk", pa.string())])))], ["doc_id", "chunks"])
    sizes = []

    class Counting(LeadSentence):
        def __call__(self, requests):
            sizes.append(sum(len(r["chunk"]) for r in requests))
            return super().__call__(requests)

    rows = [r for b in _folder("doc_id", Counting(), {})([batch]) for r in b.to_pylist()]
    assert [(r["doc_id"], r["summary"], r["n_calls"]) for r in rows] == [(i, f"Last {i}.", 2) for i in range(20)] + [(20, "", 0), (21, "", 0)]
    assert max(sizes) <= 4 << 20
