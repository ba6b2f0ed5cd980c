"""The summary fold (M1-M8) and the running context."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidings.operators.fold import (fold_array, fold_array_error, fold_last_nonempty,
                                    reply_value, running_context)
from tidings.operators.model import (LeadSentence, SummarizerError, fold_documents,
                                     model_fold)
from tidings.operators.prompt import USER_PROMPT, prompt_py, prompt_text


class Scripted:
    """Replies from a list, recording the requests it was given."""

    def __init__(self, replies):
        self.replies = list(replies)
        self.seen = []

    def __call__(self, reqs):
        self.seen.extend(reqs)
        return [self.replies.pop(0) for _ in reqs]


def test_fold_two_chunks_second_prompt_has_first_reply():
    s = Scripted(["Rates rose.", "Rates rose, then fell.", "  "])
    out, err, calls = fold_documents([["march figures", "april figures", "an empty month"]], s, focus="money")
    assert out == ["Rates rose, then fell."]
    assert err == [None] and calls == [3]
    first, second, third = (r["messages"][1]["content"] for r in s.seen)
    assert "Background context: ####" in first and "####march figures####" in first and "money" in first
    assert "Background context: ####Rates rose.####" in second and "####april figures####" in second
    assert "Background context: ####Rates rose, then fell.####" in third


def test_blank_reply_keeps_previous_and_no_chunks_gives_initial():
    out, err, _ = fold_documents([["a", "b", "c"], []], Scripted(["one", "  \n", ""]),
                                 initial_context="so far")
    assert out == ["one", "so far"]
    assert err == [None, None]


def test_errors_fail_only_their_document():
    def summarizer(reqs):
        return [SummarizerError("rate_limit") if r["chunk"] == "bad" else
                None if r["chunk"] == "null" else "ok" for r in reqs]
    out, err, calls = fold_documents([["x", "bad", "y"], ["null"], ["z"]], summarizer)
    assert out == [None, None, "ok"]
    assert err == ["rate_limit", "unexpected", None]
    assert calls == [2, 1, 1]


def test_raised_call_fails_only_the_requests_that_raise_alone():
    def boom(reqs):
        if any(r["chunk"] == "bad" for r in reqs):
            raise ConnectionError("down")
        return [r["chunk"].upper() for r in reqs]
    out, err, calls = fold_documents([["a"], ["bad"], ["b", "c"]], boom)
    assert out == ["A", None, "C"] and err == [None, "connection", None] and calls == [1, 1, 2]


def test_prompt_column_equals_python(spark):
    df = spark.createDataFrame([("ctx 'q'", "chunk\ntext")], "c string, k string")
    got = df.select(prompt_text(F.lit("focus"), "c", "k").alias("p")).first().p
    assert got == prompt_py("focus", "ctx 'q'", "chunk\ntext")
    assert USER_PROMPT.count("####") == 6   # identifier, "delimited by", 2 x context, 2 x chunk


def test_model_fold_job(spark):
    rows = [(1, [(0, 0, 3, "First. Second."), (1, 2, 3, "Second. Third!")]),
            (2, []), (3, [(0, 0, 1, "...")])]
    df = spark.createDataFrame(
        rows, "id long, chunks array<struct<chunk_ix:int,start_tok:int,n_tok:int,chunk:string>>")
    got = {r.id: r for r in model_fold(df, "id", "chunks", LeadSentence()).collect()}
    assert got[1].summary == "Second." and got[1].n_calls == 2
    assert got[2].summary == "" and got[2].n_calls == 0
    assert got[3].summary == "" and got[3].error_kind is None


def test_fold_last_nonempty_and_array_fold(spark):
    rows = [(1, 0, "user", "u"), (1, 1, "assistant", " r1 "), (1, 2, "assistant", "  "),
            (2, 0, "user", "only user")]
    df = spark.createDataFrame(rows, "k long, t long, role string, text string")
    v = reply_value("text", F.col("role") == "assistant")
    got = {r.k: r for r in fold_last_nonempty(df, "k", "t", v).collect()}
    assert got[1].summary == "r1" and got[1].n_replies == 1
    assert got[2].summary == "" and got[2].n_replies == 0
    arr = spark.createDataFrame([(["a", " ", "b "],), ([],), (["x", None],)], "r array<string>")
    res = arr.select(fold_array("r", "init").alias("f"),
                     fold_array_error("r").alias("e")).collect()
    assert [(r.f, r.e) for r in res] == [("b", False), ("init", False), ("x", True)]


def test_running_context_blocked_equals_plain_window(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for k in range(6):
        for t in range(rnd.randint(0, 40)):
            role = rnd.choice(["user", "assistant", "assistant"])
            rows.append((k, t, role, rnd.choice(["", "  ", f"r{k}.{t}"])))
    df = spark.createDataFrame(rows, "k long, t long, role string, text string")
    v = reply_value("text", F.col("role") == "assistant")
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    want = {(r.k, r.t): r.c for r in df.select(
        "k", "t", F.coalesce(F.last(v, ignorenulls=True).over(w), F.lit("")).alias("c")
    ).collect()}
    for block in (1, 3, 8, 1024):
        got = {(r.k, r.t): r.context for r in
               running_context(df, "k", "t", v, block=block).collect()}
        assert got == want, block
