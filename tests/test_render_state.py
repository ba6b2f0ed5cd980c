"""Rendering (R1-R6), outcomes (O1) and read state."""

from pyspark.sql import functions as F

from tidings.operators.outcomes import STATUSES, classify
from tidings.operators.render import (digest_subject, info_header, inject_header,
                                      original_elements)
from tidings.operators.state import ledger_after_run, sender_matches, unread

HDR = "LLM Model: m<br><br>"


def test_header_injection_and_fences(spark):
    cases = [
        ("<html><body><p>x</p></body></html>", f"<html><body>{HDR}<p>x</p></body></html>"),
        ("<html><BODY><p>x</p></html>", f"{HDR}<html><BODY><p>x</p></html>"),
        ('<body class="a">x', f'{HDR}<body class="a">x'),
        ("<p>frag</p>", f"{HDR}<p>frag</p>"),
        ("```html\n<body>a</body>\n```", f"\n<body>{HDR}a</body>\n"),
        ("<body>1<body>2", f"<body>{HDR}1<body>2"),
    ]
    df = spark.createDataFrame([(a,) for a, _ in cases], "h string")
    got = [r.o for r in df.select(inject_header("h", info_header("m")).alias("o")).collect()]
    assert got == [b for _, b in cases]


def test_info_header_fallback_and_subject(spark):
    df = spark.createDataFrame([(None, "s"), ("gpt", "")], "m string, s string")
    r = df.select(info_header(F.col("m")).alias("h"), digest_subject("s").alias("s"),
                  digest_subject("s", "").alias("bare")).collect()
    assert r[0].h == "LLM Model: N/A<br><br>" and r[1].h == "LLM Model: gpt<br><br>"
    assert r[0].s == "tldr Summary: s" and r[1].bare == "tldr Summary"


def test_original_elements(spark):
    parts = "array<struct<part_ix:int,content_type:string,disposition:string,charset:string,text:string,decode_ok:boolean>>"
    rows = [(True, [(0, "multipart/mixed", None, None, None, None),
                    (1, "text/plain", None, "utf-8", "p", True),
                    (2, "image/png", "attachment", None, None, None)]),
            (False, [(0, "text/plain", None, "x-bad", None, False)])]
    df = spark.createDataFrame(rows, f"m boolean, parts {parts}")
    got = [r.e for r in df.select(original_elements("parts", "m").alias("e")).collect()]
    assert [e.content_type for e in got[0]] == ["text/html", "text/plain", "image/png"]
    assert got[1][1].text.startswith("Could not fully process original message part.")


def test_classify_first_match_wins(spark):
    rows = [(False, None, None, None, None), (True, "", [], None, None),
            (True, "b", None, None, None), (True, "b", [], None, None),
            (True, "b", ["c"], "rate_limit", None), (True, "b", ["c"], "unexpected", None),
            (True, "b", ["c"], None, ""), (True, "b", ["c"], None, "<p>s</p>")]
    df = spark.createDataFrame(rows, "ok boolean, body string, chunks array<string>, "
                                     "ek string, summary string")
    got = [r.s for r in df.select(classify("ok", "body", "chunks", "ek", "summary")
                                  .alias("s")).collect()]
    assert got == ["fetch_failed", "no_body", "tokenizer_error", "no_chunks",
                   "api_error", "llm_error", "empty_summary", "sent"]
    assert set(got) <= set(STATUSES)


def test_unread_and_ledger_replay(spark):
    msgs = spark.createDataFrame([(i, f"News@Example.com src{i % 3}") for i in range(10)],
                                 "msg_uid long, sender string")
    ledger = spark.createDataFrame([(1,), (2,)], "msg_uid long")
    u = unread(msgs.where(sender_matches("sender", "news@EXAMPLE")), ledger)
    assert sorted(r.msg_uid for r in u.collect()) == [0, 3, 4, 5, 6, 7, 8, 9]
    oc = u.withColumn("status", F.when(F.col("msg_uid") % 2 == 0, "sent").otherwise("no_body"))
    after = ledger_after_run(ledger, oc, "r1")
    ids = sorted(r.msg_uid for r in after.collect())
    assert ids == [0, 1, 2, 4, 6, 8]
    # a replay of the same run adds nothing new
    again = ledger_after_run(after.select("msg_uid"), oc, "r2")
    assert again.where(F.col("marked_by") == "r2").count() == 0
