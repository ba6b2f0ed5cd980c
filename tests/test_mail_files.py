"""Mail files as a source: mbox archives in splits of any size, .eml folders, runs and polls on them."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tidings.plans.digest import RunConfig, run_raw
from tidings.sources.mail_files import eml_files, mbox_files, mbox_messages, mbox_records, write_mbox
from tidings.streaming.poll import poll

CFG = RunConfig(sender="News", max_tokens=400, overlap=50)
MAILS = [
    ("news@a", b"Message-ID: <1@x>\nSubject: one\n\nFirst. \n>From here on\n>>From there\nFromage\n"),
    ("other@b", b"Subject: two\n\nSecond.\n"),
    ("NEWS@c", b"message-id:\n <3@x>\r\nContent-Type: text/plain; charset=latin-1\r\n\r\ncaf\xe9 \xff.\r\n"),
    ("news@d", b"Message-ID: <4@x>"),
    ("news@e", b"Message-ID: <5@x>\n\n"),
    ("news@f", b"Message-ID: <6@x>\n\n" + b"long line " * 4000 + b"\n"),
]


def archive(path, mails):
    with open(path, "wb") as f:
        f.write(b"".join(b"From %s Thu Jan  1 00:00:00 1970\n%s\n" % (s.encode(), m) for s, m in mails))


@pytest.fixture
def folder(tmp_path):
    archive(tmp_path / "a.mbox", MAILS[:4])
    archive(tmp_path / "b.mbox", MAILS[4:])
    return str(tmp_path)


def rows(df):
    return sorted((r.msg_uid, r.sender, None if r.raw is None else bytes(r.raw).rstrip(b"\r\n")) for r in df.collect())


WANT = sorted([
    ("1@x", "news@a", MAILS[0][1].replace(b">From", b"From").rstrip(b"\n")),
    (hashlib.sha256(b"other@b Thu Jan  1 00:00:00 1970\n" + MAILS[1][1].rstrip(b"\n")).hexdigest(), "other@b",
     MAILS[1][1].rstrip(b"\n")),
    ("3@x", "NEWS@c", MAILS[2][1].rstrip(b"\r\n")), ("4@x", "news@d", None),
    ("5@x", "news@e", MAILS[4][1].rstrip(b"\n")), ("6@x", "news@f", MAILS[5][1].rstrip(b"\n"))])


@pytest.mark.parametrize("split", ["16", "61", "4096", "134217728"])
def test_records_do_not_depend_on_the_splits(spark, folder, split):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k, v in zip(before, (split, "0")):
        spark.conf.set(k, v)
    try:
        df = mbox_files(spark, folder)
        if split == "4096":
            assert df.rdd.getNumPartitions() > 5
        assert rows(df) == WANT
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_run_on_an_archive(spark, folder):
    ledger = spark.createDataFrame([("5@x",)], "msg_uid string")
    outbox, outcomes = run_raw(mbox_files(spark, folder), ledger, CFG)
    got = {r.msg_uid: r.status for r in outcomes.collect()}
    assert got == {"1@x": "sent", "3@x": "sent", "4@x": "fetch_failed", "6@x": "sent"}
    html = {r.msg_uid: r.html for r in outbox.collect()}
    assert "From here on" in html["1@x"] and "café ÿ" in html["3@x"]


def test_only_chosen_senders_are_parsed(spark, folder):
    plan = run_raw(mbox_files(spark, folder), spark.createDataFrame([], "msg_uid string"), CFG)[1]
    text = plan._jdf.queryExecution().toString()
    assert plan.count() == 5 and "MapInArrow" not in text.split("Physical Plan")[-1]   # parsed while staging
    chosen = mbox_files(spark, folder).where(F.contains(F.lower("sender"), F.lit("news")))
    optimized = chosen.select("raw")._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in optimized.splitlines() if "Filter" in line]
    assert filters and not any("decode" in f for f in filters)   # the filter needs the envelope line alone


def test_written_archives_read_back(spark, tmp_path):
    raw = [(7, "news@a", MAILS[0][1]), (8, "a b@c", None), (9, "x@y", b"Subject: s\n\n>From q\nFrom r\n\xff")]
    path = str(tmp_path / "out")
    write_mbox(spark.createDataFrame(raw, "msg_uid long, sender string, raw binary").repartition(2), path)
    got = {r.msg_uid: r for r in mbox_files(spark, path, glob="*.txt").collect()}
    assert {k: r.sender for k, r in got.items()} == {"7": "news@a", "8": "a_b@c", "9": "x@y"}
    assert got["8"].raw is None
    for uid, _, mail in (raw[0], raw[2]):
        assert bytes(got[str(uid)].raw).rstrip(b"\n") == b"Message-ID: <%d>\n" % uid + mail.rstrip(b"\n")


def test_eml_files_have_an_envelope_sender(spark, tmp_path):
    for name, mail in {"a": b"Return-Path: <news@a>\r\nFrom: Else <else@b>\r\n\r\nHello there.",
                       "b": b"Subject: From: no@x\nFrom: \"The News\" <News@b>\n\nHello again.",
                       "c": b"From: else@c\n\nFrom: news@c in the body"}.items():
        (tmp_path / f"{name}.eml").write_bytes(mail)
    raw = eml_files(spark, str(tmp_path))
    assert {r.msg_uid: r.sender for r in raw.collect()} == {"a": "news@a", "b": "News@b", "c": "else@c"}
    _, outcomes = run_raw(raw, spark.createDataFrame([], "msg_uid string"), CFG)
    assert {r.msg_uid: r.status for r in outcomes.collect()} == {"a": "sent", "b": "sent"}


def test_poll_on_archives(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    os.makedirs(src)
    archive(os.path.join(src, "a"), MAILS[:4])

    def once():
        return poll(spark, lambda s: mbox_records(s, src, stream=True), out, ck, CFG, to_messages=mbox_messages, plan=run_raw)
    store = once()
    assert {r.msg_uid: (r.status, r.attempts) for r in store.table("outcomes").collect()} == {
        "1@x": ("sent", 1), "3@x": ("sent", 1), "4@x": ("fetch_failed", 1)}
    # the broken fetch arrives whole later on, beside new mail
    archive(os.path.join(src, "b"), [("news@d", MAILS[3][1] + b"\n\nNow whole.\n"), *MAILS[4:]])
    got = {r.msg_uid: (r.status, r.attempts) for r in once().table("outcomes").collect() if r.msg_uid > "4" or r.attempts > 1}
    assert got == {"4@x": ("sent", 2), "5@x": ("no_body", 1), "6@x": ("sent", 1)}
