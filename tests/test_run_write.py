"""A written batch run: outbox, outcomes and ledger show together; the next run over the
store sends nothing again (K1-K4)."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.operators.deliver import through, to_outbox
from tidings.plans.digest import RunConfig, commit_run, run_and_write
from tidings.sources import tables as tables
from tidings.sources.mailbox import mail_view
from tidings.sources.run_store import Attempt, Files, RunStore

CFG = RunConfig(sender="SRC1", max_tokens=400, overlap=50)
MESSAGE = ("msg_uid long, sender string, subject string, is_multipart boolean, "
           "parts array<struct<part_ix:int,content_type:string,disposition:string,charset:string,text:string,decode_ok:boolean>>")


def messages(spark, ids):
    return spark.createDataFrame([(i, "src1", f"s{i}", False, [(0, "text/plain", None, "utf-8", f"Text of {i}. And more.", True)])
                                  for i in ids], MESSAGE)


def none_read(spark):
    return spark.createDataFrame([], "msg_uid long")


def visible(store):
    """Ids by table of what published runs show."""
    out = {n: sorted(r[0] for r in t.select("msg_uid").collect()) if (t := store.table(n)) is not None else []
           for n in ("outbox", "outcomes")}
    return out | {"ledger": sorted(r.msg_uid for r in store.ledger(T.LongType()).collect())}


def test_run_write_then_rerun(spark, sf_small, tmp_path):
    msgs, before = mail_view(spark, sf_small), tables.read_ledger(spark, sf_small)
    store = run_and_write(msgs, before, CFG, str(tmp_path), "r1")
    outcomes = store.table("outcomes")
    n_sent = outcomes.where("status = 'sent'").count()
    assert n_sent > 0 and store.table("outbox").count() == n_sent == store.ledger(T.LongType()).count()
    run_and_write(msgs, before, CFG, str(tmp_path), "r2")
    assert store.table("outbox").where("run_id = 'r2'").count() == 0
    left = store.table("outcomes").where("run_id = 'r2'")
    assert left.where("status = 'sent'").count() == 0
    assert left.count() == outcomes.count() - n_sent   # the failures come back


def test_empty_source_flows_through(spark, sf_small):
    from tidings.plans.digest import run_digest
    msgs = mail_view(spark, sf_small).limit(0)
    outbox, outcomes = run_digest(msgs, tables.read_ledger(spark, sf_small), CFG)
    assert outbox.count() == 0 and outcomes.count() == 0


def test_a_published_run_is_final(spark, tmp_path):
    store = run_and_write(messages(spark, range(3)), none_read(spark), CFG, str(tmp_path), "r1", plan=plain_plan)
    want = visible(store)
    run_and_write(messages(spark, range(9)), none_read(spark), CFG, str(tmp_path), "r1", plan=plain_plan)
    assert visible(store) == want == dict.fromkeys(("outbox", "outcomes", "ledger"), [0, 1, 2])
    with pytest.raises(FileExistsError):
        store.begin("r1").publish()


class Killed(BaseException):
    pass


def plain_plan(messages, ledger, cfg, summarizer, **options):
    """A run that sends every unread message as it is."""
    new = messages.join(ledger, "msg_uid", "left_anti")
    return new.select("msg_uid", F.lit("x").alias("html")), new.select("msg_uid", F.lit("sent").alias("status"))


@pytest.mark.parametrize("step", range(8))
def test_a_run_killed_between_any_two_writes_shows_all_or_nothing(spark, tmp_path, monkeypatch, step):
    """Steps: outbox, delivery, sends, outcomes, ledger, retry, manifest file, its renaming."""
    sent, at = [], iter(range(100))

    def dies():
        if next(at) == step:
            raise Killed

    def deliver(outbox):
        dies()
        sent.extend(r.msg_uid for r in outbox.select("msg_uid").collect())
        return to_outbox(outbox)

    def write(self, name, df, plain=Attempt.write):
        dies()
        return plain(self, name, df)

    def publish(self, name, content):
        dies()
        part = self.path(f"{os.path.dirname(name)}/.x.part")
        stream = self.fs.create(part, True)
        stream.write(content.encode())
        stream.close()
        dies()
        assert self.fs.rename(part, self.path(name))

    msgs = spark.createDataFrame([(i,) for i in range(4)], "msg_uid long")
    store = run_and_write(msgs.select((F.col("msg_uid") + 100).alias("msg_uid")).where("msg_uid = 100"), none_read(spark), CFG,
                          str(tmp_path), "r0", plan=plain_plan)
    with monkeypatch.context() as m:
        m.setattr(Attempt, "write", write)
        m.setattr(Files, "publish", publish)
        with pytest.raises(Killed):
            commit_run(store, "r1", msgs, none_read(spark), CFG, None, deliver, plain_plan, keep=msgs)
    assert visible(store) == dict.fromkeys(("outbox", "outcomes", "ledger"), [100])
    assert not store.published("r1")
    again = []

    def once(outbox):
        again.extend(r.msg_uid for r in outbox.select("msg_uid").collect())
        return to_outbox(outbox)
    assert commit_run(store, "r1", msgs, none_read(spark), CFG, None, once, plain_plan, keep=msgs)
    assert visible(store) == dict.fromkeys(("outbox", "outcomes", "ledger"), [0, 1, 2, 3, 100])
    # what finished send results confirm is not sent again
    assert sorted(again) == ([] if step > 2 else [0, 1, 2, 3])
    assert store.table("retry").count() == 0


def test_only_confirmed_deliveries_are_marked(spark, tmp_path):
    def send(message):
        if message["msg_uid"] % 3 == 1:
            raise ConnectionError("gone")
        return message["msg_uid"] % 3 != 2 or "<br>" not in message["html"]
    store = run_and_write(messages(spark, range(9)), none_read(spark), CFG, str(tmp_path), "r1", deliver=through(send))
    got = {r.msg_uid: r.status for r in store.table("outcomes").collect()}
    assert got == {i: ["sent", "send_error", "send_failed"][i % 3] for i in range(9)}
    assert visible(store)["ledger"] == [0, 3, 6] and visible(store)["outbox"] == list(range(9))
    errors = {r.msg_uid: r.send_error for r in store.table("sends").collect()}
    assert errors[1] == "ConnectionError: gone" and errors[2] is None
    run_and_write(messages(spark, range(9)), none_read(spark), CFG, str(tmp_path), "r2")
    assert visible(store)["ledger"] == list(range(9))


def test_ledger_reads_few_files_after_many_runs(spark, tmp_path, monkeypatch):
    from tidings.operators.state import unread
    from tidings.sources import run_store
    monkeypatch.setattr(run_store, "ROWS_PER_BUCKET", 64)
    store = RunStore(spark, str(tmp_path), compact_every=8)
    every = []
    for r in range(200):
        ids = [r * 10 + i for i in range(5)]
        every += ids
        a = store.begin(f"run-{r:04d}")
        a.write("ledger", spark.createDataFrame([(i,) for i in ids], "msg_uid long").coalesce(1))
        a.publish()
        store.compact_if_due()
    ledger = store.ledger(T.LongType())
    assert sorted(r.msg_uid for r in ledger.collect()) == every
    _, segments = store.epoch()
    assert sum(s["rows"] for s in segments) + 5 * (200 % 8) == len(every)
    assert len(segments) <= 4
    limit = sum(s["buckets"] for s in segments) + 8
    files = len(ledger.inputFiles())
    assert files <= limit < 60
    new = spark.createDataFrame([(15,), (1001,), (1007,), (1999,), (5000,)], "msg_uid long")
    about = store.ledger(T.LongType(), new)
    assert sorted(r.msg_uid for r in unread(new, about).collect()) == [15, 1007, 1999, 5000]
    scanned = about.select(F.input_file_name().alias("f")).where("f like '%bucket=%'").distinct().count()
    assert scanned <= 5 * len(segments) < sum(s["buckets"] for s in segments)
