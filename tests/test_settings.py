"""Settings as a table."""

import json
import os
import tempfile

import pytest

from tidings.operators import settings as S

VALID = {
    "spare_key": "blue",
    "gmail_user": "reader@mail.example",
    "gmail_app_pass": "p-41",
    "openai_api_key": "k-77",
    "target_email": "digest@mail.example",
    "stratechery_sender_email": "letters@news.example",
    "count": "7",
    "max_tokens_per_chunk": "300",
    "chunk_overlap_tokens": None,
    "forward_original_email": False,
}


@pytest.fixture(scope="module")
def raw(spark):
    d = tempfile.mkdtemp(prefix="tidings-settings-")
    files = {
        "good": json.dumps(VALID),
        "flag_text": json.dumps({**VALID, "forward_original_email": "TRUE",
                                 "smtp_port": 587, "gmail_user": ""}),
        "flag_space": json.dumps({**VALID, "forward_original_email": " true"}),
        "missing": json.dumps({"colour": "red", "gmail_user": None}),
        "bad_int": json.dumps({**VALID, "smtp_port": "abc"}),
        "bad_window": json.dumps({**VALID, "max_tokens_per_chunk": "0"}),
        "broken": "{not json",
        "nested": json.dumps({**VALID, "extra": {"a": 1, "gmail_user": "inner"}}),
    }
    for name, text in files.items():
        with open(os.path.join(d, f"{name}.json"), "w") as f:
            f.write(text)
    return S.read_settings_files(spark, d)


def test_resolve_defaults_casts_flags(raw):
    r = {x.subscription: x for x in S.resolve(S.settings_long(raw)).collect()}
    g = r["good"]
    assert g.gmail_user == "reader@mail.example"
    assert g.max_tokens_per_chunk == 300
    assert g.chunk_overlap_tokens == 200          # JSON null takes the default
    assert g.smtp_port == 465 and g.imap_host == "imap.gmail.com"
    assert g.forward_original_email is False      # JSON false
    assert r["flag_text"].forward_original_email is True   # 'TRUE', any case
    assert r["flag_text"].smtp_port == 587                  # JSON number
    assert r["flag_text"].gmail_user == ""                  # empty string kept
    assert r["flag_space"].forward_original_email is False  # untrimmed
    assert "broken" not in r


def test_rejects(raw):
    got = {}
    for x in S.rejects(raw).collect():
        got.setdefault(x.subscription, set()).add(x.reason)
    assert got["broken"] == {"bad_json"}
    assert got["missing"] == {f"missing:{k}" for k in S.REQUIRED_KEYS}
    assert got["bad_int"] == {"bad_int:smtp_port"}
    assert got["bad_window"] == {"bad_window"}
    assert "good" not in got and "flag_text" not in got


def test_masking(raw):
    m = {(x.subscription, x.key): x.shown for x in S.masked(S.settings_long(raw)).collect()}
    assert m[("good", "gmail_app_pass")] == "******"
    assert m[("good", "openai_api_key")] == "******"
    assert m[("good", "spare_key")] == "******"             # contains 'key'
    assert m[("good", "gmail_user")] == "reader@mail.example"
    assert m[("good", "max_tokens_per_chunk")] == "******"   # a string under a 'token' key
    assert m[("flag_text", "smtp_port")] == "587"


def test_settings_drive_a_run(spark, raw, sf_small):
    from pyspark.sql import functions as F

    from tidings.plans.digest import config_from_settings, run_digest
    from tidings.sources import tables as T
    from tidings.streaming.poll import documents_as_messages
    rows = {r.subscription: r for r in S.runnable(raw).collect()}
    assert set(rows) == {"good", "flag_text", "flag_space", "nested"}
    cfg = config_from_settings(rows["good"].asDict())
    assert cfg.max_tokens == 300 and cfg.overlap == 200 and cfg.forward is False
    msgs = documents_as_messages(T.documents(spark, sf_small)).withColumn(
        "sender", F.lit("Letters <LETTERS@news.example>"))
    outbox, outcomes = run_digest(msgs, T.read_ledger(spark, sf_small), cfg)
    n_unread = T.documents(spark, sf_small).join(
        T.read_ledger(spark, sf_small).withColumnRenamed("msg_uid", "doc_id"),
        "doc_id", "left_anti").count()
    assert outcomes.count() == n_unread
    ob = outbox.collect()
    assert len(ob) == n_unread and all(r.original is None for r in ob)
    assert all(r.to_addr == "digest@mail.example" for r in ob)


def test_nested_object_with_an_equal_key_keeps_the_outer_value(raw):
    r = {x.subscription: x for x in S.resolve(S.settings_long(raw)).collect()}
    assert r["nested"].gmail_user == "reader@mail.example"
    assert r["good"].gmail_user == "reader@mail.example"
