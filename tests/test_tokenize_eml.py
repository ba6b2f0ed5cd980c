"""Plug-in tokenizers (T6) and the ``*.eml`` file source."""

import os
import tempfile
from email.message import EmailMessage

import pytest
from pyspark.sql import functions as F

from tidings.operators.body import select_body
from tidings.operators.tokenize import (ByteTokenizer, DisallowSpecial, TokenizerError,
                                        WordTokenizer,
                                        get_tokenizer, tokenizer_windows, windows_py)
from tidings.sources.mail_files import eml_files
from tidings.sources.mime import parse_mime


def test_word_tokenizer_windows_equal_reference_example():
    n, w = windows_py("one two three four five six seven eight nine ten",
                      WordTokenizer(), 4, 1)
    assert n == 10 and [x[3] for x in w] == ["one two three four", "four five six seven",
                                             "seven eight nine ten"]


def test_byte_tokenizer_cuts_inside_a_character():
    n, w = windows_py("aé" * 5, ByteTokenizer(), 4, 0)
    assert n == 15
    assert any("�" in x[3] for x in w)


def test_unknown_tokenizer_fails_on_driver():
    with pytest.raises(TokenizerError):
        get_tokenizer("no-such-encoding")


def test_tokenizer_error_is_per_row(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "x <|endoftext|> y"), (3, "")],
                               "id long, t string")
    got = {r.id: r for r in tokenizer_windows(df, "id", "t", 4, 1,
                                                  DisallowSpecial(WordTokenizer())).collect()}
    assert len(got[1].chunks) == 2 and got[1].error_kind is None
    assert got[2].chunks is None and got[2].error_kind == "tokenizer"
    assert got[3].chunks == [] and got[3].n_tokens == 0


def test_eml_files_parse(spark):
    d = tempfile.mkdtemp(prefix="tidings-eml-")
    for uid, body in ((7, "first mail"), (8, "second mail")):
        m = EmailMessage()
        m["Subject"] = f"mail {uid}"
        m["From"] = "News <news@example.com>"
        m.set_content(body)
        with open(os.path.join(d, f"{uid}.eml"), "wb") as f:
            f.write(m.as_bytes())
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("not a mail")
    raw = eml_files(spark, d).select(F.col("msg_uid").cast("long").alias("msg_uid"), "raw")
    got = {r.msg_uid: r for r in select_body(parse_mime(raw)).collect()}
    assert sorted(got) == [7, 8]
    assert got[7].body == "first mail" and got[8].subject == "mail 8"


def test_tokenizer_error_is_a_message_outcome(spark, sf_small):
    from tidings.plans.digest import RunConfig, run_digest
    from tidings.sources import tables as T
    from tidings.streaming.poll import documents_as_messages
    docs = T.documents(spark, sf_small).withColumn(
        "text", F.when(F.col("doc_id") % 7 == 0,
                       F.concat("text", F.lit(" <|endoftext|>"))).otherwise(F.col("text")))
    msgs = documents_as_messages(docs)
    ledger = spark.createDataFrame([], "msg_uid long")
    plug = RunConfig(sender="src", max_tokens=400, overlap=50,
                     tokenizer=DisallowSpecial(WordTokenizer()))
    _, oc = run_digest(msgs, ledger, plug)
    got = {r.msg_uid: r for r in oc.collect()}
    assert {u for u, r in got.items() if r.status == "tokenizer_error"} == \
        {u for u in got if u % 7 == 0}
    # where it can encode, the plug-in word path cuts the built-in windows
    _, oc2 = run_digest(msgs, ledger, RunConfig(sender="src", max_tokens=400, overlap=50))
    for r in oc2.collect():
        if r.msg_uid % 7:
            assert (r.n_chunks, r.n_tokens, r.status) == \
                (got[r.msg_uid].n_chunks, got[r.msg_uid].n_tokens, got[r.msg_uid].status)
    with pytest.raises(TokenizerError):
        run_digest(msgs, ledger, RunConfig(sender="src", tokenizer="no-such-encoding"))


def test_mail_is_parsed_in_slices():
    import pyarrow as pa

    from tidings.session import SLICE_BYTES, slices
    from tidings.sources.mime import _parser
    raws = [b"Subject: s%d\r\n\r\n" % i + b"x" * size for i, size in enumerate([1 << 20] * 11 + [9 << 20] + [10] * 5)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(raws))), pa.array(raws, pa.binary()), pa.array([None] * len(raws), pa.string())],
                                       names=["msg_uid", "raw", "sender"])
    for tree in (False, True):
        out = list(_parser(tree)([batch, batch.slice(0, 0)]))
        assert [u for b in out for u in b.column("msg_uid").to_pylist()] == list(range(len(raws)))
        assert [s for b in out for s in b.column("subject").to_pylist()] == [f"s{i}" for i in range(len(raws) - 1)] + [None]
        # no more than a slice's mail is held as objects, but for a mail that is larger alone
        assert all(b.num_rows <= 1 or b.nbytes <= 1.1 * SLICE_BYTES for b in out) and len(out) > 4
    assert [b.num_rows for b in slices(batch.slice(0, 0))] == [0]
