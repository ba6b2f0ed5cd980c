"""Whole forwarded originals: the part tree, nested mails, attachments, headers."""

from email.message import EmailMessage

import pytest

from tidings.operators.render import original_elements
from tidings.plans.digest import RunConfig, run_raw
from tidings.sources.mime import parse_mime, parse_one

PNG = bytes(range(256)) * 3


def _inner() -> EmailMessage:
    m = EmailMessage()
    m["Subject"], m["From"] = "inner", "deep@x"
    m.set_content("inner words")
    m.add_attachment(b"deep bytes", maintype="application", subtype="zip", filename="deep.zip")
    return m


def _outer() -> bytes:
    m = EmailMessage()
    m["Subject"], m["From"], m["X-Tag"] = "outer", "news@x", "kept"
    m.set_content("One sentence here. And one more.")
    m.add_alternative("<p>html</p>", subtype="html")
    m.add_attachment(PNG, maintype="image", subtype="png", filename="résumé.png")
    m.add_attachment(_inner())
    return m.as_bytes()


RAW = {
    1: _outer(),
    2: b"From: news@x\r\nContent-Type: application/pdf; name=\"a.pdf\"\r\nContent-Transfer-Encoding: base64\r\n\r\nJVBERg==\r\n",
    3: b"From: news@x\r\nContent-Type: multipart/report; boundary=b\r\n\r\n--b\r\nContent-Type: message/delivery-status\r\n\r\n"
       b"Reporting-MTA: dns; x\r\n\r\nFinal-Recipient: rfc822; y\r\n\r\n--b--\r\n",
    4: b"From: news@x\r\nContent-Type: multipart/mixed; boundary=b\r\n\r\n--b\r\nContent-Type: text/plain; charset=x-no\r\n"
       b"X-Note: \xfe\r\n\r\nraw \xe9\r\n--b--\r\n",
    5: b"",
    6: None,
    7: b"From: news@x\r\nContent-Type: multipart/mixed; boundary=never\r\n\r\nno part begins here",
}


@pytest.fixture(scope="module")
def elements(spark):
    raw = spark.createDataFrame(list(RAW.items()), "msg_uid long, raw binary")
    m = parse_mime(raw, tree=True)
    return {r.msg_uid: r.e for r in m.select(
        "msg_uid", original_elements("parts", "is_multipart", "tree").alias("e")).collect()}


def test_tree_has_a_node_for_each_part():
    _, _, _, _, parts, tree = parse_one(RAW[1], tree=True)
    assert [n["part_ix"] for n in tree] == [p["part_ix"] for p in parts]
    assert [n["content_type"] for n in tree] == [p["content_type"] for p in parts]
    kinds = [n["content_type"] for n in tree]
    mail = kinds.index("message/rfc822")
    assert tree[0]["parent_ix"] is None and tree[0]["depth"] == 0
    for n in tree[1:]:
        assert tree[n["parent_ix"]]["depth"] == n["depth"] - 1
        assert (n["mail_ix"] == mail) == (n["part_ix"] > mail)
    assert all(n["payload"] is None for n in tree[mail + 1:])      # bytes are kept once


def test_attachment_and_nested_mail_survive(elements):
    e = elements[1]
    assert [x.content_type for x in e] == ["text/html", "text/plain", "text/html", "image/png", "message/rfc822"]
    assert e[1].text == "One sentence here. And one more.\n" and e[1].payload is None
    assert (e[3].filename, bytes(e[3].payload), e[3].text) == ("résumé.png", PNG, None)
    want = parse_one(_inner().as_bytes())
    assert parse_one(bytes(e[4].payload))[1:4] == want[1:4]
    assert [p["content_type"] for p in parse_one(bytes(e[4].payload))[4]] == [p["content_type"] for p in want[4]]
    assert b"deep.zip" in bytes(e[4].payload)


def test_odd_originals(elements):
    assert (elements[2][1].content_type, elements[2][1].filename, bytes(elements[2][1].payload)) == ("application/pdf", "a.pdf", b"%PDF")
    report = bytes(elements[3][1].payload)
    assert b"Reporting-MTA: dns; x" in report and b"Final-Recipient: rfc822; y" in report and len(elements[3]) == 2
    assert elements[4][1].text is None and bytes(elements[4][1].payload) == b"raw \xe9"
    assert len(elements[4][1].headers) == 2
    assert [x.content_type for x in elements[5]] == ["text/html", "text/plain"]
    assert elements[6] is None and bytes(elements[7][1].payload) == b"no part begins here"


def test_headers_reach_the_outbox(spark):
    raw = spark.createDataFrame([(1, "news@x", RAW[1])], "msg_uid long, sender string, raw binary")
    ledger = spark.createDataFrame([], "msg_uid long")
    outbox, _ = run_raw(raw, ledger, RunConfig(sender="news", max_tokens=400, overlap=50, forward=True))
    original = outbox.first().original
    assert bytes(original[3].payload) == PNG
    assert ("Content-Type", "image/png") in [(h.name, h.value) for h in original[3].headers]
    outbox, _ = run_raw(raw, ledger, RunConfig(sender="news", max_tokens=400, overlap=50, forward=False))
    assert outbox.first().original is None
