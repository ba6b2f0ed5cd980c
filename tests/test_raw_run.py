"""A run on raw mail: keys of any type, failed fetches, send results."""

import pytest

from tidings.operators.outcomes import confirm_sends
from tidings.plans.digest import RunConfig, run_raw

CFG = RunConfig(sender="News", max_tokens=400, overlap=50)
MAIL = b"From: other@x\r\nSubject: hello\r\n\r\nOne sentence here. And one more."


@pytest.mark.parametrize("kind, uids", [("int", (1, 2, 3, 4)), ("bigint", (1, 2, 3, 4)),
                                        ("string", ("a", "b", "c", "d"))])
def test_key_types_and_failed_fetch(spark, kind, uids):
    rows = [(uids[0], "news@x", MAIL), (uids[1], "NEWS@y", None), (uids[2], "news@z", MAIL),
            (uids[3], "else@x", MAIL)]
    raw = spark.createDataFrame(rows, f"msg_uid {kind}, sender string, raw binary")
    ledger = spark.createDataFrame([(uids[2],)], f"msg_uid {kind}")
    outbox, outcomes = run_raw(raw, ledger, CFG)
    assert outcomes.schema["msg_uid"].dataType.simpleString() == kind
    assert {r.msg_uid: (r.status, r.sender) for r in outcomes.collect()} == {
        uids[0]: ("sent", "news@x"), uids[1]: ("fetch_failed", "NEWS@y")}
    assert [r.msg_uid for r in outbox.collect()] == [uids[0]]


def test_send_results(spark):
    outcomes = spark.createDataFrame(
        [(1, "sent"), (2, "sent"), (3, "sent"), (4, "sent"), (5, "no_body")], "msg_uid int, status string")
    sends = spark.createDataFrame([(1, True, None), (2, False, None), (3, False, "refused"), (5, True, None),
                                   (1, False, "first try")],
                                  "msg_uid int, delivered boolean, send_error string")
    got = {r.msg_uid: r.status for r in confirm_sends(outcomes, sends).collect()}
    assert got == {1: "sent", 2: "send_failed", 3: "send_error", 4: "send_failed", 5: "no_body"}
