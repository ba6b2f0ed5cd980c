"""Subscription match (substring equi-join) against brute force."""

import random

from tidings.operators.subscriptions import match_subscriptions


def test_match_equals_brute_force(spark):
    rnd = random.Random(11)
    alphabet = "abAB.@c"
    senders = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 9)))
               for _ in range(60)] + [None]
    patterns = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 4)))
                for _ in range(25)] + ["", "ABABABABABABAB", None]
    msgs = spark.createDataFrame(list(enumerate(senders)), "msg_uid long, sender string")
    subs = spark.createDataFrame([(f"s{i}", p) for i, p in enumerate(patterns)],
                                 "subscription string, sender_pattern string")
    got = sorted((r.msg_uid, r.subscription)
                 for r in match_subscriptions(msgs, subs).collect())
    want = sorted((i, f"s{j}") for i, s in enumerate(senders) if s is not None
                  for j, p in enumerate(patterns)
                  if p is not None and p.lower() in s.lower())
    assert got == want
