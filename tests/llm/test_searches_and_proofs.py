"""Exact top k, fill-in-middle and the Merkle manifest against brute force."""

import random

import brute
import numpy as np
import pytest
from test_operators import ODD, SCHEMA, none, odd, text_of, texts  # noqa: F401  (fixtures)

from tidings.llm import fim, merkle, topk
from tidings.sources.tables import table

VECTORS = "vec_id long, embedding array<double>, `row` long, code string, `a.b` int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2) for i, v in rows], VECTORS).repartition(3)


def best(spark, rows, p):
    got = topk.top_k(vectors(spark, rows), p).collect()
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in got), key=str)


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (0, [0.5, -0.25]), (50, [1.0, 2.0]), (1, None), (2, [1.0, None]), (100, [nan, 1.0]),
            (150, [inf, 0.0]), (3, []), (200, []), (4, [0.001, -0.001, 7.5]), (None, [1.0, 1.0]), (None, [1.0, 1.0]),
            (-50, [-1.0, 0.5]), (5, [1.0, 1.0]), (6, [1.0, 1.0]), (2 ** 62 + 7, [1.0, 1.0]), (2 ** 62 + 5, [1.0, 1.0])]
    assert best(spark, rows, topk.Params(block=4)) == brute.top_k(rows)
    huge = [*rows, (250, [1e30, -1e25]), (7, [1e30, 3.0]), (300, [-1e18, 1e18]), (8, [1e308, 0.0]), (9, [3e13 + 0.5, 1.0])]
    assert best(spark, huge, topk.Params(block=4, query_block=3, sample=6)) == brute.top_k(huge)


@pytest.mark.parametrize("spread", [0.0, 0.02, 1.0])
def test_top_k_with_ties_in_small_blocks(spark, spread):
    rng = np.random.default_rng(3)
    centers = rng.normal(0, 0.3, (6, 8))
    rows = [(int(i), [float(x) for x in np.round(centers[i % 6] + spread * rng.normal(0, 0.3, 8), 2)])
            for i in rng.permutation(600)]
    p = topk.Params(every=20, block=90, query_block=11, pivots=5, sample=40, slice=4, step=3)
    assert best(spark, rows, p) == brute.top_k(rows, every=20)
    few = rows[:3]
    assert best(spark, few, topk.Params(every=1)) == brute.top_k(few, every=1)


def test_top_k_skips_what_the_pivots_rule_out(monkeypatch):
    import pandas as pd
    rng, p = np.random.default_rng(5), topk.Params(step=4)
    x = np.floor(256 * (np.repeat(rng.normal(0, 1, (20, 6)), 50, 0) + 0.01 * rng.normal(0, 1, (1000, 6))))
    pivots = topk.choose_pivots(list(x[::7]), p.pivots)
    away = topk.distances(x, pivots)
    assert np.allclose(away[:, 3], np.linalg.norm(x - pivots[3], axis=1))
    frame = pd.DataFrame({"row": range(1000), "id": range(1000), "no_id": False, "code": [v.tobytes() for v in x],
                          "away": [v.tobytes() for v in away], "floor_score": topk.LONG.min})
    evaluated, plain = [], topk.exact
    monkeypatch.setattr(topk, "exact", lambda a, b: evaluated.append(len(b)) or plain(a, b))
    found = topk.search(topk.Side(frame[:100]), topk.Side(frame), p)
    scores = x[:100] @ x.T
    for i in range(100):
        scores[i, i] = -np.inf
    want = {(i, int(j), int(scores[i, j])) for i in range(100) for j in sorted(range(1000), key=lambda j: (-scores[i, j], j))[:5]}
    assert set(found) == want
    assert sum(evaluated) < 0.5 * 100 * 1000


def test_fill_in_middle(spark, odd):
    more = [(20, "a<P>b", *[None] * 3), (21, " <", *[None] * 3), (22, "x\x00y \x0b\x85 z w ", *[None] * 3)]
    more += [(100 + i, f" a{i}  b\né{i}\tc <S d中 ", *[None] * 3) for i in range(60)]
    rows = [(r[0], text_of(r)) for r in ODD] + [(r[0], r[1]) for r in more]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([r[:2] for r in more], "doc_id long, text string"))
    done = fim.fill_in_middle(docs)
    got = done.withColumn("back", fim.restored()).collect()
    assert sorted(map(str, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got))) == sorted(
        str((d, *brute.fim(d, t))) for d, t in rows)
    assert sorted(str((r.doc_id, r.back)) for r in got) == sorted(str((d, t)) for d, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_in_slices(spark, monkeypatch):
    import pyarrow as pa
    rng = random.Random(8)
    text = ["".join(rng.choice([" ", "\n", "a", "é", "\U0001f600", "<", "P", ">"]) for _ in range(rng.randrange(40)))
            for _ in range(400)]
    h = [[rng.randrange(2 ** 32) for _ in text] for _ in range(4)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(text), *map(pa.array, h)],
                                       ["doc_id", "text", "h1", "h2", "h3", "h4"])
    whole = fim.transformed(batch, fim.Params()).to_pylist()
    assert whole == [r for b in fim.slices(batch, 100) for r in fim.transformed(b, fim.Params()).to_pylist()]
    for t, a, b, r in zip(text, h[0], h[1], whole):
        u = brute.UNIT.findall(t)
        lo, hi = sorted((a % (len(u) + 1), b % (len(u) + 1)))
        assert r["n"] == len(u)
        if r["form"] != "plain":
            assert (r["prefix_chars"], r["middle_chars"]) == (len("".join(u[:lo])), len("".join(u[lo:hi])))


def merkle_rows(rows):
    return [(r[0], r[3], r[2], r[4], r[1]) for r in rows]


def proved(docs):
    return sorted(map(str, map(tuple, merkle.proofs(docs).collect())))


def test_merkle_of_odd_rows(odd):
    assert proved(odd) == sorted(map(str, brute.merkle(merkle_rows(ODD))))


def test_merkle_of_documents_in_small_partitions(spark, sf_small, texts, monkeypatch):
    monkeypatch.setattr(merkle, "PART", 13)
    monkeypatch.setattr(merkle, "PER_TASK", 30)
    docs = table(spark, sf_small, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = proved(docs)
    assert got == sorted(map(str, brute.merkle(rows)))
    assert any("False" in r for r in got) and any("True" in r for r in got)


@pytest.mark.parametrize("sizes", [[700], [1], [1] * 40, [300, 1, 17, 16, 273, 2]])
def test_merkle_of_sources_of_many_sizes(spark, monkeypatch, sizes):
    monkeypatch.setattr(merkle, "PART", 100)
    rows = [(100 * i + 7 * s, f"s{s:03}", None, i, f"Text {i}") for s, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert proved(docs) == sorted(map(str, brute.merkle(rows)))


def test_merkle_fetches_the_minimal_union(spark, monkeypatch):
    monkeypatch.setattr(merkle, "PART", 90)
    sizes = [400, 3, 290]
    rows = [(i, f"s{s}", "en", i, "t") for s, n in enumerate(sizes) for i in range(n)]
    m = merkle.manifest(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))
    got = {}
    for r in merkle.requests(m).collect():
        got.setdefault(r.part, []).append((r.tree, r.level, r.idx))
    leaves = {}
    for r in m.leaves.collect():
        leaves.setdefault(r["rank"] // 90, set()).add((r.tree, r.pos))

    def lacks(known, n, tree):
        """What the paths of the known nodes need and cannot derive, level by level."""
        out, level = set(), 0
        while n > 1:
            need = {j for i in known for j in range(i // 16 * 16, min(i // 16 * 16 + 16, n))}
            out |= {(tree, level, j) for j in need - known}
            known, n, level = {i // 16 for i in known}, -(-n // 16), level + 1
        return out

    for part, own in leaves.items():
        want = lacks({t for t, _ in own}, len(sizes), merkle.TOP)
        for t in {t for t, _ in own}:
            want |= lacks({i for u, i in own if u == t}, sizes[t], t)
        assert sorted(got.get(part, [])) == sorted(want)


@pytest.mark.parametrize("op", [fim.digest, merkle.proofs])
def test_no_rows(op, none):
    assert op(none).count() == 0


def test_no_vectors(spark):
    assert topk.top_k(spark.createDataFrame([], VECTORS)).count() == 0
    assert topk.top_k(vectors(spark, [(1, [1.0]), (50, None)])).count() == 0
