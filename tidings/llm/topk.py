"""Exact top-k inner products by pivot-table elimination.

A component x becomes floor(256 * x). A pivot table is computed once and
written: each vector's distances to ``pivots`` pivots. For a query q and a
candidate x the largest |d(q, p) - d(x, p)| over the pivots p is a lower bound
of their distance, hence an upper bound of their inner product,
(|q|^2 + |x|^2 - bound^2) / 2. Candidates are evaluated in the order of that
bound until it falls below the k-th best score met, which is where the search
is exact. A first threshold for each query is its k-th best score in a bounded
sample of the rows (they are candidates themselves), so a block of candidates that
holds nothing better ends early and sends nothing on.

Queries and candidates are hashed into blocks of about ``query_block`` and
``block`` rows; each pair of blocks is one group, so neither side is ever
whole in one place. The k best of all blocks are ranked by a window that keeps
k rows a query before its shuffle.

Scores are exact: products are summed in float64 while all sums stay below
2^53, and as Python integers beyond it (then without elimination; scores outside
the range of a long come out as its ends).

Defined cases: vectors that are null or hold null or non-finite components
(256 * x included) take no part. Rows are told apart by row, not id: a repeated row is a
candidate of its copy. Null ids are candidates, come last in ties, and are no
queries. Vectors of unlike length are compared as if zeros filled up the
shorter one, an empty vector scores 0. Equal scores go to the smaller vec_id. Long
vectors are only ever held a block at a time. Other columns, whatever their names, are ignored.
An empty table gives no rows; with fewer candidates than k all are returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.common import cut
from tidings.session import ship_package

LONG = np.iinfo(np.int64)


@dataclass(frozen=True)
class Params:
    k: int = 5
    every: int = 50            # queries: rows whose vec_id this divides
    pivots: int = 32
    sample: int = 2048         # bound of the sample that gives pivots and first thresholds
    block: int = 2048          # candidates of a block, about
    query_block: int = 4096    # queries of a block, about
    slice: int = 64            # queries whose bounds are held at once
    step: int = 64             # candidates evaluated first; each further step doubles


def coded(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """(row, id, no_id, code) of the rows that take part, cut, so that ``row`` stays. A null id
    is 0 with ``no_id``, since a null would turn pandas' longs into doubles."""
    big = F.transform(F.col(vec).cast("array<double>"), lambda x: 256 * x)
    finite = F.forall(big, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    # floor() gives a long; beyond 2^52 a double is a whole number already
    code = F.transform(big, lambda x: F.when(F.abs(x) < 2.0 ** 52, F.floor(x).cast("double")).otherwise(x))
    return cut(vectors.where(F.coalesce(finite, F.lit(False)))
               .select(F.monotonically_increasing_id().alias("row"),
                       F.coalesce(F.col("vec_id").cast("long"), F.lit(0)).alias("id"),
                       F.col("vec_id").isNull().alias("no_id"), code.alias("code")))


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b`` over their common length, as longs."""
    m = min(a.shape[1], b.shape[1])
    a, b = a[:, :m], b[:, :m]
    if not m or _top(a) * _top(b) * m < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in r] for r in t], dtype=object).reshape(t.shape) for t in (a, b)]
    return np.clip(whole[0] @ whole[1].T, LONG.min, LONG.max).astype(np.int64)


def _top(a: np.ndarray) -> float:
    return float(np.abs(a).max(initial=0))


def distances(x: np.ndarray, pivots: list[np.ndarray]) -> np.ndarray:
    """Distances of the rows of ``x`` to the pivots."""
    out = np.empty((len(x), len(pivots)))
    for i, p in enumerate(pivots):
        m = min(x.shape[1], len(p))
        out[:, i] = np.sqrt(((x[:, :m] - p[:m]) ** 2).sum(1) + (x[:, m:] ** 2).sum(1) + (p[m:] ** 2).sum())
    return out


def choose_pivots(sample: list[np.ndarray], n: int) -> list[np.ndarray]:
    """Each next pivot is the sample's vector farthest from those chosen (the first of equals)."""
    if not sample:
        return []
    chosen, away = [sample[0]], np.full(len(sample), np.inf)
    by_size = _by_length(sample)
    while len(chosen) < min(n, len(sample)):
        for at, x in by_size:
            away[at] = np.minimum(away[at], distances(x, chosen[-1:])[:, 0])
        chosen.append(sample[int(away.argmax())])
    return chosen


def _by_length(vectors: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) for each length."""
    sizes = np.array([len(v) for v in vectors], np.int64)
    return [(at, np.stack([vectors[i] for i in at]).reshape(len(at), n))
            for n in np.unique(sizes) for at in [np.flatnonzero(sizes == n)]]


def sample_of(rows: DataFrame, count: int, p: Params) -> list[tuple[int, np.ndarray]]:
    """At most ``p.sample`` (row, vector), in the order of a hash of the row."""
    h = F.pmod(F.xxhash64("row"), F.lit(1 << 32))
    near = rows.where(h < int(min(1.0, 2 * p.sample / max(count, 1)) * (1 << 32)))
    return [(r.row, np.asarray(r.code, float)) for r in near.orderBy(h, "row").limit(p.sample).collect()]


def pivot_table(rows: DataFrame, sample: list[tuple[int, np.ndarray]], p: Params) -> DataFrame:
    """(row, id, no_id, code, away, floor_score), cut: vectors and distances to the pivots as
    packed doubles, and a score that k other rows reach (the least long, if fewer do; for queries only)."""
    ship_package(rows.sparkSession)
    held = rows.sparkSession.sparkContext.broadcast(sample)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = [v for _, v in held.value]
        ids = np.array([r for r, _ in held.value], np.int64)
        pivots, known = choose_pivots(vectors, p.pivots), _by_length(vectors)
        for b in batches:
            codes = [np.asarray(c, float) for c in b["code"]]
            away, least = [b""] * len(b), np.full(len(b), LONG.min)
            row, asks = b["row"].to_numpy(), b["is_query"].to_numpy()
            for at, x in _by_length(codes):
                for i, d in zip(at, distances(x, pivots)):
                    away[i] = d.tobytes()
            for i in np.flatnonzero(asks):
                scores = np.concatenate([exact(codes[i][None], x)[0][ids[at] != row[i]] for at, x in known])
                if len(scores) >= p.k:
                    least[i] = np.partition(scores, -p.k)[-p.k]
            yield b.drop(columns="code").assign(code=[c.tobytes() for c in codes], away=away, floor_score=least)

    return cut(rows.withColumn("is_query", is_query(p)).mapInPandas(
        run, "row long, id long, no_id boolean, is_query boolean, code binary, away binary, floor_score long"))


def is_query(p: Params) -> Column:
    return (F.col("id") % p.every == 0) & ~F.col("no_id")


class Side:
    """One side of a pair of blocks, by length of vector."""

    def __init__(self, frame: pd.DataFrame):
        self.row = frame["row"].to_numpy(np.int64)
        self.id, self.no_id = frame["id"].to_numpy(np.int64), frame["no_id"].to_numpy(bool)
        self.least = frame["floor_score"].to_numpy(np.int64)
        codes = [np.frombuffer(c) for c in frame["code"]]
        n = len(frame["away"].iloc[0]) // 8 if len(frame) else 0
        self.away = np.frombuffer(b"".join(frame["away"])).reshape(len(frame), n)
        self.groups = _by_length(codes)


def upper_bounds(q: np.ndarray, q_away: np.ndarray, x: np.ndarray, x_away: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products of ``q``'s and ``x``'s rows, rounding allowed for."""
    apart = np.zeros((len(q), len(x)), np.float32)
    a, b = q_away.astype(np.float32), x_away.astype(np.float32)
    for i in range(a.shape[1]):
        np.maximum(apart, np.abs(np.subtract.outer(a[:, i], b[:, i])), out=apart)
    error = 1e-6 * (float(q_away.max(initial=0)) + float(x_away.max(initial=0)))
    norms = (q * q).sum(1)[:, None] + (x * x).sum(1)[None]
    return (norms - np.maximum(apart - error, 0, dtype=float) ** 2) / 2 + 1e-6 * norms + 1


def _best(score: np.ndarray, at: np.ndarray, c: Side, k: int):
    """The k best: score, then smaller id (null last), then row."""
    order = np.lexsort((c.row[at], c.id[at], c.no_id[at], ~score))[:k]
    return score[order], at[order]


def search(q: Side, c: Side, p: Params) -> list[tuple[int, int, int]]:
    """(query's place, candidate's place, score): for each query at most k candidates of the
    block, those that reach its threshold."""
    found = []
    kept = {i: (np.empty(0, np.int64), np.empty(0, np.int64)) for i in range(len(q.row))}
    least = q.least.copy()

    def take(i, at, score):
        fit = score >= least[i]
        if fit.any():
            s, a = kept[i]
            kept[i] = _best(np.r_[s, score[fit]], np.r_[a, at[fit]], c, p.k)
            if len(kept[i][0]) == p.k:
                least[i] = max(least[i], kept[i][0][-1])

    for q_at, qx in q.groups:
        for c_at, cx in c.groups:
            plain = max(_top(qx), _top(cx)) ** 2 * max(qx.shape[1], cx.shape[1], 1) < 2.0 ** 50
            for a in range(0, len(q_at), p.slice):
                part = slice(a, a + p.slice)
                if not plain:
                    for i, s in zip(q_at[part], exact(qx[part], cx)):
                        other = c.row[c_at] != q.row[i]
                        take(i, c_at[other], s[other])
                    continue
                top = upper_bounds(qx[part], q.away[q_at[part]], cx, c.away[c_at])
                for i, x, bound in zip(q_at[part], qx[part], top):
                    open_ = np.flatnonzero((bound >= least[i]) & (c.row[c_at] != q.row[i]))
                    order = open_[np.argsort(-bound[open_], kind="stable")]
                    at, step = 0, p.step
                    while at < len(order) and bound[order[at]] >= least[i]:
                        now = order[at:at + step]
                        take(i, c_at[now], exact(x[None], cx[now])[0])
                        at, step = at + step, 2 * step
    for i, (s, a) in kept.items():
        found += [(i, int(j), int(v)) for v, j in zip(s, a)]
    return found


def top_k(vectors: DataFrame, p: Params = Params(), vec: str = "embedding") -> DataFrame:
    """The k highest scores of each query: query_id, rank (from 1), vec_id, score, and the
    rows' numbers query_row and row."""
    rows = coded(vectors, vec)
    count, n_queries = rows.agg(F.count(F.lit(1)), F.count_if(is_query(p))).first()
    table = pivot_table(rows, sample_of(rows, count, p), p)
    blocks, query_blocks = max(1, -(-count // p.block)), max(1, -(-n_queries // p.query_block))

    def dealt(of, n, seed):
        return F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(of)).cast("int").alias(n)

    def every(of, n):
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1))).alias(n)

    fields = ["row", "id", "no_id", "code", "away", "floor_score"]
    queries = table.where("is_query").select(*fields, dealt(query_blocks, "qb", 1), every(blocks, "cb"))
    # renamed, since both sides of the cogroup come from one table and Spark tells columns by origin
    candidates = table.select(*[F.col(f).alias(f"c_{f}") for f in fields],
                              dealt(blocks, "c_cb", 2), every(query_blocks, "c_qb"))

    def pair(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        c = c.rename(columns=lambda n: n.removeprefix("c_"))
        found = search(Side(q), Side(c), p) if len(q) and len(c) else []
        i, j, s = (np.array(x, np.int64) for x in (zip(*found) if found else ([], [], [])))
        return pd.DataFrame({"query_row": q["row"].to_numpy()[i], "query_id": q["id"].to_numpy()[i], "score": s}
                            | {n: c[n].to_numpy()[j] for n in ("row", "id", "no_id")})

    hits = (queries.groupBy("qb", "cb").cogroup(candidates.groupBy("c_qb", "c_cb"))
            .applyInPandas(pair, "query_row long, query_id long, score long, row long, id long, no_id boolean"))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "no_id", "id", "row")
    return (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= p.k)
            .select("query_id", "rank", F.when(~F.col("no_id"), F.col("id")).alias("vec_id"), "score", "query_row", "row"))


TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
           FROM embeddings
           WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.c, x.c) AS BIGINT) AS score
      FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
