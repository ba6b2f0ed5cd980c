"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the embeddings of the word itself and of its
character n-grams (hashed into a fixed table), a document's vector the mean
over its word occurrences, and a linear softmax reads that mean. N-grams
weigh by their rarity among the training documents, so that the common ones don't
drown the rest. Embeddings
and softmax are trained together with Adam in numpy on a bounded sample of
labelled documents; a misspelling unseen there shares most n-grams with
words that were seen.

The model is linear after the mean, so an n-gram's effect on the score is one
number and scoring needs no shuffle. Texts are code points in numpy: words
are runs of ``\\w``, and the n-grams of all words of a slice of texts are hashed
at once, ``BLOCK`` code points at a time, also inside a longer word.

Defined cases: null text counts as empty; a text without words (empty too)
gets the score of the bias alone. Very long texts and words are read whole, in
linear time and blocks of bounded size. Without labelled rows of both classes the
score is the share of class 1 among them (0 without any). A score at the threshold
predicts 1. Repeated rows get equal scores; null ids are scored and never learned from;
other columns, whatever their names, are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.common import cut, fold_of, labelled_sample, text_udf, whole_text

BLOCK = 1 << 18           # code points hashed at once
OPEN, CLOSE = ord("<"), ord(">")
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Params:
    per_class: int = 2000     # bound of the training sample: documents per class,
    entries: int = 10_000_000   # and distinct n-grams of those documents, together per class
    buckets: int = 1 << 16    # hashed n-grams; at most 2^16
    n_min: int = 3
    n_max: int = 5
    dim: int = 4
    steps: int = 240
    batch: int = 250
    rate: float = 0.1
    emb_step: float = 1000.0   # length of a step of the embeddings against the softmax's
    prior: float = 0.25       # share of class 1 that the rows' weights make up
    seed: int = 7


@cache
def word_chars() -> np.ndarray:
    """Which code points are part of a word."""
    out = np.zeros(0x110000, bool)
    every = "".join(map(chr, range(0x110000)))
    for m in re.finditer(r"\w+", every):
        out[m.start():m.end()] = True
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * K2
    return h ^ (h >> np.uint64(29))


class Words:
    """The words of some texts: ``points``, each word between its marks; ``start`` and
    ``size`` (with marks) of each word there; ``text``, the index of its text."""

    def __init__(self, texts: list[str]):
        low = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        sizes = np.array([len(x) + 1 for x in low], np.int64)
        gap = np.zeros(1, np.uint32)
        points = np.concatenate([y for x in low for y in (x, gap)] or [gap])
        inside = word_chars()[points]
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        first, last = edge[::2], edge[1::2]
        self.text = np.searchsorted(np.cumsum(sizes), first, "right")
        self.size = last - first + 2
        ends = np.cumsum(self.size)
        self.start = ends - self.size
        self.points = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
        body = np.ones(len(self.points), bool)
        body[self.start] = body[ends - 1] = False
        self.points[self.start], self.points[ends - 1] = OPEN, CLOSE
        self.points[body] = points[inside]

    def grams(self, p: Params) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word, bucket) of every n-gram and of every whole word, block by block."""
        whole = np.zeros(len(self.start), np.uint64)
        for a in range(0, len(self.points), BLOCK):
            b = min(a + BLOCK, len(self.points))
            part = self.points[a:b + p.n_max - 1].astype(np.uint64)
            w0, w1 = np.searchsorted(self.start, [a, b - 1], "right") - 1
            at = np.maximum(self.start[w0:w1 + 1], a) - a
            word = np.repeat(np.arange(w0, w1 + 1), np.diff(at, append=b - a))
            place = np.arange(a, b) - self.start[word]
            left = self.size[word] - place
            whole[w0:w1 + 1] += np.add.reduceat(_mixed(part[:b - a] * K1 + place.astype(np.uint64) * K2), at)
            h = part[:b - a].copy()
            for n in range(2, p.n_max + 1):
                more = part[n - 1:n - 1 + b - a]
                h = h * K1
                h[:len(more)] += more
                if n >= p.n_min:
                    fit = left >= n
                    yield word[fit], self._bucket(h[fit] + np.uint64(n), p)
        yield np.arange(len(whole)), self._bucket(whole, p)

    @staticmethod
    def _bucket(h: np.ndarray, p: Params) -> np.ndarray:
        return ((_mixed(h) >> np.uint64(32)) % np.uint64(p.buckets)).astype(np.int64)

    def n_grams(self, p: Params) -> np.ndarray:
        """How many entries of `grams` each word has."""
        return 1 + sum(np.maximum(self.size - n + 1, 0) for n in range(p.n_min, p.n_max + 1))


def slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(place, texts) of runs of texts of about ``BLOCK`` code points, or one longer text."""
    at = 0
    while at < len(texts):
        to, size = at + 1, len(texts[at])
        while to < len(texts) and size + len(texts[to]) <= BLOCK:
            size, to = size + len(texts[to]), to + 1
        yield at, texts[at:to]
        at = to


def bag(text: str, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """The document's mean as (n-gram ids, weights)."""
    words = Words([text])
    total = np.zeros(p.buckets)
    each = 1.0 / (words.n_grams(p) * max(len(words.start), 1))
    for word, ids in words.grams(p):
        total += np.bincount(ids, each[word], p.buckets)
    ids = np.flatnonzero(total)
    return ids, total[ids].astype(np.float32)


@dataclass
class Model:
    """``word_logit[i]``: what n-gram i adds to logit(1) - logit(0) at weight 1."""
    word_logit: np.ndarray
    bias: float
    params: Params


def train(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, p: Params) -> Model:
    """Embeddings and softmax by Adam on mini-batches; rows weigh so that class 1 has the
    share ``prior``."""
    share = float(y.mean()) if len(y) else 0.0
    flat = Model(np.zeros(p.buckets, np.float32), _logit(share), p)
    if len(y) == 0 or y.min() == y.max():
        return flat
    rng = np.random.default_rng(p.seed)
    seen = np.bincount(np.concatenate([b[0] for b in bags]), minlength=p.buckets)
    rarity = (np.log((1 + len(y)) / (1 + seen)) / np.log(1 + len(y))).astype(np.float32)
    bags = [(ids, val * rarity[ids]) for ids, val in bags]
    emb = rng.normal(0, 0.1, (p.buckets, p.dim)).astype(np.float32)
    soft, bias = rng.normal(0, 0.5, (p.dim, 2)).astype(np.float32), np.zeros(2, np.float32)
    weight = np.where(y == 1, p.prior / share, (1 - p.prior) / (1 - share)).astype(np.float32)
    theta = [emb, soft, bias]
    first, second, step = [np.zeros_like(t) for t in theta], [0.0] * 3, 0
    sizes = (p.emb_step, 1.0, 1.0)
    order = np.empty(0, np.int64)
    while step < p.steps:
        if len(order) < p.batch:
            order = np.r_[order, rng.permutation(len(y))]
        rows, order = order[:p.batch], order[p.batch:]
        ids = np.concatenate([bags[r][0] for r in rows])
        val = np.concatenate([bags[r][1] for r in rows])
        row = np.repeat(np.arange(len(rows)), [len(bags[r][0]) for r in rows])
        hidden = np.stack([np.bincount(row, val * emb[ids, k], len(rows))
                           for k in range(p.dim)], 1).astype(np.float32)
        z = hidden @ soft + bias
        z -= z.max(1, keepdims=True)
        prob = np.exp(z) / np.exp(z).sum(1, keepdims=True)
        dz = (prob - np.eye(2, dtype=np.float32)[y[rows]]) * weight[rows, None] / len(rows)
        dh = dz @ soft.T
        demb = np.stack([np.bincount(ids, val * dh[row, k], p.buckets)
                         for k in range(p.dim)], 1).astype(np.float32)
        step += 1
        rate = p.rate * (1 - (step - 1) / p.steps)
        for i, g in enumerate((demb, hidden.T @ dz, dz.sum(0))):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * float(g.ravel() @ g.ravel())
            theta[i] -= (rate * sizes[i] * (first[i] / (1 - 0.9 ** step))
                         / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-9))
    diff = soft[:, 1] - soft[:, 0]
    return Model(emb @ diff * rarity, float(bias[1] - bias[0]), p)


def _logit(q: float) -> float:
    q = min(max(q, 1e-6), 1 - 1e-6)
    return float(np.log(q / (1 - q)))


def scorer(model: Model):
    """texts -> scores."""
    p, effect = model.params, model.word_logit.astype(float)

    def score(texts: list[str]) -> list[float]:
        z = np.zeros(len(texts))
        for at, some in slices(texts):
            words = Words(some)
            own = np.zeros(len(words.start))
            for word, ids in words.grams(p):
                own += np.bincount(word, effect[ids], len(own))
            sums = np.bincount(words.text, own / words.n_grams(p), len(some))
            z[at:at + len(some)] = sums / np.maximum(np.bincount(words.text, minlength=len(some)), 1)
        return list(1 / (1 + np.exp(-np.clip(z + model.bias, -30, 30))))
    return score


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> Model:
    """Train on the bounded sample. Executors turn its texts into bags; of each class those
    that together hold at most ``p.entries`` n-grams reach the driver, packed."""
    sample = labelled_sample(docs, labels, "toxic", p.per_class)

    def make():
        def step(texts):
            bags = [bag(t, p) for t in texts]
            return {"n": [len(b[0]) for b in bags], "ids": [b[0].astype(np.uint16).tobytes() for b in bags],
                    "weights": [b[1].tobytes() for b in bags]}
        return step

    bags = cut(sample.select("doc_id", "y", text_udf(sample, make, "struct<n:long,ids:binary,weights:binary>").alias("bag"))
               .select("doc_id", "y", "bag.*"))
    # the sample has at most per_class rows of a class
    order = Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id", "n", "ids", "weights")
    rows = bags.withColumn("total", F.sum("n").over(order)).where(F.col("total") <= p.entries).toLocalIterator()
    got = sorted(((r["doc_id"], r["y"], bytes(r["ids"]), bytes(r["weights"])) for r in rows))
    return train([(np.frombuffer(i, np.uint16).astype(np.int64), np.frombuffer(w, np.float32)) for _, _, i, w in got],
                 np.array([r[1] for r in got], np.int64), p)


def score_toxicity(docs: DataFrame, labels: DataFrame, p: Params = Params(),
                   threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, p)
    score = text_udf(docs, lambda: scorer(model), "double")
    return (docs.select("doc_id", whole_text().alias("text"))
            .select("doc_id", (fold_of() == 0).alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
