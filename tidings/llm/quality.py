"""Quality classifier: random-indexing word vectors, pooled per document, into
a two-layer numpy network with temperature-calibrated probabilities.

Every word (letter run or symbol run) falls into one of a fixed number of
hashed buckets and has a sparse ternary random index vector, a function of its hash.
A bucket's context vector is the sum of the index vectors of the words next
to it, counted over all documents: each task adds up its own documents,
one aggregation sums the tasks, and the result (``buckets`` x ``dim``
numbers, whatever the input) goes to every task. A document is the mean and
the spread of its words' index and context vectors and the log of its length.
The network is trained on a bounded sample of labelled documents; a part of that
sample is set aside to fit the temperature that calibrates its probabilities.

Defined cases: null text counts as empty; a text without words is pooled to
zeros and scored like any other. Without labelled rows of both classes the
score is the share of class 1 (1 without any labels: nothing is rejected).
Repeated rows get equal scores; null ids are scored and never learned from;
other columns, whatever their names, are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import fold_of, labelled_sample, text_udf, whole_text
from tidings.session import ship_package

TOKEN = re.compile(r"\w+|[^\w\s]+")


@dataclass(frozen=True)
class Params:
    per_class: int = 4000     # bound of the training sample: documents per class
    buckets: int = 1 << 14    # hashed words
    dim: int = 32
    nonzero: int = 2          # entries of an index vector
    flush: int = 1 << 19      # words gathered before they are counted
    hidden: int = 32
    epochs: int = 120
    batch: int = 128
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 11
    cache: int = 100_000      # words a task remembers


def index_vectors(p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries, (buckets, nonzero) each."""
    rng = np.random.default_rng(p.seed)
    return (rng.integers(0, p.dim, (p.buckets, p.nonzero)),
            rng.choice(np.array([-1, 1]), (p.buckets, p.nonzero)))


def bucket_ids(text: str, p: Params, known: dict) -> np.ndarray:
    """Bucket of each word; known is a bounded cache."""
    out = []
    for w in TOKEN.findall(text):
        b = known.get(w)
        if b is None:
            if len(known) >= p.cache:
                known.clear()
            b = known[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % p.buckets
        out.append(b)
    return np.array(out, np.int64)


def count_contexts(texts, p: Params, into: np.ndarray, known: dict, places, signs) -> None:
    """Add each word's neighbours' index vectors to its row of ``into``."""
    flat = into.reshape(-1)

    def add(left: list, right: list) -> None:
        a, b = np.concatenate(left), np.concatenate(right)
        for own, other in ((a, b), (b, a)):
            for k in range(p.nonzero):
                flat[:] += np.bincount(own * p.dim + places[other, k], signs[other, k],
                                       p.buckets * p.dim).astype(np.int64)

    left, right, n = [], [], 0
    for text in texts:
        x = bucket_ids(text, p, known)
        if len(x) < 2:
            continue
        left.append(x[:-1])
        right.append(x[1:])
        n += len(x)
        if n >= p.flush:
            add(left, right)
            left, right, n = [], [], 0
    if left:
        add(left, right)


def context_vectors(docs: DataFrame, p: Params = Params()) -> np.ndarray:
    """Word vectors (buckets, dim): context sums over all documents, rows of unit length."""
    ship_package(docs.sparkSession)
    names = [f"c{i}" for i in range(p.dim)]

    def run(batches):
        places, signs = index_vectors(p)
        sums, known = np.zeros((p.buckets, p.dim), np.int64), {}
        for b in batches:
            count_contexts(b["text"].tolist(), p, sums, known, places, signs)
        rows = np.flatnonzero(np.abs(sums).sum(1))
        yield pd.DataFrame(sums[rows], columns=names).assign(bucket=rows)

    part = docs.select(whole_text().alias("text")).mapInPandas(
        run, "bucket long, " + ", ".join(f"{n} long" for n in names))
    total = np.zeros((p.buckets, p.dim))
    for r in part.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toLocalIterator():
        total[r["bucket"]] = r[1:]
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    return (total / np.where(norm > 0, norm, 1)).astype(np.float32)


def word_table(context: np.ndarray, p: Params) -> np.ndarray:
    """Index and context vector of each bucket side by side."""
    places, signs = index_vectors(p)
    index = np.zeros((p.buckets, p.dim), np.float32)
    for k in range(p.nonzero):
        np.add.at(index, (np.arange(p.buckets), places[:, k]), signs[:, k])
    return np.hstack([index, context]).astype(np.float32)


def pool(text: str, table: np.ndarray, p: Params, known: dict) -> np.ndarray:
    """Mean and spread of the word vectors and the log of the word count."""
    x = bucket_ids(text, p, known)
    width = table.shape[1]
    out = np.zeros(2 * width + 2, np.float32)
    if len(x):
        seen, n = np.unique(x, return_counts=True)
        share = (n / len(x)).astype(np.float32)
        v = table[seen]
        mean = share @ v
        out[:width] = mean
        out[width:-2] = np.sqrt(np.maximum(share @ (v * v) - mean * mean, 0))
        out[-2] = np.linalg.norm(mean)
        out[-1] = np.log1p(len(x))
    return out


@dataclass
class Network:
    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.shift) / self.scale @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, prior: float, p: Params) -> Network:
    """Adam on logistic loss; rows weigh so that class 1 has the share ``prior``.
    Every fifth row only serves to fit the temperature."""
    width = x.shape[1] if len(x) else 4 * p.dim + 2
    if len(y) < 10 or y.min() == y.max():
        share = prior if len(y) else 1 - 1e-6
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1),
                       np.zeros(1), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(p.seed)
    aside = np.arange(len(y)) % 5 == 4
    got = y.mean()
    weight = np.where(y == 1, prior / got, (1 - prior) / (1 - got))
    shift, scale = x[~aside].mean(0), x[~aside].std(0) + 1e-3
    z = (x - shift) / scale
    theta = [rng.normal(0, (2 / width) ** 0.5, (width, p.hidden)), np.zeros(p.hidden),
             rng.normal(0, (1 / p.hidden) ** 0.5, p.hidden), np.zeros(1)]
    first, second, step = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta], 0
    fit_rows = np.flatnonzero(~aside)
    for epoch in range(p.epochs):
        order = rng.permutation(fit_rows)
        for lo in range(0, len(order), p.batch):
            r = order[lo:lo + p.batch]
            pre = z[r] @ theta[0] + theta[1]
            h = np.maximum(pre, 0)
            prob = 1 / (1 + np.exp(-np.clip(h @ theta[2] + theta[3], -30, 30)))
            d = (prob - y[r]) * weight[r] / len(r)
            dh = np.outer(d, theta[2]) * (pre > 0)
            grads = [z[r].T @ dh + p.decay * theta[0], dh.sum(0),
                     h.T @ d + p.decay * theta[2], np.array([d.sum()])]
            step += 1
            rate = p.rate * (1 - epoch / p.epochs)
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                theta[i] -= (rate * first[i] / (1 - 0.9 ** step)
                             / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8))
    net = Network(shift, scale, theta[0], theta[1], theta[2], float(theta[3][0]))
    raw, best = net.logits(x[aside]), (np.inf, 1.0)
    for t in np.exp(np.linspace(np.log(0.25), np.log(8), 60)):
        q = np.clip(1 / (1 + np.exp(-np.clip(raw / t, -30, 30))), 1e-9, 1 - 1e-9)
        loss = -(weight[aside] * np.where(y[aside] == 1, np.log(q), np.log(1 - q))).mean()
        best = min(best, (float(loss), float(t)))
    net.temperature = best[1]
    return net


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> tuple[np.ndarray, Network]:
    """Word table over all documents, network over the bounded sample."""
    table = word_table(context_vectors(docs, p), p)
    sample = labelled_sample(docs, labels, "quality", p.per_class)

    def make():
        known: dict = {}
        return lambda texts: [pool(t, table, p, known) for t in texts]

    rows = sorted(((r["doc_id"], r["y"], r["x"]) for r in sample.select(
        "doc_id", "y", text_udf(sample, make, "array<float>").alias("x")).toLocalIterator()),
        key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0], r[1]))
    learn = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold_of() != 0))
    prior = learn.agg(F.avg(F.col("quality").cast("double"))).first()[0]
    x = np.array([r[2] for r in rows], np.float64).reshape(len(rows), 4 * p.dim + 2)
    return table, train(x, np.array([r[1] for r in rows], np.float64), prior or 0.0, p)


def score_column(docs: DataFrame, table: np.ndarray, net: Network, p: Params = Params()) -> Column:
    def make():
        known: dict = {}

        def step(texts):
            if not texts:
                return []
            x = np.stack([pool(t, table, p, known) for t in texts])
            return net.probabilities(x).tolist()
        return step
    return text_udf(docs, make, "double")


def score_quality(docs: DataFrame, labels: DataFrame, p: Params = Params(),
                  threshold: float = 0.3) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    table, net = fit(docs, labels, p)
    return (docs.select("doc_id", whole_text().alias("text"))
            .select("doc_id", (fold_of() == 0).alias("held_out"),
                    score_column(docs, table, net, p).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, p: Params = Params(),
              threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier doesn't reject."""
    table, net = fit(docs, labels, p)
    return docs.where(score_column(docs, table, net, p) >= threshold)
