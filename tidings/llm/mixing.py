"""Mixing sources to target weights: iterative proportional fitting, then sampling.

Token weights of the cells (source, language, topic) are raked until their
source, language and topic marginals meet the targets. A cell's weight is its
tokens times one factor for each of its three values; a step sums the weighted tokens
by one dimension and corrects that dimension's factors. Sweeps over the three
dimensions go on, ``SWEEPS`` at least, until no marginal is further than ``TOLERANCE``
of its target away. Cells and factors are
small tables that stay distributed; each step's factors are written to
the checkpoint folder. Where more than the first sweeps are needed, up to
``BROADCAST_CELLS`` cells are raked further on the driver. Documents are then kept with a probability in
proportion to their cell's raked weight over its tokens, at most 1, and
scaled so that the expected tokens kept meet the budget.

A document is kept if a uniform number, derived from its id, is below its
probability: a retried task decides alike. Everything is DataFrame functions.

Defined cases: targets that contradict each other (as where each source has one language) cannot
all be met: raking ends once the largest error stays where it is, with a warning that names
that error. A null source or language is a value of its own (``''``); null text
counts as empty: no tokens, probability as its cell's, and cells without any tokens
keep all. Rows that share an id and a cell share the decision; null ids draw
as the empty text does. Extra columns, whatever their names, are ignored by the report
and carried along by ``sample``. An empty table gives no rows.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import cut, whole_row, whole_text

SWEEPS = 6               # at least
TOLERANCE = 1e-3         # largest relative error of a marginal when raking ends
STALL = 100              # sweeps without the error falling by a hundredth: targets contradict each other
DIMENSIONS = ("source", "lang", "topic")
TEMPERATURE = {"source": 0.7, "lang": 0.7, "topic": 0.7}   # default target: share ** temperature
KEEP = 0.75              # expected share of the tokens kept
BROADCAST_CELLS = 100_000

# What makes a topic: the first that a text contains, else "prose".
TOPICS = (("legal", ("icense", "rights reserved")), ("contact", ("@",)), ("table", (" | ",)),
          ("code", ("token", "://")))


def topic_of(text: Column) -> Column:
    out = None
    for name, marks in TOPICS:
        hit = F.contains(text, F.lit(marks[0]))
        for m in marks[1:]:
            hit = hit | F.contains(text, F.lit(m))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("prose")


def tokens_of(text: Column) -> Column:
    """Space-separated tokens; none in an empty text."""
    return F.when(text == "", 0).otherwise(
        F.length(text) - F.length(F.replace(text, F.lit(" "))) + 1).cast("long")


def described(docs: DataFrame, row: Column) -> DataFrame:
    """(row, doc_id, source, lang, topic, n_tokens)."""
    text = whole_text()
    return docs.select(row.alias("row"), "doc_id", F.coalesce("source", F.lit("")).alias("source"),
                       F.coalesce("lang", F.lit("")).alias("lang"), topic_of(text).alias("topic"),
                       tokens_of(text).alias("n_tokens"))


def targets(cells: DataFrame, dim: str, weights: dict | None = None) -> DataFrame:
    """(value, goal): wanted tokens of each value; the goals sum to all tokens."""
    sums = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("tokens").alias("tokens"))
    if weights is None:
        wanted = F.pow(F.col("tokens"), F.lit(TEMPERATURE[dim]))
    else:
        wanted = F.lit(0.0)
        for value, w in weights.items():
            wanted = F.when(F.col("value") == value, float(w)).otherwise(wanted)
    sums = sums.select("value", "tokens", wanted.alias("wanted"))
    total = sums.agg(F.sum("tokens").alias("t"), F.sum("wanted").alias("w")).first()
    scale = (total["t"] or 0) / total["w"] if total["w"] else 0.0
    return sums.select("value", (F.col("wanted") * scale).alias("goal"))


class Progress:
    """Called with the largest relative marginal error after each sweep; true when raking ends."""

    def __init__(self):
        self.best, self.since = float("inf"), 0

    def __call__(self, error: float) -> bool:
        if error <= TOLERANCE:
            return True
        self.best, self.since = (error, 0) if error < 0.99 * self.best else (self.best, self.since + 1)
        if self.since >= STALL:
            warnings.warn(f"mixing: targets contradict each other, largest relative error of a marginal "
                          f"{error:.3g}, tolerance {TOLERANCE:g}", RuntimeWarning, stacklevel=2)
            return True
        return False


def marginal_error(raked: DataFrame, goals: dict[str, DataFrame]) -> float:
    """Largest relative error of a marginal whose goal is not zero; 0 without any."""
    errors = None
    for d in DIMENSIONS:
        sums = raked.groupBy(F.col(d).alias("own")).agg(F.sum(F.col("tokens") * F.col("ratio")).alias("sum"))
        one = (goals[d].where("goal > 0").join(sums, F.col("value") == F.col("own"))
               .select(F.abs(F.col("sum") / F.col("goal") - 1).alias("error")))
        errors = one if errors is None else errors.unionAll(one)
    return errors.agg(F.max("error")).first()[0] or 0.0


def _rake_on(raked: DataFrame, goals: dict[str, DataFrame], ended: Progress) -> DataFrame:
    """``raked`` swept on, on the driver, until ``ended``."""
    rows = raked.toArrow()
    tokens = rows["tokens"].to_numpy().astype(float)
    w = tokens * rows["ratio"].to_numpy()
    steps = []
    for d in DIMENSIONS:
        goal = {r["value"]: r["goal"] for r in goals[d].collect()}
        code = {v: i for i, v in enumerate(goal)}
        steps.append((np.array([code[v] for v in rows[d].to_pylist()]), np.array(list(goal.values()))))
    error = float("inf")
    while not ended(error):
        for own, goal in steps:
            sums = np.bincount(own, w, len(goal))
            w = w * np.divide(goal, sums, out=np.zeros_like(goal), where=sums > 0)[own]
        error = max(np.abs(np.bincount(own, w, len(goal))[goal > 0] / goal[goal > 0] - 1).max(initial=0.0)
                    for own, goal in steps)
    ratio = np.divide(w, tokens, out=np.zeros_like(w), where=tokens > 0)
    at = rows.schema.get_field_index("ratio")
    return raked.sparkSession.createDataFrame(rows.set_column(at, "ratio", pa.array(ratio)), raked.schema)


def rake(cells: DataFrame, goals: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` with ratio: raked weight over tokens, after ``sweeps`` at least and until
    the marginals meet ``goals`` within ``TOLERANCE``."""
    factors = {d: cut(g.select("value", "goal", F.lit(1.0).alias("factor"))) for d, g in goals.items()}
    ended, small = Progress(), cells.count() <= BROADCAST_CELLS

    def weighted(without: str | None = None) -> DataFrame:
        out, ratio = cells, F.lit(1.0)
        for d in DIMENSIONS:
            if d != without:
                out = out.join(factors[d].select(F.col("value").alias(f"{d}_value"),
                                                 F.col("factor").alias(f"{d}_factor")),
                               F.col(d) == F.col(f"{d}_value"))
                ratio = ratio * F.col(f"{d}_factor")
        return out.select(*cells.columns, ratio.alias("ratio"))

    done = 0
    while True:
        for d in DIMENSIONS:
            sums = (weighted(d).groupBy(F.col(d).alias("own"))
                    .agg(F.sum(F.col("tokens") * F.col("ratio")).alias("sum")))
            factors[d] = cut(factors[d].join(sums, F.col("value") == F.col("own"))
                             .select("value", "goal", F.when(F.col("sum") > 0, F.col("goal") / F.col("sum"))
                                     .otherwise(0.0).alias("factor")))
        done += 1
        if done < sweeps:
            continue
        raked = cut(weighted())
        if ended(marginal_error(raked, factors)):
            return raked
        if small:
            return _rake_on(raked, factors, ended)


def calibrate(raked: DataFrame, keep: float) -> float:
    """The factor that makes sum(tokens * min(1, factor * ratio)) the budget. Each
    round takes the cells that reach 1 out; their number only grows."""
    budget = keep * (raked.agg(F.sum("tokens")).first()[0] or 0)
    scale, full = 0.0, -1
    while True:
        top = F.col("ratio") * scale >= 1
        one = raked.agg(F.sum(top.cast("long")).alias("n"),
                        F.sum(F.when(top, F.col("tokens")).otherwise(0)).alias("t"),
                        F.sum(F.when(top, 0.0).otherwise(F.col("tokens") * F.col("ratio"))).alias("r")).first()
        if (one["n"] or 0) <= full or not one["r"]:
            return scale
        full, scale = one["n"], max(scale, (budget - one["t"]) / one["r"])


def probabilities(described_docs: DataFrame, weights: dict[str, dict] | None = None,
                  keep: float = KEEP) -> DataFrame:
    """(source, lang, topic, weight, probability) for each cell; weight in tokens."""
    cells = cut(described_docs.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")))
    goals = {d: targets(cells, d, (weights or {}).get(d)) for d in DIMENSIONS}
    raked = rake(cells, goals)
    scale = calibrate(raked, keep)
    return raked.select(*DIMENSIONS, (F.col("tokens") * F.col("ratio")).alias("weight"),
                        F.when(F.col("tokens") == 0, 1.0).otherwise(
                            F.least(F.lit(1.0), F.col("ratio") * scale)).alias("probability"))


def uniform(key: Column) -> Column:
    """A number in [0, 1) from the id: 52 bits of its MD5."""
    head = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 13)
    return F.conv(head, 16, 10).cast("double") / float(1 << 52)


def _with_probability(rows: DataFrame, weights, keep) -> DataFrame:
    cells = cut(probabilities(rows, weights, keep))
    small = F.broadcast(cells) if cells.count() <= BROADCAST_CELLS else cells
    return rows.join(small, list(DIMENSIONS))


def mix(docs: DataFrame, weights: dict[str, dict] | None = None, keep: float = KEEP) -> DataFrame:
    """Per row of ``docs``: doc_id, source, lang, topic, n_tokens, weight, probability, sampled."""
    rows = described(docs, F.lit(None).cast("string")).drop("row")
    return (_with_probability(rows, weights, keep)
            .select("doc_id", *DIMENSIONS, "n_tokens", F.round("weight", 3).alias("weight"),
                    F.round("probability", 6).alias("probability"),
                    (uniform(F.col("doc_id")) < F.col("probability")).alias("sampled")))


def sample(docs: DataFrame, weights: dict[str, dict] | None = None, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs``, all columns, that the mix draws."""
    rows = described(docs, whole_row(docs))
    return (_with_probability(rows, weights, keep)
            .where(uniform(F.col("doc_id")) < F.col("probability")).select("row.*"))


def _topic_sql() -> str:
    cases = " ".join("WHEN " + " OR ".join(f"contains(t, '{m}')" for m in marks) + f" THEN '{name}'"
                     for name, marks in TOPICS)
    return f"CASE {cases} ELSE 'prose' END"


def mix_sql(keep: float = KEEP) -> str:
    """The same in DuckDB SQL, the raking steps unrolled."""
    steps, last = [], "s0"
    for i in range(SWEEPS * len(DIMENSIONS)):
        d = DIMENSIONS[i % len(DIMENSIONS)]
        steps.append(f"s{i + 1} AS (SELECT source, lang, topic, tokens, w * goal / "
                     f"sum(w) OVER (PARTITION BY s.{d}) AS w FROM {last} s JOIN goal_{d} g ON s.{d} = g.value)")
        last = f"s{i + 1}"
    goals = ",\n".join(
        f"goal_{d} AS (SELECT {d} AS value, pow(sum(tokens), {TEMPERATURE[d]}) * (SELECT sum(tokens) FROM s0) "
        f"/ sum(pow(sum(tokens), {TEMPERATURE[d]})) OVER () AS goal FROM s0 GROUP BY {d})" for d in DIMENSIONS)
    return f"""
WITH base AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
                     coalesce(text, '') AS t FROM documents),
d AS (SELECT doc_id, source, lang, {_topic_sql()} AS topic,
             CASE WHEN t = '' THEN 0 ELSE length(t) - length(replace(t, ' ', '')) + 1 END AS n_tokens FROM base),
s0 AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens, sum(n_tokens)::DOUBLE AS w
       FROM d GROUP BY ALL),
{goals},
{", ".join(steps)},
ranked AS (SELECT *, w / tokens AS r, row_number() OVER o AS j, sum(tokens) OVER o AS top_t, sum(w) OVER o AS top_w,
                  lead(w / tokens) OVER (ORDER BY w / tokens DESC, source, lang, topic) AS after
           FROM {last} WHERE tokens > 0
           WINDOW o AS (ORDER BY w / tokens DESC, source, lang, topic)),
budget AS (SELECT {keep} * sum(tokens) AS b, sum(w) AS all_w, max(r) AS r1 FROM ranked),
scales AS (SELECT 0 AS j, b / all_w AS c, r1 AS after FROM budget
           UNION ALL SELECT j, (b - top_t) / (all_w - top_w), after FROM ranked, budget WHERE after IS NOT NULL),
scale AS (SELECT arg_min(c, j) AS c FROM scales WHERE c * after <= 1),
p AS (SELECT source, lang, topic, w,
             CASE WHEN tokens = 0 THEN 1.0 ELSE least(1.0, w / tokens * c) END AS q FROM {last}, scale)
SELECT d.doc_id, source, lang, topic, d.n_tokens, round(w, 3) AS weight, round(q, 6) AS probability,
       ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0 < q AS sampled
FROM d JOIN p USING (source, lang, topic)
"""
