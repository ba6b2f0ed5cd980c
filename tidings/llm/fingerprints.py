"""Document fingerprints: one-permutation MinHash with optimal densification.

Every shingle of five words is hashed once; the top bits name one of ``BINS``
bins, and a bin keeps its smallest hash. An empty bin borrows from the
first filled bin along its own random probing order, the same for all documents
(optimal densification). The lowest eight bits of each bin are packed, eight
bins a long; likeness is the share of equal bins, corrected for the 1 in 256
that agree by chance.

Everything is DataFrame functions on whole rows: no shingle is shuffled. Only the
edited text needs other rows: ids get their successor from a range
partitioning of the ids alone, and the successor's leading characters (no
more than are asked for) travel to the row by an equi-join.

Defined cases: null text counts as empty; a text of fewer than five words is
one shingle, also the empty one, so equal texts always agree. The last id's
successor is the first id. Rows that share an id share a successor and, as
a successor, show the smallest of their leading parts; a row with a null id has no
successor: its edited text only loses its end, and near_next is null. Other
columns, whatever their names, are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.common import cut, whole_text

BINS = 128
SHINGLE = 5
PROBES = 12
SEED = 20
_LOW = 56               # a hash has 63 bits, 7 of them name its bin


def _held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` as a column that later expressions read instead of evaluating it
    again for each element (a generator's output isn't inlined)."""
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, F.explode(F.array(value)).alias(name))


def _probing_order() -> Column:
    rng = random.Random(SEED)
    return F.array(*[F.array(*[F.lit(rng.randrange(BINS)) for _ in range(PROBES)]) for _ in range(BINS)])


def add_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with ``name``: the packed bins of column ``text`` as array<long>."""
    w, s, f, d = (f"{name}_{x}" for x in ("words", "sorted", "firsts", "dense"))
    words = F.array_remove(F.split(F.lower(F.col(text)), r"\s+"), "")
    df = _held(df, w, F.transform(words, lambda x: F.xxhash64(x)))
    n = F.size(w)

    def shingle(i: Column) -> Column:
        return F.xxhash64(*[F.get(F.col(w), i + j) for j in range(SHINGLE)])

    hashes = F.when(n >= SHINGLE, F.transform(F.sequence(F.lit(0), F.greatest(n - SHINGLE, F.lit(0))), shingle)
                    ).otherwise(F.array(F.xxhash64(F.col(w))))
    df = _held(df, s, F.sort_array(F.transform(hashes, lambda h: F.shiftrightunsigned(h, 1)))).drop(w)

    def starts_bin(v: Column, i: Column) -> Column:
        return (i == 0) | (F.shiftright(v, _LOW) != F.shiftright(F.get(F.col(s), i - 1), _LOW))

    df = _held(df, f, F.filter(F.col(s), starts_bin)).drop(s)
    bins = F.transform(F.col(f), lambda v: F.shiftright(v, _LOW))
    df = _held(df, f"{name}_bins", bins)
    spread = F.when(F.size(f) == BINS, F.col(f)).otherwise(F.transform(
        F.sequence(F.lit(0), F.lit(BINS - 1)),
        lambda b: F.get(F.col(f), F.array_position(F.col(f"{name}_bins"), b.cast("long")).cast("int") - 1)))
    df = _held(df, d, spread)

    def borrowed(b: Column) -> Column:
        probe = F.get(F.filter(F.get(_probing_order(), b), lambda p: F.get(F.col(d), p).isNotNull()), F.lit(0))
        last = F.array_min(F.transform(F.col(f), lambda v: F.struct(
            F.xxhash64(b, F.shiftright(v, _LOW)).alias("rank"), v.alias("v"))))["v"]
        return F.coalesce(F.get(F.col(d), probe), last)

    full = F.transform(F.col(d), lambda v, b: F.coalesce(v, borrowed(b)))
    df = _held(df, d, full).drop(f, f"{name}_bins")

    def packed(j: Column) -> Column:
        out = F.lit(0).cast("long")
        for i in range(8):
            out = F.shiftleft(out, 8).bitwiseOR(F.get(F.col(d), j * 8 + i).bitwiseAND(F.lit(255)))
        return out

    return _held(df, name, F.transform(F.sequence(F.lit(0), F.lit(BINS // 8 - 1)), packed)).drop(d)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of shingles in common, from two packed fingerprints."""
    def unequal(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        for k in (4, 2, 1):
            z = z.bitwiseOR(F.shiftrightunsigned(z, k))
        return F.bit_count(z.bitwiseAND(F.lit(0x0101010101010101)))

    off = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda acc, x: acc + x)
    chance = 1 / 256
    return F.when(off.isNotNull(), F.greatest(F.lit(0.0), (1 - off / F.lit(float(BINS)) - chance) / (1 - chance)))


def as_text(packed: Column) -> Column:
    return F.array_join(F.transform(packed, lambda v: F.lower(F.lpad(F.hex(v), 16, "0"))), "")


def successors(docs: DataFrame) -> DataFrame:
    """(doc_id, next_id) for each distinct id; the last one's successor is the first."""
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    ranged = cut(ids.repartitionByRange("doc_id").select("doc_id", F.spark_partition_id().alias("part")))
    within = ranged.withColumn("next_id", F.lead("doc_id").over(
        Window.partitionBy("part").orderBy("doc_id")))
    # a row for each partition that has ids
    heads = ranged.groupBy("part").agg(F.min("doc_id").alias("head"))
    order = Window.orderBy("part")
    ahead = heads.select("part", F.coalesce(
        F.lead("head").over(order),
        F.min("head").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("ahead"))
    return (within.join(F.broadcast(ahead), "part")
            .select("doc_id", F.coalesce("next_id", "ahead").alias("next_id")))


def with_edited(docs: DataFrame, following: DataFrame) -> DataFrame:
    """(doc_id, n_chars, text, edited) per row. The texts are dealt out by id once:
    the rows as successors and the rows themselves read the same shuffle."""
    every = docs.select("doc_id", whole_text().alias("text"))
    rows = every.where(F.col("doc_id").isNotNull())
    quarter = F.floor(F.length("text") / 4).cast("int")
    wanted = (rows.groupBy("doc_id").agg(F.max(quarter).alias("need"))
              .join(following, "doc_id")
              .select(F.col("doc_id").alias("for_id"), "need", "next_id"))
    leading = (rows.join(wanted, F.col("doc_id") == F.col("next_id"))
               .select("for_id", F.substring("text", F.lit(1), F.col("need")).alias("lead"))
               .groupBy("for_id").agg(F.min("lead").alias("lead")))
    led = rows.join(leading, F.col("doc_id") == F.col("for_id"), "left").select("doc_id", "text", "lead")
    without = every.where(F.col("doc_id").isNull()).withColumn("lead", F.lit(""))
    return led.unionByName(without).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "text", F.concat(
            F.substring("text", F.lit(1), (F.length("text") - quarter).cast("int")),
            F.substring(F.coalesce("lead", F.lit("")), F.lit(1), quarter)).alias("edited"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    following = cut(successors(docs))
    both = with_edited(docs, following)
    done = add_fingerprint(add_fingerprint(both, "text", "own").drop("text"), "edited", "new")
    done = cut(done.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", "new"))
    ahead = (done.groupBy("doc_id").agg(F.min("own").alias("next_own"))
             .withColumnRenamed("doc_id", "next_id")
             .join(following, "next_id").select("doc_id", "next_own"))
    return (done.join(ahead, "doc_id", "left")
            .select("doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
                    as_text(F.col("new")).alias("edited_fingerprint"),
                    likeness(F.col("own"), F.col("new")).alias("near_edited"),
                    likeness(F.col("own"), F.col("next_own")).alias("near_next")))
