"""Merkle manifest of a dataset, and every row's proof by octopus multiproofs.

Each row is a leaf, the hash of its fields. Per source the leaves, in the order of
doc_id, are hashed 16 at a time, level by level, to a subroot; the subroots, in the
order of source, likewise to the root. `manifest` writes leaves and nodes.

Proofs are made by partitions of ``PART`` leaves that follow each other. A partition's
leaves span an interval of each source's leaves, which gives its interval on every level; what
the runs at an interval's two ends need besides is the minimal union of node
coordinates that the partition misses. These are joined with the manifest's
nodes once, for all proofs together; the partition derives the interior nodes
that its leaves share, and expands each leaf's proof from them.

Positions come from a sort by range, whose partitions are counted and summed; no
source, however large, is in one task. Only hashes and ids are shuffled, never texts.

Defined cases: a null field is ``-``; any other, empty ones too, its UTF-8 byte
count, ``:`` and value. Texts are hashed whole. Null ids come first in their source and are
never tampered with; null sources are one source, the first. Rows with equal source and
id stand in the order of their leaves; equal rows have neighbouring leaves and a proof
each. Other columns, whatever their names, are ignored. An empty table gives no rows and
has no root.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.common import cut
from tidings.session import ship_package

ARITY = 16
BITS = 4              # of a position that a level takes off
PART = 2048           # leaves of a partition that proves together
PER_TASK = 100_000    # rows of a range of the sort, about
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1              # the tree of subroots
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_hash(text: Column | None = None) -> Column:
    """The leaf of a row, with ``text`` in place of its own."""
    def part(name):
        v = text if name == "text" and text is not None else F.col(name).cast("string")
        return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))
    return F.sha2(F.concat(*map(part, FIELDS)), 256)


def tampered_leaf() -> Column:
    """The leaf with its text lower-cased (A-Z) where 5 divides the id's crc32, else null."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return F.when(hit, leaf_hash(F.translate("text", UPPER, LOWER)))


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with its place (from 0) in the order of the columns ``order``.

    The rows are sorted by ranges; places within a range and the ranges' counts before it add up."""
    ranges = max(1, -(-df.count() // PER_TASK))
    at = cut(df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
             .withColumn("_at", F.monotonically_increasing_id())
             .withColumn("_range", F.shiftright("_at", 33)))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (at.groupBy("_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .select("_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")))
    return at.join(starts, "_range").withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


def climb(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The levels above ``nodes`` (tree, level, idx, n, digest), n being the tree's nodes on the
    level and ``most`` its largest value. Each level is cut."""
    levels = []
    while most > 1:
        run = F.array_sort(F.collect_list(F.struct("idx", "digest")))
        nodes = cut(nodes.where("n > 1").groupBy("tree", "level", F.shiftright("idx", BITS).alias("up"))
                    .agg(F.max("n").alias("n"), run.alias("run"))
                    .select("tree", (F.col("level") + 1).alias("level"), F.col("up").alias("idx"),
                            F.shiftright(F.col("n") + (ARITY - 1), BITS).alias("n"),
                            F.sha2(F.concat_ws("", "run.digest"), 256).alias("digest")))
        levels.append(nodes)
        most = -(-most // ARITY)
    return levels


@dataclass
class Manifest:
    """``leaves``: tree, pos, n, rank, doc_id (as text), leaf, tampered. ``nodes``: tree, level, idx,
    n, digest, leaves with them. ``sources``: tree, source, n. ``root``: null without leaves."""
    leaves: DataFrame
    nodes: DataFrame
    sources: DataFrame
    root: str | None
    n_sources: int
    most: int


def manifest(docs: DataFrame) -> Manifest:
    hashed = cut(docs.select("doc_id", F.col("source").cast("string").alias("source"),
                             leaf_hash().alias("leaf"), tampered_leaf().alias("tampered")))
    rows = ranked(hashed, ["source", "doc_id", "leaf"], "rank")
    sources = cut(ranked(rows.groupBy("source").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")),
                         ["first"], "tree"))
    own = sources.withColumnRenamed("source", "_source")
    leaves = cut(rows.join(own, F.col("source").eqNullSafe(F.col("_source")))
                 .select("tree", (F.col("rank") - F.col("first")).alias("pos"), "n", "rank",
                         F.col("doc_id").cast("string").alias("doc_id"), "leaf", "tampered"))
    n_sources, most = sources.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    level0 = leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "n", F.col("leaf").alias("digest"))
    below = [level0, *climb(level0, most)]
    top0 = _all(below).where("n = 1").select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"),
                                             F.col("tree").alias("idx"), F.lit(n_sources).cast("long").alias("n"), "digest")
    nodes = _all([*below, top0, *climb(top0, n_sources)])
    root = nodes.where((F.col("tree") == TOP) & (F.col("n") == 1)).select("digest").first()
    return Manifest(leaves, nodes, sources.select("tree", "source", "n"), root and root[0], n_sources, most)


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def missing(a: str, b: str, n: str, most: int) -> Column:
    """Coordinates (level, idx) that an interval [a, b] of a tree's leaves lacks: on each
    level with several nodes, the rest of the runs at both ends."""
    def between(lo, hi):
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))

    def at(level):
        return lambda i: F.struct(F.lit(level).alias("level"), i.alias("idx"))

    out = []
    for level in range(math.ceil(math.log(max(most, 2), ARITY)) + 1):
        lo, hi = F.shiftright(a, BITS * level), F.shiftright(b, BITS * level)
        last = F.shiftright(F.col(n) - 1, BITS * level)
        left = between(lo.bitwiseAND(F.lit(-ARITY)), lo - 1)
        right = between(hi + 1, F.least(hi.bitwiseOR(F.lit(ARITY - 1)), last))
        out.append(F.transform(F.when(last > 0, F.concat(left, right)).otherwise(F.array().cast("array<bigint>")),
                               at(level)))
    return F.flatten(F.array(*out))


def requests(m: Manifest) -> DataFrame:
    """(part, tree, level, idx): the nodes that each partition of leaves must fetch."""
    part = F.floor(F.col("rank") / PART).alias("part")
    spans = m.leaves.groupBy(part, "tree").agg(F.min("pos").alias("a"), F.max("pos").alias("b"), F.max("n").alias("n"))
    tops = (m.leaves.groupBy(part).agg(F.min("tree").alias("a"), F.max("tree").alias("b"))
            .select("part", F.lit(TOP).cast("long").alias("tree"), "a", "b", F.lit(m.n_sources).cast("long").alias("n")))
    every = spans.unionByName(tops)
    return every.select("part", "tree", F.explode(missing("a", "b", "n", max(m.most, m.n_sources))).alias("c")).select("part", "tree", "c.*")


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Multiproof:
    """What one partition knows: digests by (tree, level) and idx, its own and the fetched
    ones, and the interior nodes that they give."""

    def __init__(self, leaves: dict[int, dict[int, str]], sizes: dict[int, int], n_sources: int, fetched):
        self.known: dict[tuple[int, int], dict[int, str]] = {}
        self.sizes = sizes | {TOP: n_sources}
        for tree, level, idx, digest in fetched:
            self.known.setdefault((tree, level), {})[idx] = digest
        self.ups: dict[tuple[int, int, int], str] = {}
        subroots = {tree: self.derive(tree, own) for tree, own in leaves.items()}
        self.subroots = subroots
        self.root = self.derive(TOP, subroots)

    def derive(self, tree: int, own: dict[int, str]) -> str:
        """The tree's top digest; every node above ``own`` becomes known."""
        level, n = 0, self.sizes[tree]
        while True:
            self.known.setdefault((tree, level), {}).update(own)
            if n == 1:
                return own[0]
            own = {i: _h(*self.run(tree, level, i)) for i in {i >> BITS for i in own}}
            level, n = level + 1, -(-n // ARITY)

    def last(self, tree: int, level: int) -> int:
        return (self.sizes[tree] - 1) >> (BITS * level)

    def run(self, tree: int, level: int, up: int) -> list[str]:
        """The digests of a run, left to right."""
        at = self.known[tree, level]
        return [at[i] for i in range(up << BITS, min((up << BITS) + ARITY - 1, self.last(tree, level)) + 1)]

    def siblings(self, tree: int, level: int, idx: int) -> str:
        run = self.run(tree, level, idx >> BITS)
        at = idx & (ARITY - 1)
        return "".join(run[:at] + run[at + 1:])

    def above(self, tree: int, level: int, idx: int) -> str:
        """All siblings from this node on, level by level up to the root."""
        got = self.ups.get((tree, level, idx))
        if got is None:
            if self.last(tree, level):
                got = self.siblings(tree, level, idx) + self.above(tree, level + 1, idx >> BITS)
            else:
                got = "" if tree == TOP else self.above(TOP, 0, tree)
            self.ups[tree, level, idx] = got
        return got

    def proof(self, tree: int, pos: int) -> str:
        """The hash of a leaf's proof; only nodes above leaves are kept."""
        if not self.last(tree, 0):
            return _h(self.above(tree, 0, pos))
        return _h(self.siblings(tree, 0, pos), self.above(tree, 1, pos >> BITS))

    def fold(self, tree: int, pos: int, digest: str) -> str:
        """The root that a leaf's digest and its siblings give. From a node that comes out as
        derived on, the rest is shared."""
        level, idx = 0, pos
        while True:
            if digest == self.known[tree, level].get(idx):
                return self.root
            if self.last(tree, level):
                run = self.run(tree, level, idx >> BITS)
                run[idx & (ARITY - 1)] = digest
                digest, level, idx = _h(*run), level + 1, idx >> BITS
            elif tree == TOP:
                return digest
            else:
                tree, level, idx = TOP, 0, tree


def proofs(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    ship_package(docs.sparkSession)
    m = manifest(docs)
    n_sources = m.n_sources
    # renamed, since both sides of the cogroup come from the leaves and Spark tells columns by origin
    fetched = cut(requests(m).join(m.nodes.drop("n"), ["tree", "level", "idx"])
                  .select(F.col("part").alias("to"), F.col("tree").alias("of"), F.col("level").alias("up"),
                          F.col("idx").alias("at"), F.col("digest").alias("hash")))

    def expand(leaves: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        own: dict[int, dict[int, str]] = {}
        for tree, pos, leaf in zip(leaves["tree"], leaves["pos"], leaves["leaf"]):
            own.setdefault(tree, {})[pos] = leaf
        got = Multiproof(own, dict(zip(leaves["tree"], leaves["n"])), n_sources,
                         zip(nodes["of"], nodes["up"], nodes["at"], nodes["hash"]))
        at = list(zip(leaves["tree"].tolist(), leaves["pos"].tolist()))
        shown = leaves["tampered"].where(leaves["tampered"].notna(), leaves["leaf"])
        return pd.DataFrame({
            "doc_id": leaves["doc_id"], "leaf": leaves["leaf"], "subroot": [got.subroots[t] for t, _ in at],
            "proof_sha256": [got.proof(t, i) for t, i in at],
            "folded_root": [got.fold(t, i, d) for (t, i), d in zip(at, shown)]})

    part = F.floor(F.col("rank") / PART).alias("part")
    rows = m.leaves.select(part, "tree", "pos", "n", "doc_id", "leaf", "tampered")
    return (rows.groupBy("part").cogroup(fetched.groupBy("to")).applyInPandas(
                expand, "doc_id string, leaf string, subroot string, proof_sha256 string, folded_root string")
            .select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "leaf", "subroot", F.lit(m.root).cast("string").alias("root"), "proof_sha256", "folded_root")
            .withColumn("verified", F.col("folded_root") == F.col("root")))


_PART = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
_LEAF = "sha256(" + " || ".join(_PART.format(f) for f in FIELDS[:-1]) + " || {})"
_CRC = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS UBIGINT)],
  list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], list_transform(range(8), lambda i: CAST(0 AS UBIGINT))),
    lambda x, z: xor(x >> 1, (x & 1) * 3988292384))))"""


def _levels(name: str, first: str) -> str:
    return f"""{name} AS ({first} UNION ALL
  SELECT tree, level + 1, idx // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 16)"""


def _folds(name: str, first: str, nodes: str) -> str:
    return f"""{name} AS ({first} UNION ALL
  SELECT k, any_value(f.tree), any_value(f.level) + 1, any_value(f.idx) // 16, (any_value(f.n) + 15) // 16,
         sha256(string_agg(CASE WHEN s.idx = f.idx THEN f.digest ELSE s.digest END, '' ORDER BY s.idx))
  FROM {name} f JOIN {nodes} s ON s.tree = f.tree AND s.level = f.level AND s.idx // 16 = f.idx // 16
  WHERE f.n > 1 GROUP BY k)"""


MERKLE_SQL = f"""
WITH RECURSIVE
h AS (SELECT doc_id, source, {_LEAF.format(_PART.format("text"))} AS leaf,
             CASE WHEN {_CRC} % 5 = 0 THEN {_LEAF.format(_PART.format(f"translate(text, '{UPPER}', '{LOWER}')"))} END AS tampered
      FROM documents),
o AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS k,
             dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY source) AS n FROM h),
{_levels("b", "SELECT tree, 0 AS level, pos AS idx, n, leaf AS digest FROM o")},
{_levels("t", "SELECT CAST(-1 AS BIGINT) AS tree, 0 AS level, tree AS idx, (SELECT count(DISTINCT tree) FROM o) AS n, digest FROM b WHERE n = 1")},
v AS (SELECT o.k, 0 AS phase, s.tree, s.level, s.idx FROM o JOIN b s ON s.tree = o.tree AND s.n > 1
        AND s.idx = o.pos >> CAST(4 * s.level AS BIGINT)
      UNION ALL SELECT o.k, 1, s.tree, s.level, s.idx FROM o JOIN t s ON s.n > 1
        AND s.idx = o.tree >> CAST(4 * s.level AS BIGINT)),
nodes AS (SELECT * FROM b UNION ALL SELECT * FROM t),
p AS (SELECT v.k, string_agg(s.digest, '' ORDER BY v.phase, v.level, s.idx) AS proof
      FROM v JOIN nodes s ON s.tree = v.tree AND s.level = v.level AND s.idx // 16 = v.idx // 16 AND s.idx <> v.idx
      GROUP BY v.k),
{_folds("f", "SELECT k, tree, 0 AS level, pos AS idx, n, coalesce(tampered, leaf) AS digest FROM o", "b")},
{_folds("g", "SELECT k, CAST(-1 AS BIGINT) AS tree, 0 AS level, tree AS idx, (SELECT count(DISTINCT tree) FROM o) AS n, digest FROM f WHERE n = 1", "t")},
r AS (SELECT digest AS root FROM t WHERE n = 1)
SELECT o.doc_id, o.leaf, sub.digest AS subroot, r.root, sha256(coalesce(p.proof, '')) AS proof_sha256,
       g.digest AS folded_root, g.digest = r.root AS verified
FROM o JOIN b sub ON sub.tree = o.tree AND sub.n = 1 JOIN r ON true LEFT JOIN p ON p.k = o.k
  JOIN g ON g.k = o.k AND g.n = 1
"""
