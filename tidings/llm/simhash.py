"""SimHash near-dedup: 64-bit fingerprints, BK-trees in shards, components.

Fingerprint: words of the ASCII-lowered text, shingles of four words (repeats
included), XXH64 of each, and per bit the majority.

Linking: two fingerprints within ``RADIUS`` = 4 bits agree on at least two of six
blocks of the 64 bits, so each of the 15 pairs of blocks is a shard key and no link
is lost. Equal fingerprints are one node. Only keys that several fingerprints
share go on; a shard is a BK-tree (children keyed by their integer distance
to the parent), and a search follows only the edges within the radius. The
trees reach the tasks by the shuffle on the shard key: all trees together
grow with the corpus, so a broadcast has no proven bound. A shard of more
than ``SHARD`` fingerprints is dealt into cells, one for each pair of its parts,
so that no task holds more than two parts of it.

A shard hands on a spanning forest of its links, never all pairs; connected
components come from star contraction on those edges, with every round
written to the checkpoint folder.

Defined cases: null text counts as empty; texts without words have
fingerprint zero and link like any other. Rows of equal text get equal
results; a row with a null id is reported but is no node, so it never names a component
(null where its fingerprint has no id at all). Other columns are ignored
by the report and carried along by ``drop_near_copies``. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.common import cut, text_udf, whole_row, whole_text
from tidings.session import ship_package

WORDS = 4
RADIUS = 4
SEED = 42
BLOCKS = (11, 11, 11, 11, 10, 10)   # bits of each block; RADIUS + 2 of them
SHARD = 2048                        # fingerprints of a tree


def fingerprint(text: str) -> int:
    """Unsigned 64-bit SimHash."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(s) for s in zip(*(words[i:] for i in range(WORDS)))]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, SEED) for s in shingles], np.uint64)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(h), 1 << 16):
        part = h[lo:lo + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big")


class BKTree:
    """Nodes are added one by one; children are keyed by their distance to the parent."""

    def __init__(self):
        self.nodes: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        own = len(self.nodes)
        self.nodes.append(value)
        self.children.append({})
        if own:
            at = 0
            while True:
                d = (self.nodes[at] ^ value).bit_count()
                if d not in self.children[at]:
                    self.children[at][d] = own
                    break
                at = self.children[at][d]
        return own

    def within(self, value: int, radius: int):
        """Nodes at most ``radius`` from ``value``."""
        todo = [0] if self.nodes else []
        while todo:
            at = todo.pop()
            d = (self.nodes[at] ^ value).bit_count()
            if d <= radius:
                yield at
            todo.extend(c for k, c in self.children[at].items() if -radius <= k - d <= radius)


def forest(values: list[int], queries: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges (i, j) that connect what the links connect: among ``values`` if there
    are no ``queries``, else between them (numbered behind the values). A search ends
    once it has met every component of the tree, so dense groups stay cheap."""
    parent = list(range(len(values) + len(queries)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    tree, edges = BKTree(), []
    if queries:
        for v in values:
            tree.add(v)
        items = [(len(values) + i, q) for i, q in enumerate(queries)]
        parts = len(values)
    else:
        items, parts = list(enumerate(values)), 0
    for i, value in items:
        met: dict[int, int] = {}
        for j in tree.within(value, radius):
            met.setdefault(root(j), j)
            if len(met) == parts:
                break
        for r, j in met.items():
            parent[r] = root(i)
            edges.append((i, j))
        if queries:
            parts -= max(0, len(met) - 1)
        else:
            parts += 1 - len(met)
            tree.add(value)
    return edges


def with_fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp): the fingerprint as a signed long; text_key tells apart rows of one id."""
    def make():
        def step(texts):
            fps = np.fromiter((fingerprint(t) for t in texts), np.uint64, len(texts))
            return fps.view(np.int64).tolist()
        return step
    return docs.select("doc_id", F.xxhash64(whole_text()).alias("text_key"),
                       text_udf(docs, make, "long").alias("fp"))


def _masks() -> list[int]:
    """One mask for each pair of blocks, as signed longs."""
    low, blocks = 0, []
    for width in BLOCKS:
        blocks.append(((1 << width) - 1) << low)
        low += width
    return [(m ^ (1 << 63)) - (1 << 63) for m in (a | b for a, b in combinations(blocks, 2))]


def links(nodes: DataFrame) -> DataFrame:
    """Edges (u, v) of node ids, a spanning forest for each shard. ``nodes``: (fp, node)."""
    ship_package(nodes.sparkSession)
    keyed = (nodes.select("fp", "node", F.explode(F.array(*[
        F.struct(F.lit(i).alias("pair"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
        for i, m in enumerate(_masks())])).alias("key")).select("fp", "node", "key.*"))
    shared = (keyed.groupBy("pair", "bits").count().where(F.col("count") > 1)
              .select("pair", "bits", F.ceil(F.col("count") / SHARD).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    cells = (keyed.join(shared, ["pair", "bits"]).withColumn("part", part)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("pair", "bits", F.least("part", "other").alias("a"),
                     F.greatest("part", "other").alias("b"), "part", "fp", "node")
             .repartition("pair", "bits", "a", "b")
             .sortWithinPartitions("pair", "bits", "a", "b", "part", "fp"))
    kind = nodes.schema["node"].dataType

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        """Edges of whole cells, rows sorted by cell."""
        key = rows[["pair", "bits", "a", "b"]].to_numpy()
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
        fps = rows["fp"].to_numpy().view(np.uint64).tolist()
        part, node, u, v = rows["part"].to_numpy(), rows["node"].to_numpy(), [], []
        for lo, hi in zip(first, [*first[1:], len(rows)]):
            a, b = key[lo, 2], key[lo, 3]
            mid = lo + int((part[lo:hi] == a).sum()) if a != b else hi
            for i, j in forest(fps[lo:mid], fps[mid:hi]) if a == b or mid < hi else ():
                u.append(node[lo + i])
                v.append(node[lo + j])
        return pd.DataFrame({"u": u, "v": v})

    def run(batches):
        rest = None
        for rows in batches:
            if rest is not None:
                rows = pd.concat([rest, rows], ignore_index=True)
            key = rows[["pair", "bits", "a", "b"]].to_numpy()
            if not len(key):
                continue
            same = (key == key[-1]).all(1)
            last = len(key) if same.all() else len(key) - int(np.argmin(same[::-1]))
            whole, rest = (rows.iloc[:0], rows) if same.all() else (
                rows.iloc[:last].reset_index(drop=True), rows.iloc[last:].reset_index(drop=True))
            if len(whole):
                yield solve(whole)
        if rest is not None and len(rest):
            yield solve(rest)

    schema = T.StructType([T.StructField("u", kind), T.StructField("v", kind)])
    return cells.mapInPandas(run, schema).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for each node with an edge.

    Star contraction: large stars, then small stars, until nothing changes.
    Edges point from the larger to the smaller node."""
    edges = cut(edges)

    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = state(edges)
    while now[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").where(F.col("u") != F.col("v")).distinct())
        edges = cut(small)
        before, now = now, state(edges)
        if before == now:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp, component_id) per row."""
    fps = cut(with_fingerprint(docs))
    nodes = fps.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("node"))
    found = components(links(nodes))
    named = (nodes.join(found, "node", "left")
             .select("fp", F.coalesce("component", "node").alias("component_id")))
    return fps.join(named, "fp", "left")


def near_copies(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    return _grouped(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each component, all columns: that with the smallest doc_id (nulls last),
    then text hash; one of equal rows. Texts whose rows have null ids alone are linked too."""
    fps = cut(with_fingerprint(docs))
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
                   F.col("text_key").alias("key"))
    nodes = cut(fps.groupBy("fp").agg(F.min(own).alias("least")).withColumn("node", F.col("fp")))
    named = cut(nodes.join(components(links(nodes.select("fp", "node"))), "node", "left")
                .select("fp", "least", F.coalesce("component", "node").alias("component")))
    stays = (named.groupBy("component").agg(F.min("least").alias("stays"))
             .select(F.col("stays.id").alias("doc_id"), F.col("stays.key").alias("text_key"),
                     F.lit(True).alias("stays")))

    def same(a_id, a_key, b_id, b_key):
        return F.col(a_id).eqNullSafe(F.col(b_id)) & (F.col(a_key) == F.col(b_key))

    pairs = fps.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    other = cut(pairs.alias("p").join(stays.alias("s"), same("p.doc_id", "p.text_key", "s.doc_id", "s.text_key"), "left")
                .where(F.col("stays").isNull() | (F.col("n") > 1))
                .select(F.col("p.doc_id").alias("of_id"), F.col("p.text_key").alias("of_key"),
                        F.col("stays").isNotNull().alias("repeated")))
    rows = docs.select(whole_row(docs).alias("row"),
                       F.col("doc_id").alias("id"), F.xxhash64(whole_text()).alias("key"))
    left = rows.join(other, same("id", "key", "of_id", "of_key"), "left_anti").select("row.*")
    repeated = other.where("repeated")
    if repeated.isEmpty():
        return left
    one = (rows.join(repeated, same("id", "key", "of_id", "of_key"), "left_semi")
           .groupBy("id", "key").agg(F.first("row").alias("row")))
    return left.unionAll(one.select("row.*"))
