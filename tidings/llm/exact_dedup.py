"""Exact dedup: two-pass Bloom filtering, then grouping of the suspects only.

Pass one hashes every text to a block and to ``HASHES`` bits of that block,
and keeps the bits that were hit at least twice, over all rows. Pass two
checks every row against that filter: a text that occurs twice always finds
all its bits set, so a row with a bit missing is unique and passes straight
through. Only the rest (true copies and a small share of false alarms) is
shuffled and grouped by SHA-256.

The filter has ``BITS_PER_ROW`` bits a row, in blocks of 32768 bits (4 KB). Its size
is known from the row count before it is built: up to ``BROADCAST_BYTES`` it
is broadcast, beyond that the rows are joined to their block. ``copies`` hashes
each text in the scan, so that no shuffle carries a text either way; ``drop_copies``
returns whole rows, which beyond the bound move once, to their block.
Everything is DataFrame functions; a hot text is summed before each shuffle.

Defined cases: a null text equals the empty text. The row with the largest
doc_id of a group stays; null ids sort below all others, and among rows of
equal text and equal id each is reported alike, while ``drop_copies`` leaves exactly
one. A very long text is hashed whole where it is read. Extra columns, whatever their names, are ignored by the report and
carried along by ``drop_copies``. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import cut, whole_row, whole_text

BLOCK_BITS = 32768          # what bitmap_construct_agg holds
HASHES = 3
BITS_PER_ROW = 16
BROADCAST_BYTES = 64 << 20


def _places(text: Column, blocks: int) -> tuple[Column, Column]:
    """Block of a text and its bits there, from two 64-bit hashes."""
    h1, h2 = F.xxhash64(text), F.xxhash64(text, F.lit(1))
    step = F.shiftrightunsigned(h2, 40).bitwiseOR(F.lit(1))
    start = h2.bitwiseAND(F.lit(0xFFFFFF))
    bits = F.array(*[((start + step * i) % BLOCK_BITS).cast("int") for i in range(HASHES)])
    return F.pmod(h1, F.lit(blocks)), bits


def repeated_filter(docs: DataFrame, blocks: int, text: str = "text") -> DataFrame:
    """Rows (block, bits): the bits hit at least twice, 4 KB for each block that has any."""
    block, bits = _places(whole_text(text), blocks)
    hits = (docs.select(block.alias("block"), F.explode(bits).alias("bit"))
            .groupBy("block", "bit").count().where(F.col("count") > 1))
    return (hits.groupBy("block")
            .agg(F.expr("bitmap_construct_agg(bit)").alias("bits")))


def _bit_set(bitmap: Column, bit: Column) -> Column:
    byte = F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.call_function("shiftright", value, bit % 8).bitwiseAND(F.lit(1)) == 1


def mark_suspects(docs: DataFrame, text: str = "text", row: Column | None = None) -> DataFrame:
    """(row, suspect): each row as a struct (``row``, or all its columns), and whether its
    text may occur twice."""
    blocks = max(1, -(-docs.count() * BITS_PER_ROW // BLOCK_BITS))
    found = repeated_filter(docs, blocks, text)
    if blocks * BLOCK_BITS // 8 <= BROADCAST_BYTES:
        found = F.broadcast(found)
    block, bits = _places(whole_text(text), blocks)
    rows = docs.select((whole_row(docs) if row is None else row).alias("row"),
                       block.alias("own_block"), bits.alias("own"))
    every = [_bit_set(F.col("bits"), F.col("own")[i]) for i in range(HASHES)]
    suspect = F.coalesce(F.col("bits").isNotNull() & every[0] & every[1] & every[2], F.lit(False))
    return (rows.join(found, F.col("own_block") == F.col("block"), "left")
            .select("row", suspect.alias("suspect")))


def copies(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    narrow = F.struct("doc_id", F.sha2(whole_text(), 256).alias("text_sha256"))
    marked = cut(mark_suspects(docs.select("doc_id", "text"), row=narrow).select("row.*", "suspect"))
    alone = (marked.where(~F.col("suspect"))
             .select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                     F.lit(True).alias("kept"), "text_sha256"))
    again = marked.where("suspect").select("doc_id", "text_sha256")
    # written out, so that the join deals both sides anew and a hot group's rows can be split
    groups = cut(again.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"),
                                                  F.count(F.lit(1)).alias("group_size")))
    rest = (again.join(groups, "text_sha256")
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))
    return alone.unionByName(rest)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group of equal texts."""
    marked = mark_suspects(docs)
    alone = marked.where(~F.col("suspect")).select("row.*")
    again = marked.where("suspect").select(
        "row", F.sha2(whole_text("row.text"), 256).alias("sha"), F.col("row.doc_id").alias("id"))
    keep = again.groupBy("sha").agg(F.max("id").alias("keep"))
    one = (again.join(keep.withColumnRenamed("sha", "keep_sha"),
                      (F.col("sha") == F.col("keep_sha")) & F.col("id").eqNullSafe(F.col("keep")))
           .dropDuplicates(["sha"]).select("row.*"))
    return alone.unionByName(one)


COPIES_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT d.doc_id, g.keep_id, g.group_size, (d.doc_id IS NOT DISTINCT FROM g.keep_id) AS kept,
       d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
