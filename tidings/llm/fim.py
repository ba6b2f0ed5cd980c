"""Fill-in-middle transformation as one pyarrow.compute pipeline for each batch.

A text is cut into units, a unit being a word with the white space before it (or
the white space that ends the text). Four numbers hashed from the id choose the
two cuts between units and the form: ``plain`` (the text as it is), ``psm``
(``<P>``prefix``<S>``suffix``<M>``middle) or ``spm`` (``<S>``suffix``<P>``prefix``<M>``middle).

Per batch: the units become a list array, which is flattened with its parent
indices; a unit's ordinal is its place less its parent's offset; ordinals
against the two cuts give the role; each role's units are filtered, built into
lists again and joined with ``binary_join``. No row is touched by Python alone.

Defined cases: null text counts as empty; an empty text is plain, as is one that
holds a marker itself, so that ``restored`` can rebuild any text. A text of
white space is one unit. Null ids hash as an empty id. Texts are handled whole,
``SLICE_BYTES`` of them at a time and a longer one alone, in time linear in its length.
Cuts at the same place make an empty middle; equal rows give equal results. Other
columns, whatever their names, are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.common import whole_text
from tidings.session import ship_package

P, S, M = "<P>", "<S>", "<M>"
SPACE = rb"\x20\x09-\x0D"
# 0xFF stands in no UTF-8 text, so it can mark where one unit ends and the next begins.
END = b"\xff"
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Params:
    seed: str = "42"
    rate: int = 50      # percent of texts that are transformed
    spm: int = 80       # percent of those that put the suffix first


def draws(p: Params = Params(), key: str = "doc_id") -> list[Column]:
    """Four unsigned 32-bit numbers from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{p.seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def _mod(x, m):
    return pc.subtract(x, pc.multiply(pc.divide(x, m), m))


def units_of(text: pa.Array) -> tuple[pa.ListArray, pa.Array]:
    """The texts' units, and how many each has."""
    marked = pc.replace_substring_regex(text.cast(pa.binary()), pattern=b"([^" + SPACE + b"])([" + SPACE + b"])",
                                        replacement=b"\\1" + END + b"\\2")
    units = pc.split_pattern(marked, pattern=END)
    n = pc.if_else(pc.equal(pc.binary_length(text), 0), 0, pc.list_value_length(units))
    return units, n.cast(pa.int64())


def rejoined(flat: pa.Array, keep: pa.Array, sizes: pa.Array) -> pa.Array:
    """The kept units of each text (``sizes`` of them), joined."""
    offsets = pa.array(np.r_[0, np.cumsum(sizes.to_numpy(zero_copy_only=False))], pa.int32())
    lists = pa.ListArray.from_arrays(offsets, flat.filter(keep))
    return pc.binary_join(lists, b"").cast(pa.string())


def pieces(text: pa.Array, h: list[pa.Array]) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """(number of units, prefix, middle, suffix) of each text."""
    units, n = units_of(text)
    a, b = (_mod(x, pc.add(n, 1)) for x in h[:2])
    lo, hi = pc.min_element_wise(a, b), pc.max_element_wise(a, b)
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    first = units.offsets.slice(0, len(units)).cast(pa.int64())
    place = pa.array(np.arange(len(flat), dtype=np.int64))
    ordinal = pc.subtract(pc.add(place, units.offsets[0].cast(pa.int64())), first.take(parent))
    in_prefix = pc.less(ordinal, lo.take(parent))
    # an empty text has one empty unit and no place for it
    in_suffix = pc.and_(pc.greater_equal(ordinal, hi.take(parent)), pc.less(ordinal, n.take(parent)))
    in_middle = pc.and_(pc.invert(in_prefix), pc.less(ordinal, hi.take(parent)))
    return (n, rejoined(flat, in_prefix, lo), rejoined(flat, in_middle, pc.subtract(hi, lo)),
            rejoined(flat, in_suffix, pc.subtract(n, hi)))


def transformed(batch: pa.RecordBatch, p: Params) -> pa.RecordBatch:
    text, h = batch.column("text"), [batch.column(f"h{i}") for i in range(1, 5)]
    n, prefix, middle, suffix = pieces(text, h)
    plain = pc.equal(n, 0)
    for mark in (P, S, M):
        plain = pc.or_(plain, pc.match_substring(text, mark))
    plain = pc.or_(plain, pc.greater_equal(_mod(h[2], 100), p.rate))
    spm = pc.less(_mod(h[3], 100), p.spm)
    output = pc.if_else(plain, text, pc.if_else(
        spm, pc.binary_join_element_wise(S, suffix, P, prefix, M, middle, ""),
        pc.binary_join_element_wise(P, prefix, S, suffix, M, middle, "")))
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    none = pa.scalar(None, pa.int64())
    chars = [pc.if_else(plain, none, pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), n, form, *chars, output],
                                      ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``most`` bytes of text, or one row."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def fill_in_middle(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Per row: doc_id, n (units), form, prefix_chars, middle_chars and the output text."""
    ship_package(docs.sparkSession)
    rows = docs.select("doc_id", whole_text().alias("text"), *draws(p))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                           T.StructField("output", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield transformed(part, p)

    return rows.mapInArrow(run, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output of ``form`` was made from."""
    out = F.col(output)
    front, middle = F.substring_index(out, M, 1), F.substring_index(out, M, -1)

    def halves(mark):
        """What follows the three characters of the first marker, and what follows the second marker."""
        return F.substr(F.substring_index(front, mark, 1), F.lit(4)), F.substring_index(front, mark, -1)

    prefix, suffix = halves(S)
    after, before = halves(P)
    return (F.when(F.col(form) == "psm", F.concat(prefix, middle, suffix))
            .when(F.col(form) == "spm", F.concat(before, middle, after)).otherwise(out))


def digest(docs: DataFrame) -> DataFrame:
    """`fill_in_middle` with output and rebuilt text as SHA-256."""
    return fill_in_middle(docs).select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                                       F.sha2("output", 256).alias("output_sha256"),
                                       F.sha2(restored(), 256).alias("restored_sha256"))


_UNIT = "[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+"
_NUMBER = "CAST('0x' || substr(h, {}, 8) AS UBIGINT)"
FIM_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS u,
                  sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (SELECT *, CAST(len(u) AS BIGINT) AS n,
             CAST({_NUMBER.format(1)} % CAST(len(u) + 1 AS UBIGINT) AS BIGINT) AS a,
             CAST({_NUMBER.format(9)} % CAST(len(u) + 1 AS UBIGINT) AS BIGINT) AS b,
             CASE WHEN text = '' OR contains(text, '{P}') OR contains(text, '{S}') OR contains(text, '{M}')
                       OR {_NUMBER.format(17)} % 100 >= 50 THEN 'plain'
                  WHEN {_NUMBER.format(25)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT doc_id, n, form, text, coalesce(array_to_string(u[1:least(a, b)], ''), '') AS pre,
             coalesce(array_to_string(u[least(a, b) + 1:greatest(a, b)], ''), '') AS mid,
             coalesce(array_to_string(u[greatest(a, b) + 1:], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{P}' || pre || '{S}' || suf || '{M}' || mid
                        ELSE '{S}' || suf || '{P}' || pre || '{M}' || mid END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""
