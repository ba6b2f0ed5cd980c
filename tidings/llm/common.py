"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.session import checkpoint_root, ship_package


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the folder of ``spark.checkpoint.dir`` and read back: the
    lineage ends there, and a lost executor re-reads the files."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, whatever their names (a dot in one is part of it)."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def whole_text(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def fold_of(key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is never learned from."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5


def fold_of_id(doc_id) -> int:
    """`fold_of` for one id in Python."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def text_udf(df: DataFrame, make: Callable[[], Callable[[list[str]], list]], returns: str,
             text: str = "text") -> Column:
    """A column computed from whole texts in Arrow batches.

    ``make`` runs once per task and gives a function from a list of texts to
    a list of results of type ``returns``."""
    ship_package(df.sparkSession)
    struct = returns.startswith("struct")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        step = make()
        for texts in batches:
            yield pd.Series(step(texts.tolist()), dtype=object if returns == "string" else None)

    def run_struct(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        step = make()
        for texts in batches:
            yield pd.DataFrame(step(texts.tolist()))

    run_struct.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run_struct if struct else run, returns)(whole_text(text))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                    key: str = "doc_id") -> DataFrame:
    """Up to ``per_class`` labelled documents of each class, columns (key, text, y).

    The labels are chosen first, in the order of a hash of the id, never from
    fold 0; at most 2 * ``per_class`` ids exist then, so they are broadcast
    and the texts are not shuffled. An id with several labels counts as 1 if
    any of them is 1; rows with a null id or label are not learned from."""
    ids = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (fold_of(key) != 0))
           .groupBy(key).agg(F.max(F.col(label).cast("int")).alias("y"))
           .join(docs.where(F.col(key).isNotNull()).select(key).distinct(), key, "left_semi"))
    parts = [ids.where(F.col("y") == y).orderBy(F.xxhash64(key), key).limit(per_class)
             for y in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    return docs.select(key, whole_text().alias("text")).join(chosen, key)
