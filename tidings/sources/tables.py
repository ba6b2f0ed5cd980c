"""Parquet tables and the mail views derived from them.

The driver tables stand in for a mailbox like this:

* ``documents``: messages with a plain-text body (``doc_id`` is the message
  uid, ``source`` the sender);
* ``pages``: HTML bodies (``page_id`` joins to ``doc_id``);
* ``labels``: the read ledger, ``quality = 1`` meaning already read;
* ``conversations``: ordered model replies (``turn`` order, ``assistant``
  text is a reply, ``user`` text is a chunk).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def path(sf_dir: str, name: str) -> str:
    """A table's file, or its folder of part files."""
    return os.path.join(sf_dir, f"{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path(sf_dir, name))


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents")


def pages(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages")


def conversations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def read_ledger(spark, sf_dir) -> DataFrame:
    """Message ids already read: ``labels`` rows with ``quality = 1``."""
    return (table(spark, sf_dir, "labels")
            .where(F.col("quality") == 1)
            .select(F.col("doc_id").alias("msg_uid")))
