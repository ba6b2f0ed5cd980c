"""Delivery (K1): handing outbox rows over, with one result for each message.

A run marks messages read only after their delivery is confirmed, so delivery is a step
between writing the outbox and writing the ledger: ``deliver(outbox)`` returns
``(msg_uid, delivered, send_error)``. A refused or failing message has its own
result and holds up no other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.session import ship_package


def to_outbox(outbox: DataFrame) -> DataFrame:
    """The written outbox row is the delivery: a gateway of its own drains the table."""
    return outbox.select("msg_uid", F.lit(True).alias("delivered"), F.lit(None).cast("string").alias("send_error"))


def through(send: Callable[[dict], object]) -> Callable[[DataFrame], DataFrame]:
    """Deliver by a plug-in: ``send(message)`` gets one outbox row as a dict. False refuses
    it without an error, an exception is the message's error; anything else delivers."""
    def one(message: dict) -> tuple[bool, str | None]:
        try:
            return send(message) is not False, None
        except Exception as e:  # noqa: BLE001  (one message's failure is its own result)
            return False, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = [one(m) for m in b.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("msg_uid"), pa.array([d for d, _ in said], pa.bool_()), pa.array([e for _, e in said], pa.string())],
                ["msg_uid", "delivered", "send_error"])

    def deliver(outbox: DataFrame) -> DataFrame:
        ship_package(outbox.sparkSession)
        return outbox.mapInArrow(run, T.StructType([outbox.schema["msg_uid"], T.StructField("delivered", T.BooleanType()),
                                                    T.StructField("send_error", T.StringType())]))
    return deliver
