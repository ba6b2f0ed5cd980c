"""Mail files as a source (S1, I1): mbox archives and ``*.eml`` folders.

An mbox file is read by Spark's text source with the line ``From `` as record separator, so
a large archive is split by byte ranges like any text file and a record belongs to
the split it begins in. A record is the rest of its envelope line and the
message's bytes; text columns keep bytes as they are, so mail in any charset
survives. Sender and id are computed from the envelope line and the header block, before anything is
parsed: a filter on them keeps other messages from the parser.

Both sources give ``(msg_uid, sender, raw)`` as `run_raw` takes it, and as a
stream as `poll` takes it (``stream=True``):

* ``msg_uid``: the Message-ID without brackets, else the SHA-256 of the record; of an
  ``.eml`` file its name;
* ``sender``: the envelope line's address; of an ``.eml`` file its Return-Path, else From;
* ``raw``: the message with ``>From `` lines unquoted; null where the record ends inside its
  headers, which is a fetch that broke off (``fetch_failed``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
SEPARATOR = "\nFrom "
EPOCH = "Thu Jan  1 00:00:00 1970"
BYTES = "ISO-8859-1"      # one character a byte, both ways
# ---------------------------------------------------------------------------


def _headers(message: Column) -> Column:
    """The header block of a message held as a string of bytes, as characters of one byte."""
    block = F.substring_index(F.substring_index(message, "\r\n\r\n", 1), "\n\n", 1)
    return F.decode(block.cast("binary"), BYTES)


def _header(block: Column, name: str, value: str) -> Column:
    """The first header ``name`` whose value matches ``value`` (one group), or null."""
    return F.nullif(F.regexp_extract(block, f"(?im)^{name}:\\s*{value}", 1), F.lit(""))


def _unquoted(message: Column) -> Column:
    """The message's bytes with one ``>`` less before each ``>From ``."""
    plain = message.cast("binary")
    lines = F.regexp_replace(F.decode(plain, BYTES), "(?md)^>(>*From )", "$1")
    return F.when(F.contains(message, F.lit("\n>")) | F.startswith(message, F.lit(">")),
                  F.encode(lines, BYTES)).otherwise(plain)


def mbox_messages(records: DataFrame) -> DataFrame:
    """(msg_uid, sender, raw) from records split at `SEPARATOR` (column ``value``)."""
    record = F.when(F.startswith("value", F.lit("From ")), F.substr("value", F.lit(6))).otherwise(F.col("value"))
    line = F.substring_index(record, "\n", 1)
    # in bytes, since the text may not be UTF-8
    message = F.substr(record.cast("binary"), F.octet_length(line) + 2).cast("string")
    r = records.where(F.trim(record) != "").select(
        record.alias("record"), F.regexp_extract(line, "^(\\S*)", 1).alias("sender"), message.alias("message"))
    whole = F.contains("message", F.lit("\n\n")) | F.contains("message", F.lit("\r\n\r\n"))
    uid = F.coalesce(_header(_headers(F.col("message")), "Message-ID", "<([^>\\r\\n]*)>"),
                     # a file's last record ends with one line end more than the same record further up
                     F.sha2(F.rtrim("record", F.lit("\r\n")).cast("binary"), 256))
    return r.select(uid.alias("msg_uid"), "sender", F.when(whole, _unquoted(F.col("message"))).alias("raw"))


def mbox_files(spark: SparkSession, path: str, stream: bool = False, glob: str = "*") -> DataFrame:
    """The messages of all mbox files below ``path``."""
    return mbox_messages(mbox_records(spark, path, stream, glob))


def mbox_records(spark: SparkSession, path: str, stream: bool = False, glob: str = "*") -> DataFrame:
    """The records of all mbox files below ``path``, for `mbox_messages`."""
    reader = (spark.readStream if stream else spark.read).format("text")
    return reader.option("lineSep", SEPARATOR).option("pathGlobFilter", glob).load(path)


def eml_files(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """The messages of all ``*.eml`` files below ``path``."""
    reader = (spark.readStream if stream else spark.read).format("binaryFile")
    files = reader.option("pathGlobFilter", "*.eml").option("recursiveFileLookup", "true").load(path)
    block = _headers(F.col("content").cast("string"))
    address = "(?:[^<\\r\\n]*<)?([^<>\\s]+)"
    sender = F.coalesce(_header(block, "Return-Path", address), _header(block, "From", address))
    return files.select(F.regexp_extract("path", "([^/]+)\\.eml$", 1).alias("msg_uid"),
                        sender.alias("sender"), F.col("content").alias("raw"))


def write_mbox(raw: DataFrame, path: str) -> None:
    """Mbox files of ``(msg_uid, sender, raw)``, one for each partition: ``msg_uid`` as the
    Message-ID, and where ``raw`` is null a record that ends inside its headers."""
    head = F.concat(F.lit("From "), F.regexp_replace("sender", "\\s", "_"), F.lit(f" {EPOCH}\nMessage-ID: <"),
                    F.col("msg_uid").cast("string"), F.lit(">"))
    quoted = F.regexp_replace(F.decode("raw", BYTES), "(?md)^(>*From )", ">$1")
    line_end = F.lit("\n").cast("binary")
    body = F.coalesce(F.concat(line_end, F.encode(quoted, BYTES), line_end), F.lit("").cast("binary"))
    raw.select(F.concat(head.cast("binary"), body).cast("string").alias("value")).write.text(path)
