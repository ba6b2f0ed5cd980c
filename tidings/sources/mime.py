"""MIME parsing (P1, P4) as an Arrow-batched Spark job.

Parsing RFC 822 bytes has no SQL form, so each partition's batches go
through the standard library parser in ``mapInArrow``; the output is the
``parts`` array the body rules work on. Per-row Python is confined to this
one small helper, and every partition is parsed independently (no shuffle,
no driver round trip).

With ``tree=True`` the rows also carry ``tree``, the message's nodes in the same walk
order, for forwarding the whole original: parent index, depth, headers, filename, and the bytes of
what ``parts`` cannot hold as text. Bytes are kept once: a nested mail holds its own,
and the nodes below it (``mail_ix``) none.
"""

from __future__ import annotations

from email import policy
from email.parser import BytesParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from tidings.session import ship_package, slices


PART_STRUCT = pa.struct([
    ("part_ix", pa.int32()), ("content_type", pa.string()),
    ("disposition", pa.string()), ("charset", pa.string()),
    ("text", pa.string()), ("decode_ok", pa.bool_())])

NODE_STRUCT = pa.struct([
    ("part_ix", pa.int32()), ("parent_ix", pa.int32()), ("mail_ix", pa.int32()), ("depth", pa.int32()),
    ("content_type", pa.string()), ("filename", pa.string()),
    ("headers", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
    ("payload", pa.binary())])
NODE_TYPE = ("array<struct<part_ix:int,parent_ix:int,mail_ix:int,depth:int,content_type:string,filename:string,"
             "headers:array<struct<name:string,value:string>>,payload:binary>>")

# Columns beside the key, whose type is the input's.
PARSED_FIELDS = [
    ST.StructField("parse_ok", ST.BooleanType()),
    ST.StructField("sender", ST.StringType()),
    ST.StructField("subject", ST.StringType()),
    ST.StructField("is_multipart", ST.BooleanType()),
    ST.StructField("parts", ST.ArrayType(ST.StructType([
        ST.StructField("part_ix", ST.IntegerType()),
        ST.StructField("content_type", ST.StringType()),
        ST.StructField("disposition", ST.StringType()),
        ST.StructField("charset", ST.StringType()),
        ST.StructField("text", ST.StringType()),
        ST.StructField("decode_ok", ST.BooleanType())]))),
]


def _decode(part) -> tuple[str | None, bool]:
    """Declared charset, else utf-8; bad bytes replaced; an unknown charset
    or a missing payload is a failed decode."""
    try:
        payload = part.get_payload(decode=True)
        return payload.decode(part.get_content_charset() or "utf-8",
                              errors="replace"), True
    except Exception:  # noqa: BLE001  (any failure leaves the slot open)
        return None, False


_STRUCTURE = BytesParser(policy=policy.compat32)
_HEADERS = policy.default


def _header(msg, name: str) -> str | None:
    """A header as the modern policy gives it (RFC 2047 decoded, unfolded).

    The message structure is parsed with the compat32 policy, which is about
    five times faster and stores the same raw header text; only the headers
    the rules read are then decoded the way the default policy would."""
    v = msg.get(name)
    return None if v is None else str(_HEADERS.header_fetch_parse(name, v))


_WHOLE = policy.compat32.clone(linesep="\r\n", max_line_length=None)


def _clean(value) -> str | None:
    """Text without lone surrogates, which stand for undecodable header bytes."""
    return None if value is None else str(value).encode("utf-8", "replace").decode("utf-8")


def _headers(part) -> list[dict]:
    out = []
    for name, value in part.raw_items():
        try:
            value = _HEADERS.header_fetch_parse(name, value)
        except Exception:  # noqa: BLE001  (a malformed header is kept as written)
            pass
        out.append({"name": _clean(name), "value": _clean(value)})
    return out


def _filename(part) -> str | None:
    try:
        return _clean(part.get_filename())
    except Exception:  # noqa: BLE001  (a malformed parameter is no filename)
        return None


def _payload(part, nested: bool) -> bytes | None:
    """The decoded bytes of a leaf; of a nested mail its own bytes, with CRLF line ends."""
    try:
        if not nested:
            return part.get_payload(decode=True)
        whole = part.as_bytes(policy=_WHOLE)
        return whole[2:] if whole.startswith(b"\r\n") else whole.partition(b"\r\n\r\n")[2]
    except Exception:  # noqa: BLE001  (unreadable content is no payload)
        return None


def part_tree(msg, parts) -> list[dict]:
    """The nodes of a message in walk order, beside ``parts``."""
    nodes, open_ = [], [(msg, None, None, 0)]
    while open_:
        part, parent, mail, depth = open_.pop()
        ix = len(nodes)
        container, kind = part.is_multipart(), part.get_content_maintype()
        nested = container and kind == "message"
        bare = nested or (not container and not parts[ix]["decode_ok"])
        nodes.append({"part_ix": ix, "parent_ix": parent, "mail_ix": mail, "depth": depth,
                      "content_type": part.get_content_type(), "filename": _filename(part),
                      "headers": _headers(part),
                      "payload": _payload(part, nested) if bare and mail is None else None})
        if container:
            inside = ix if nested and mail is None else mail
            open_ += [(child, ix, inside, depth + 1) for child in reversed(part.get_payload())]
    return nodes


def parse_one(raw: bytes | None, tree: bool = False):
    """(parse_ok, sender, subject, is_multipart, parts) for one message, and with ``tree`` its nodes."""
    if raw is None:
        return (False, None, None, None, None) + (None,) * tree
    try:
        msg = _STRUCTURE.parsebytes(bytes(raw))
        subject = _header(msg, "Subject")
        sender = _header(msg, "From")
        parts = []
        for ix, part in enumerate(msg.walk()):
            ctype = part.get_content_type()
            disp = _header(part, "Content-Disposition")
            text, ok = (None, None)
            if part.get_content_maintype() == "text":
                text, ok = _decode(part)
            parts.append({"part_ix": ix, "content_type": ctype,
                          "disposition": None if disp is None else str(disp),
                          "charset": part.get_content_charset(),
                          "text": text, "decode_ok": ok})
        return (True, None if sender is None else str(sender),
                None if subject is None else str(subject),
                msg.is_multipart(), parts) + ((part_tree(msg, parts),) if tree else ())
    except Exception:  # noqa: BLE001  (an unparsable mail is a row outcome)
        return (False, None, None, None, None) + (None,) * tree


def _parser(tree: bool):
    def parse_batches(batches):
        parsed = [("parse_ok", pa.bool_()), ("sender", pa.string()), ("subject", pa.string()),
                  ("is_multipart", pa.bool_()), ("parts", pa.list_(PART_STRUCT))]
        parsed += [("tree", pa.list_(NODE_STRUCT))] if tree else []
        # slice by slice, so that a worker holds the parts of few messages, however many a batch has
        for b in (s for batch in batches for s in slices(batch)):
            rows = []
            for raw, envelope in zip(b.column("raw").to_pylist(), b.column("sender").to_pylist()):
                ok, sender, *rest = parse_one(raw, tree)
                rows.append((ok, sender if envelope is None else envelope, *rest))
            cols = list(zip(*rows)) or [[]] * len(parsed)
            yield pa.RecordBatch.from_arrays(
                [b.column("msg_uid")] + [pa.array(list(c), t) for c, (_, t) in zip(cols, parsed)],
                names=["msg_uid"] + [n for n, _ in parsed])
    return parse_batches


def parse_mime(raw: DataFrame, tree: bool = False) -> DataFrame:
    """``(msg_uid, raw BINARY)`` to parsed messages with ``parts``, and with ``tree`` their nodes.

    The key may be of any type. An envelope ``sender`` column, where there is
    one, is the message's sender: it is known even if the fetch or the parse
    failed. Without it the ``From`` header is."""
    ship_package(raw.sparkSession)
    sender = F.col("sender") if "sender" in raw.columns else F.lit(None).cast("string")
    key = ST.StructField("msg_uid", raw.schema["msg_uid"].dataType)
    return raw.select("msg_uid", "raw", sender.alias("sender")).mapInArrow(
        _parser(tree), ST.StructType([key] + PARSED_FIELDS + (
            [ST.StructField("tree", ST.DataType.fromDDL(NODE_TYPE))] if tree else [])))
