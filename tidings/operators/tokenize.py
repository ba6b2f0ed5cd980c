"""Plug-in tokenizers for the windows (T1-T6), run in ``mapInArrow``.

The built-in windows (``tidings.functions.chunk``) use word tokens and run
entirely in the JVM. A model-specific tokenizer (BPE and the like) plugs in
here: an object with ``encode(text) -> list`` and ``decode(tokens) -> str``.
Each Arrow batch of rows is tokenized in its own task; the window rule is
the same closed form as the built-in one, so both paths give equal windows
for equal tokens.

* T4 empty or zero-token text gives no windows;
* T3 a text that fits is passed through verbatim;
* T6 an unknown tokenizer name fails on the driver before any job runs
  (``get_tokenizer``); a text the tokenizer cannot encode gives
  ``error_kind = 'tokenizer'`` for that row only, and the run classifies it
  as ``tokenizer_error``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as ST

from tidings.session import ship_package


class TokenizerError(Exception):
    pass


class WordTokenizer:
    """Whitespace words; decode joins with single spaces."""

    def encode(self, text: str) -> list[str]:
        return text.split()

    def decode(self, tokens) -> str:
        return " ".join(tokens)


class ByteTokenizer:
    """One token per UTF-8 byte: a stand-in for byte-level BPE that needs no
    vocabulary. A window edge may cut a character; decode replaces the
    broken bytes with U+FFFD, as byte-level encodings do."""

    def encode(self, text: str) -> list[int]:
        return list(text.encode("utf-8"))

    def decode(self, tokens) -> str:
        return bytes(tokens).decode("utf-8", errors="replace")


class DisallowSpecial:
    """Wraps a tokenizer so that text holding a special token raises on
    encode, as BPE encoders do by default (that text then fails alone, as
    ``tokenizer``)."""

    def __init__(self, inner, specials=("<|endoftext|>",)):
        self.inner, self.specials = inner, tuple(specials)

    def encode(self, text: str):
        for sp in self.specials:
            if sp in text:
                raise ValueError(f"text holds the special token {sp!r}")
        return self.inner.encode(text)

    def decode(self, tokens) -> str:
        return self.inner.decode(tokens)


def get_tokenizer(name: str):
    """Resolve a tokenizer by name once, on the driver."""
    if name in ("words", "whitespace"):
        return WordTokenizer()
    if name == "bytes":
        return ByteTokenizer()
    try:
        import tiktoken
        enc = tiktoken.get_encoding(name)
    except Exception as e:  # noqa: BLE001  (unknown name or no vocabulary)
        raise TokenizerError(f"no tokenizer named {name!r}: {e}") from e
    return enc


def windows_py(text, tokenizer, m: int, o: int):
    """(n_tokens, [(chunk_ix, start_tok, n_tok, chunk)]) for one text."""
    if not text:
        return 0, []
    tokens = tokenizer.encode(text)
    n = len(tokens)
    if n == 0:
        return 0, []
    if n <= m:
        return n, [(0, 0, n, text)]
    step = m - o if m > o else (m // 2 if m > 1 else 1)
    count = (n - m + step - 1) // step + 1
    out = []
    for i in range(count):
        s = i * step
        ln = min(m, n - s)
        out.append((i, s, ln, tokenizer.decode(tokens[s:s + ln])))
    return n, out


CHUNK_STRUCT = pa.struct([("chunk_ix", pa.int32()), ("start_tok", pa.int32()),
                          ("n_tok", pa.int32()), ("chunk", pa.string())])


def tokenizer_windows(df: DataFrame, key: str, text: str, m: int, o: int,
                      tokenizer) -> DataFrame:
    """(key, n_tokens, chunks, error_kind) per row, windows cut by a plug-in
    tokenizer. ``chunks`` has the same type as the built-in windows."""
    if m < 1 or o < 0:
        raise ValueError("window settings need m >= 1 and o >= 0")
    key_type = df.schema[key].dataType
    schema = ST.StructType([
        ST.StructField(key, key_type), ST.StructField("n_tokens", ST.LongType()),
        ST.StructField("chunks", ST.ArrayType(ST.StructType([
            ST.StructField("chunk_ix", ST.IntegerType()),
            ST.StructField("start_tok", ST.IntegerType()),
            ST.StructField("n_tok", ST.IntegerType()),
            ST.StructField("chunk", ST.StringType())]))),
        ST.StructField("error_kind", ST.StringType())])

    def run(batches):
        for b in batches:
            ns, chunks, errs = [], [], []
            for t in b.column(1).to_pylist():
                try:
                    n, w = windows_py(t, tokenizer, m, o)
                    ns.append(n)
                    chunks.append([dict(zip(("chunk_ix", "start_tok", "n_tok", "chunk"), x))
                                   for x in w])
                    errs.append(None)
                except Exception:  # noqa: BLE001  (one text fails, not the job)
                    ns.append(None)
                    chunks.append(None)
                    errs.append("tokenizer")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ns, pa.int64()),
                 pa.array(chunks, pa.list_(CHUNK_STRUCT)), pa.array(errs, pa.string())],
                names=[key, "n_tokens", "chunks", "error_kind"])

    ship_package(df.sparkSession)
    return df.select(key, text).mapInArrow(run, schema)

