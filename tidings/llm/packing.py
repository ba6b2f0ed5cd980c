"""Packing: vector bin packing of token pieces into sequences.

A sequence has three limits at once: tokens, segments, and tokens that bear
loss. Documents are tokenized whole and end with id 1; a piece of the full
length is a sequence of its own, what remains is packed one sequence at a
time: of the pieces that fit, the one whose demand vector has the largest dot product with
the room left goes in. When none fits and room for tokens remains, the largest piece is cut
to fill it. What is left of a task at its end is cut to powers of two, which
take no padding.

Each task packs the documents of its own input split, streaming: nothing is
shuffled, memory is bounded by the pool of waiting pieces, and a lost task is
repeated alone with the same sequence ids (task number and a counter).

The ids are those of the tokenizer file. Where the file is a byte-level BPE whose
ids follow its merges, its vocabulary is run by the faster of the two installed BPE
libraries, which gives the same ids; texts that hold a special token, or a run of
spaces too long for that library's expression, take the file's own library.

Loss: the first token of a segment has nothing before it to be predicted from and bears no
loss. For instruction data a column gives, for each document, how many of its first tokens are prompt and bear none either;
all others do. The three demands of a piece then differ in direction: a long prompt fills tokens, a
long answer fills the loss limit, a short piece a segment. Equal dot products: the piece that waits longest.

Defined cases: null text counts as empty and gives one piece holding id 1.
A very long text is tokenized whole and cut. A prompt length that is null or negative counts as 0,
one beyond the document as the whole of it. Repeated rows are packed each on its own, null ids too; other columns,
whatever their names, are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.common import whole_text
from tidings.session import ship_package

LONG_SPACE = re.compile(r"\s{1000}")


@dataclass(frozen=True)
class Params:
    length: int = 2048        # tokens of a sequence
    segments: int = 64        # segments of a sequence
    loss: int = 2047          # loss-bearing tokens of a sequence
    end_id: int = 1
    pool: int = 1024          # pieces that wait for a place


def merge_ranks(tokenizer) -> dict[bytes, int] | None:
    """Token bytes to id, where the file is a byte-level BPE whose ids follow its merges."""
    spec = json.loads(tokenizer.to_str())
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    if (model["type"] != "BPE" or spec["normalizer"] or before.get("type") != "ByteLevel"
            or before.get("add_prefix_space") or not before.get("use_regex", True)):
        return None
    # the printable stand-ins of byte-level BPE: printable bytes stand for themselves
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in byte_of.values())}
    vocab, merges = model["vocab"], model["merges"]
    for i, m in enumerate(merges):
        if vocab.get("".join(m if isinstance(m, list) else m.split(" "))) != 256 + i:
            return None
    return {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if i < 256 + len(merges)}


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast, ranks = None, merge_ranks(self.tokenizer)
        if ranks:
            import public_tokenizers
            import tiktoken
            self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.fast and not any(t in text for t in self.special) and not LONG_SPACE.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_ENCODERS: dict = {}


def encoder(path: str) -> Encoder:
    """One per worker process: a tokenizer file takes long to load and much memory to load again."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def bearing(start, size, prompt):
    """Loss-bearing tokens of a piece: all but its first and those of the prompt."""
    return np.maximum(0, start + size - np.maximum(start + 1, prompt))


def reach(start, prompt, loss):
    """Tokens from ``start`` on that hold at most ``loss`` loss-bearing ones."""
    return np.maximum(start + 1, prompt) + loss - start


class Packer:
    """Places pieces; ``emit(piece, start, length, sequence, offset)`` for each."""

    def __init__(self, p: Params, first_sequence: int):
        self.p, self.sequence, self.out = p, first_sequence, []
        self.waiting: list = []                    # (doc, start, size, prompt)

    def demand(self, size, loss):
        return size / self.p.length, 1 / self.p.segments, loss / self.p.loss

    def add(self, doc, total: int, prompt: int = 0) -> None:
        """Full pieces go out at once, the rest waits: where the loss limit binds, prompts may
        share the sequence. The first ``prompt`` tokens bear no loss."""
        at, full = 0, self.p.length
        while total - at >= full and reach(at, prompt, self.p.loss) >= full:
            self.out.append((doc, at, full, self.sequence, 0))
            self.sequence += 1
            at += full
        if total > at:
            self.waiting.append((doc, at, total - at, prompt))
        if len(self.waiting) >= self.p.pool:
            self.pack(self.p.pool // 2)

    def pack(self, leave: int) -> None:
        """Fill sequences until at most ``leave`` pieces wait."""
        p, items = self.p, self.waiting
        size = np.array([i[2] for i in items], np.int64)
        start = np.array([i[1] for i in items], np.int64)
        prompt = np.array([i[3] for i in items], np.int64)
        bears = bearing(start, size, prompt)
        live, n = np.ones(len(items), bool), len(items)
        while n > leave and int(size[live].sum()) >= p.length:
            room, segments, loss, offset = p.length, p.segments, p.loss, 0
            while room and segments and n:
                fits = live & (size <= room) & (bears <= loss)
                if fits.any():
                    token, segment, bear = self.demand(size, bears)
                    dot = (token * (room / p.length) + segment * (segments / p.segments)
                           + bear * (loss / p.loss))
                    i = int(np.argmax(np.where(fits, dot, -1)))
                    take = int(size[i])
                else:
                    # the piece that fills most, of those the largest
                    fill = np.where(live, np.minimum(room, reach(start, prompt, loss)), 0)
                    i = int(np.argmax(fill * (int(size.max()) + 1) + np.where(live, size, 0)))
                    take = int(fill[i])
                self.out.append((items[i][0], int(start[i]), take, self.sequence, offset))
                loss -= int(bearing(start[i], take, prompt[i]))
                start[i] += take
                size[i] -= take
                bears[i] = bearing(start[i], size[i], prompt[i])
                if not size[i]:
                    live[i] = False
                    n -= 1
                room, segments, offset = room - take, segments - 1, offset + take
            self.sequence += 1
        self.waiting = [(items[i][0], int(start[i]), int(size[i]), items[i][3]) for i in np.flatnonzero(live)]

    def finish(self) -> None:
        """Pack all; the last tokens go to sequences of power-of-two lengths."""
        self.pack(0)
        p, rest = self.p, self.waiting
        while rest:
            total = sum(r[2] for r in rest)
            room = min(1 << (total.bit_length() - 1), p.length)
            segments, loss, offset, left = p.segments, p.loss, 0, []
            for doc, start, size, prompt in rest:
                take = int(min(size, room, reach(start, prompt, loss))) if segments else 0
                if take:
                    self.out.append((doc, start, take, self.sequence, offset))
                    loss -= int(bearing(start, take, prompt))
                    room, segments, offset = room - take, segments - 1, offset + take
                if size > take:
                    left.append((doc, start + take, size - take, prompt))
            self.sequence += 1
            rest = left
        self.waiting = []


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def pack(docs: DataFrame, path: str | None = None, p: Params = Params(), prompt: str | None = None) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    loss_tokens. ``path``: the tokenizer's file, on every executor; ``prompt``: the column
    with the number of a document's first tokens that bear no loss, if there is one."""
    ship_package(docs.sparkSession)
    path = path or tokenizer_file()
    key = docs.schema["doc_id"].dataType
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")
    schema = T.StructType([T.StructField("doc_id", key)] + [T.StructField(n, T.LongType()) for n in names])

    def run(batches):
        from pyspark import TaskContext
        encode = encoder(path)
        packer = Packer(p, TaskContext.get().partitionId() << 40)
        end = np.array([p.end_id], "<u4").tobytes()
        kind = None

        def rows():
            out, packer.out = packer.out, []
            ids = pa.array([d[0] for d, *_ in out], kind)
            crc = [zlib.crc32(d[1][4 * at:4 * (at + n)]) for d, at, n, _, _ in out]
            cols = [[at for _, at, _, _, _ in out], [n for _, _, n, _, _ in out], crc,
                    [len(d[1]) // 4 for d, *_ in out], [s for *_, s, _ in out],
                    [o for *_, o in out], [int(bearing(at, n, d[2])) for d, at, n, _, _ in out]]
            return pa.RecordBatch.from_arrays([ids] + [pa.array(c, pa.int64()) for c in cols],
                                              names=("doc_id",) + names)
        for b in batches:
            kind = b.schema.field(0).type
            for doc_id, text, given in zip(*(b.column(i).to_pylist() for i in range(3))):
                ids = encode(text) + end
                total = len(ids) // 4
                unlearned = max(0, min(given or 0, total))
                packer.add((doc_id, ids, unlearned), total, unlearned)
            if packer.out:
                yield rows()
        packer.finish()
        if packer.out:
            yield rows()

    given = F.lit(0) if prompt is None else F.col("`" + prompt.replace("`", "``") + "`")
    return docs.select("doc_id", whole_text().alias("text"), given.cast("long").alias("prompt")).mapInArrow(run, schema)
