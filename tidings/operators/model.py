"""Plug-in summarizer fold (M1-M7), round-batched in ``mapInArrow``.

A document's windows must be folded in order (each call sees the summary so
far), but documents are independent. So each Arrow batch of documents is
processed round by round: round *k* sends one request per document that
still has a window *k* and has not failed, in a single summarizer call. The
batch stays in its partition (no shuffle), model batches are large, and the
order inside each document is kept.

Plug-in protocol: ``summarizer(requests) -> replies`` where each request is
a dict with ``model``, ``messages`` (system + user, the exact prompt), the sampling
values (``temperature``, ``top_p``, ``frequency_penalty``, ``presence_penalty``), and for
plug-ins that want them ``context``, ``chunk`` and ``chunk_ix``; each reply is a ``str``, ``None`` (an error, as
a missing reply cannot be stripped) or an exception instance (that
document's error). A call that raises is repeated one request at a time, so only the requests
that fail alone fail. Failed documents get ``summary`` NULL and an ``error_kind``; other
documents go on (M6). A request that failed is not tried again.

``Kept(summarizer, path)`` is a plug-in whose replies are kept in a table, see there.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from tidings.functions.text import SENTENCE_RE, WHITESPACE
from tidings.operators.prompt import DEFAULT_FOCUS, SAMPLING, SYSTEM_PROMPT, prompt_py
from tidings.operators.render import DEFAULT_MODEL
from tidings.session import path_exists, ship_package, slices, written

# What is sent of a request; its other fields are for plug-ins that work on the window itself.
SENT = ("model", "messages", *SAMPLING)


class SummarizerError(Exception):
    """An error with a kind: connection, rate_limit, authentication,
    bad_request or api (all counted as ``api_error``)."""

    def __init__(self, kind: str, message: str = ""):
        super().__init__(message or kind)
        self.kind = kind


def error_kind(e: BaseException) -> str:
    if isinstance(e, SummarizerError):
        return e.kind
    if isinstance(e, (ConnectionError, TimeoutError)):
        return "connection"
    return "unexpected"


class LeadSentence:
    """Deterministic plug-in: the reply is the window's first sentence.

    Used to test the fold machinery end to end; its results are checkable
    in SQL (first sentence of the last window that has one)."""

    _re = re.compile(SENTENCE_RE)

    def __call__(self, requests):
        out = []
        for r in requests:
            m = self._re.search(r["chunk"] or "")
            out.append(m.group(0).strip(WHITESPACE) if m else "")
        return out


@dataclass(frozen=True)
class Kept:
    """A summarizer whose replies are kept at ``path`` (a table of thread, request, reply).

    A reply belongs to the hash of its whole request: model, prompts, sampling values. A document's
    requests are only known one after the other, since each holds the reply before; so replies are
    joined by ``thread``, a hash of the settings and of all the document's windows, and used where the request's
    own hash agrees. Documents with equal windows are one thread and are asked about
    once. New replies are appended when the fold is done, errors are not kept. So a
    rerun asks nothing that was answered; a task that is repeated before the fold is done asks again."""
    summarizer: Callable
    path: str


def request_hash(request: dict) -> str:
    return hashlib.sha256(json.dumps([request[n] for n in SENT], ensure_ascii=False).encode()).hexdigest()


def _replies(summarizer, reqs) -> list:
    """A reply or an exception for each request. A raised call is repeated one
    request at a time, so that only the requests that fail alone fail: which
    documents shared a batch makes no difference."""
    try:
        replies = list(summarizer(reqs))
        if len(replies) != len(reqs):
            raise SummarizerError("api", "reply count does not match")
        return replies
    except Exception as e:  # noqa: BLE001  (a plug-in may raise anything)
        if len(reqs) == 1:
            return [e]
    return [_replies(summarizer, [r])[0] for r in reqs]


def fold_documents(chunk_lists, summarizer, **settings):
    """Fold many documents' windows, round by round. Returns
    ``(summaries, error_kinds, n_calls)`` lists."""
    return fold_lists(chunk_lists, summarizer, **settings)[:3]


def fold_lists(chunk_lists, summarizer, focus=DEFAULT_FOCUS,
               system_prompt=SYSTEM_PROMPT, initial_context="", model=DEFAULT_MODEL, known=None):
    """`fold_documents`, with ``asked`` as a fourth list.

    ``known`` holds, for each document, replies by request hash, which are not asked for;
    ``asked`` the new ones."""
    n = len(chunk_lists)
    known = known or [{}] * n
    asked: list[dict[str, str]] = [{} for _ in range(n)]
    ctx = [initial_context or ""] * n
    err: list[str | None] = [None] * n
    calls = [0] * n
    rnd = 0
    while True:
        live = [i for i in range(n)
                if err[i] is None and rnd < len(chunk_lists[i])]
        if not live:
            break
        reqs = []
        for i in live:
            chunk = chunk_lists[i][rnd]
            user = prompt_py(focus, ctx[i], chunk)
            reqs.append({"model": model,
                         "messages": [{"role": "system", "content": system_prompt},
                                      {"role": "user", "content": user}],
                         **SAMPLING, "context": ctx[i], "chunk": chunk, "chunk_ix": rnd})
        names = [request_hash(r) for r in reqs]
        new = [j for j, i in enumerate(live) if names[j] not in known[i]]
        replies = {j: known[i][names[j]] for j, i in enumerate(live) if names[j] in known[i]}
        if new:
            replies |= zip(new, _replies(summarizer, [reqs[j] for j in new]))
        for j, i in enumerate(live):
            r = replies[j]
            calls[i] += 1
            if isinstance(r, str) and names[j] not in known[i]:
                asked[i][names[j]] = r
            if isinstance(r, BaseException):
                err[i] = error_kind(r)
            elif r is None:
                err[i] = "unexpected"
            else:
                s = str(r).strip()
                if s:
                    ctx[i] = s
        rnd += 1
    summaries = [None if err[i] else ctx[i] for i in range(n)]
    return summaries, err, calls, asked


FOLD_SCHEMA_FIELDS = [("summary", ST.StringType()), ("error_kind", ST.StringType()),
                      ("n_calls", ST.LongType())]


def model_fold(df: DataFrame, key: str, chunks_col: str, summarizer,
               focus: str = DEFAULT_FOCUS, system_prompt: str = SYSTEM_PROMPT,
               initial_context: str = "", model: str = DEFAULT_MODEL) -> DataFrame:
    """(key, summary, error_kind, n_calls) per row of ``df``.

    ``chunks_col`` is the window array from ``chunks_from_tokens``. With no
    windows the result is ``initial_context`` and no call is made (M5). With a `Kept`
    summarizer also ``n_asked``, the requests that were not answered before."""
    settings = dict(focus=focus, system_prompt=system_prompt, initial_context=initial_context, model=model)
    if isinstance(summarizer, Kept):
        return _kept_fold(df, key, chunks_col, summarizer, settings)
    return _fold(df.select(key, F.col(chunks_col).alias("chunks")), key, summarizer, settings).drop("asked")


def _fold(df: DataFrame, key: str, summarizer, settings: dict) -> DataFrame:
    """`fold_lists` over (key, chunks) and, where there is a third column, known replies;
    with the new replies as ``asked``."""
    reply = ST.MapType(ST.StringType(), ST.StringType())
    schema = ST.StructType([ST.StructField(key, df.schema[key].dataType)] +
                           [ST.StructField(n, t) for n, t in FOLD_SCHEMA_FIELDS] + [ST.StructField("asked", reply)])

    ship_package(df.sparkSession)
    return df.mapInArrow(_folder(key, summarizer, settings), schema)


def _folder(key: str, summarizer, settings: dict):
    def fold_batches(batches):
        # slice by slice, so that a worker holds the windows and requests of few documents
        for b in (s for batch in batches for s in slices(batch)):
            lists = [[c["chunk"] for c in (cs or [])] for cs in b.column(1).to_pylist()]
            known = [dict(k or []) for k in b.column(2).to_pylist()] if b.num_columns > 2 else None
            s, e, n, asked = fold_lists(lists, summarizer, known=known, **settings)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s, pa.string()), pa.array(e, pa.string()), pa.array(n, pa.int64()),
                 pa.array([list(a.items()) for a in asked], pa.map_(pa.string(), pa.string()))],
                names=[key, "summary", "error_kind", "n_calls", "asked"])
    return fold_batches


def _kept_fold(df: DataFrame, key: str, chunks_col: str, kept: Kept, settings: dict) -> DataFrame:
    spark = df.sparkSession
    fixed = hashlib.sha256(json.dumps([settings, SAMPLING], sort_keys=True).encode()).hexdigest()
    windows = F.transform(chunks_col, lambda c: F.coalesce(c["chunk"], F.lit("")))
    thread = F.sha2(F.concat_ws("\0", F.lit(fixed), F.transform(windows, lambda w: F.sha2(w, 256))), 256)
    threads = written(df.select(key, thread.alias("thread")))
    # one document stands for all with the same windows
    first = threads.groupBy("thread").agg(F.min(key).alias(key))
    rows = df.select(key, F.col(chunks_col).alias("chunks")).join(first, key).select("thread", "chunks")
    if path_exists(spark, kept.path):
        # two runs at once may both have asked
        known = (spark.read.parquet(kept.path).join(first.select("thread"), "thread", "left_semi")
                 .groupBy("thread", "request").agg(F.min("reply").alias("reply"))
                 .groupBy("thread").agg(F.map_from_entries(F.collect_list(F.struct("request", "reply"))).alias("known")))
        rows = rows.join(known, "thread", "left")
    folded = written(_fold(rows, "thread", kept.summarizer, settings))
    (folded.select("thread", F.explode("asked").alias("request", "reply"))
     .hint("rebalance").write.mode("append").parquet(kept.path))
    asked = F.when(F.col(key) == F.col("_first"), F.size("asked")).otherwise(F.lit(0)).cast("long")
    return (threads.join(folded, "thread").join(first.withColumnRenamed(key, "_first"), "thread")
            .select(key, "summary", "error_kind", "n_calls", asked.alias("n_asked")))
