"""The digest run: unread mail in, outbox rows and outcomes out.

The plan of a run (the staged messages are written while it is built):

    messages ─ sender filter ─ anti join ledger ─ body ─ windows ─┐
                                                                  ├─ summary ─ render ─ outbox
    (extractive sections, or a plug-in model fold) ───────────────┘      └─ outcomes ─ ledger

``commit_run`` writes the outbox, delivers it, and publishes outbox, outcomes and
ledger in one step, so a failure anywhere leaves messages unread and
the next run picks them up again (at-least-once, never lost).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions.chunk import (DEFAULT_MAX_TOKENS, DEFAULT_OVERLAP_RUN, chunk_count, chunk_text,
                                     settings_ok)
from tidings.functions.text import n_words
from tidings.operators import extractive as X
from tidings.operators.balance import balanced
from tidings.operators.body import select_body, subject_or_fallback
from tidings.operators.deliver import to_outbox
from tidings.operators.outcomes import classify, confirm_sends
from tidings.operators.prompt import DEFAULT_FOCUS, SYSTEM_PROMPT
from tidings.operators.render import (DEFAULT_MODEL, ELEMENT_TYPE, SUBJECT_PREFIX, digest_subject,
                                      info_header, inject_header, original_elements)
from tidings.operators.state import delivered_ids, unread_from_sender
from tidings.operators.tokenize import get_tokenizer, tokenizer_windows
from tidings.session import deal_by_key, materialize_by_key
from tidings.sources.mime import parse_mime
from tidings.sources.run_store import RunStore


OUTCOME_COLS = ("msg_uid", "sender", "subject", "status", "n_chars", "n_tokens", "n_chunks")


@dataclass(frozen=True)
class RunConfig:
    """Resolved settings of one subscription (see ``tidings.operators.settings``)."""
    sender: str
    from_addr: str = ""
    to_addr: str = ""
    model: str = DEFAULT_MODEL
    max_tokens: int = DEFAULT_MAX_TOKENS
    overlap: int = DEFAULT_OVERLAP_RUN
    forward: bool = True
    focus: str = DEFAULT_FOCUS
    system_prompt: str = SYSTEM_PROMPT
    subject_prefix: str = SUBJECT_PREFIX
    initial_context: str = ""
    # "words": the built-in JVM word windows; another name is resolved by
    # ``tokenize.get_tokenizer``; an object with encode/decode is used as is.
    tokenizer: object = "words"

    def __post_init__(self):
        """Bad window settings stop a run before any action."""
        if self.max_tokens is None or self.max_tokens < 1 or self.overlap is None or self.overlap < 0:
            raise ValueError(f"windows of {self.max_tokens} tokens with an overlap of {self.overlap}: at least 1 and 0 are needed")


def stage(messages: DataFrame, ledger: DataFrame, cfg: RunConfig,
          selected: bool = False, dealt: bool = False) -> DataFrame:
    """Unread messages of the sender with body, subject and windows.

    ``messages`` has ``msg_uid, sender, subject, is_multipart, parts`` and
    optionally ``parse_ok`` (from the MIME job); ``selected`` says that they
    are the sender's unread ones already, ``dealt`` that the rows are to be dealt by message
    before any work on their text. A plug-in tokenizer is
    resolved here, on the driver, so an unknown name stops the run before
    any job (T6); a text it cannot encode gets NULL windows, which the
    outcome rules report as ``tokenizer_error`` for that message only."""
    tokenizer = cfg.tokenizer
    if isinstance(tokenizer, str) and tokenizer != "words":
        tokenizer = get_tokenizer(tokenizer)
    u = messages if selected else unread_from_sender(messages, ledger, cfg.sender)
    if "parse_ok" not in u.columns:
        u = u.withColumn("parse_ok", F.lit(True))
    if dealt:
        # below the body and window projections, so that whole messages move once and
        # neither the windows nor the work of cutting them depends on the source's splits
        u = deal_by_key(u, "msg_uid")
    b = select_body(u).withColumn("subject", subject_or_fallback("subject", "msg_uid"))
    if tokenizer == "words":
        c = chunk_text(b, "body", cfg.max_tokens, cfg.overlap)
        n_tokens = F.coalesce(F.size("tok"), F.lit(0))
    else:
        w = tokenizer_windows(b, "msg_uid", "body", cfg.max_tokens, cfg.overlap, tokenizer)
        c = b.join(w.drop("error_kind").withColumnRenamed("n_tokens", "tok"),
                   "msg_uid", "left")
        n_tokens = F.coalesce(F.col("tok"), F.lit(0))
    return (c.withColumn("n_chars", F.coalesce(F.length("body"), F.lit(0)).cast("bigint"))
             .withColumn("n_tokens", n_tokens.cast("bigint"))
             .withColumn("n_chunks", F.coalesce(F.size("chunks"), F.lit(0)).cast("bigint"))
             .drop("tok"))


def extractive_summaries(staged: DataFrame, key: str = "msg_uid") -> DataFrame:
    """(key, summary, error_kind): the built-in summarizer's HTML fragment.

    Term weights are over this run's bodies; windows come from the staged
    ``chunks`` column, so the body is tokenized once. Rows without a body
    or windows need no filter: they yield no terms, sentences or windows.
    (A filter here would be pushed below the staging projections with the
    body and window expressions inlined into it.)"""
    d = staged.select(key, F.col("body").alias("text"), "chunks")
    sec = X.sections(d, X.term_weights(d, key), key)
    return sec.select(key, X.digest_html(X.title_of("text"), X.date_of("text"), "picked", "keywords", "detailed")
                      .alias("summary"), F.lit(None).cast("string").alias("error_kind"))


def finish(staged: DataFrame, summaries: DataFrame, cfg: RunConfig,
           materialize: bool = False):
    """(outbox, outcomes) from staged messages and their summaries.

    Both outputs need the summary (the status depends on it). With
    ``materialize`` the per-message result is written once to the shared
    checkpoint folder, so writing the outbox and the outcomes does not run
    the summary plan twice."""
    r = staged.join(summaries, "msg_uid", "left")
    status = classify("parse_ok", "body", "chunks", "error_kind", "summary")
    r = r.withColumn("status", status)
    if materialize:
        r = r.checkpoint(eager=True)
    outcomes = r.select(*OUTCOME_COLS, F.coalesce(F.length("summary"), F.lit(0)).cast("bigint").alias("summary_chars"))
    original = (original_elements("parts", "is_multipart", "tree" if "tree" in r.columns else None)
                if cfg.forward else F.lit(None).cast(ELEMENT_TYPE))
    outbox = r.where(F.col("status") == "sent").select(
        "msg_uid", F.lit(cfg.from_addr).alias("from_addr"),
        F.lit(cfg.to_addr).alias("to_addr"),
        digest_subject("subject", cfg.subject_prefix).alias("subject"),
        inject_header(F.col("summary"), info_header(cfg.model)).alias("html"),
        original.alias("original"))
    return outbox, outcomes


def run_digest(messages: DataFrame, ledger: DataFrame, cfg: RunConfig,
               summarizer=None, materialize: bool = True, both_outputs: bool = False,
               selected: bool = False):
    """Plan one run. ``summarizer`` is a plug-in for ``model_fold``; without
    one the built-in extractive sections are used.

    The staged messages feed three branches (term weights and sentences,
    windows, the final join). With ``materialize`` they are written once to
    the shared checkpoint folder (``spark.checkpoint.dir``), so the scan, the
    full join and the anti join run once, and a lost executor re-reads the
    checkpoint instead of recomputing the lineage. ``both_outputs`` (set
    when the caller writes outbox and outcomes) also materializes the
    per-message result, so the summary plan runs once for both writes."""
    staged = stage(messages, ledger, cfg, selected, dealt=materialize)
    if materialize:
        # bucketed by message: the summary steps keyed by message reuse that
        staged = materialize_by_key(staged, "msg_uid", "tidings_staged")
    if summarizer is None:
        sums = extractive_summaries(staged)
    else:
        from tidings.operators.model import model_fold
        # Rows without windows make no model call (M5), so no filter.
        sums = model_fold(balanced(staged.select("msg_uid", "chunks", "n_chunks"), "msg_uid", "n_chunks"),
                          "msg_uid", "chunks", summarizer, focus=cfg.focus,
                          system_prompt=cfg.system_prompt,
                          initial_context=cfg.initial_context, model=cfg.model)
        if materialize:
            # A hosted model need not answer the same twice: write the replies
            # once, so a retried downstream task reads them instead of asking
            # again and getting different text.
            sums = sums.checkpoint(eager=True)
    return finish(staged, sums, cfg, materialize and both_outputs)


def run_statuses(messages: DataFrame, ledger: DataFrame, cfg: RunConfig, selected: bool = False) -> DataFrame:
    """The outcomes of a run with the built-in summarizer, without ``summary_chars`` and
    without the summaries: whether one comes out empty shows from the body alone
    (`extractive.has_digest`), so no term statistics are needed, and the number of
    word windows from the number of words, so none is cut."""
    if cfg.tokenizer != "words":
        staged = stage(messages, ledger, cfg, selected)
    else:
        u = messages if selected else unread_from_sender(messages, ledger, cfg.sender)
        u = u if "parse_ok" in u.columns else u.withColumn("parse_ok", F.lit(True))
        b = select_body(u).withColumn("subject", subject_or_fallback("subject", "msg_uid"))
        n_chunks = F.when(settings_ok(cfg.max_tokens, cfg.overlap),
                          chunk_count("n_tokens", cfg.max_tokens, cfg.overlap))
        staged = (b.withColumn("n_tokens", n_words("body"))
                  .withColumn("n_chars", F.coalesce(F.length("body"), F.lit(0)).cast("bigint"))
                  .withColumn("chunks", F.array_repeat(F.lit(0), n_chunks))
                  .withColumn("n_chunks", F.coalesce(n_chunks, F.lit(0)).cast("bigint")))
    summary = F.when(X.has_digest("body"), F.lit("x"))
    status = classify("parse_ok", "body", "chunks", F.lit(None).cast("string"), summary)
    return staged.withColumn("status", status).select(*OUTCOME_COLS)


def run_raw(raw: DataFrame, ledger: DataFrame, cfg: RunConfig, summarizer=None, **options):
    """A run over raw mail ``(msg_uid, sender, raw)``: the envelope's sender and
    the ledger choose the messages before anything is parsed, so only those
    are parsed and a failed fetch keeps its row (``fetch_failed``). Where the original is
    forwarded, its attachments, nested mails and headers go along."""
    mine = unread_from_sender(raw, ledger, cfg.sender)
    return run_digest(parse_mime(mine, tree=cfg.forward), ledger, cfg, summarizer, selected=True, **options)


def raw_statuses(raw: DataFrame, ledger: DataFrame, cfg: RunConfig) -> DataFrame:
    """`run_statuses` over raw mail, chosen before it is parsed as in `run_raw`."""
    return run_statuses(parse_mime(unread_from_sender(raw, ledger, cfg.sender)), ledger, cfg, selected=True)


def config_from_settings(row) -> RunConfig:
    """A ``RunConfig`` from one row of ``settings.resolve`` (a subscription
    that ``settings.rejects`` does not list)."""
    return RunConfig(sender=row["stratechery_sender_email"],
                     from_addr=row["gmail_user"], to_addr=row["target_email"],
                     model=row["openai_model_name"],
                     max_tokens=row["max_tokens_per_chunk"],
                     overlap=row["chunk_overlap_tokens"],
                     forward=bool(row["forward_original_email"]),
                     focus=row["prompt_focus"], system_prompt=row["system_prompt"])


def commit_run(store: RunStore, run_id: str, messages: DataFrame, ledger: DataFrame, cfg: RunConfig,
               summarizer=None, deliver=to_outbox, plan=run_digest, keep=None) -> bool:
    """One run, delivered and published; False if ``run_id`` is published already.

    The outbox is written, its rows are delivered, and only confirmed deliveries
    enter the ledger. Outbox, send results, outcomes, ledger and ``retry`` (the rows of ``keep`` whose message
    was not delivered, with its ``attempts`` if the outcomes count them) show together, when the run's manifest is published. Of a run that died
    before that nothing shows; its rerun delivers what no earlier attempt's send results
    confirm. (A delivery whose attempt died while sending is not known of: at least once.)"""
    if store.published(run_id):
        return False
    attempt = store.begin(run_id)
    outbox, outcomes = plan(messages, ledger, cfg, summarizer, both_outputs=True)
    outbox = attempt.write("outbox", outbox)
    before, open_ = None, outbox
    if earlier := store.attempted("sends", run_id):
        before = outbox.sparkSession.read.parquet(*earlier).where("delivered").select(
            "msg_uid", "delivered", "send_error").dropDuplicates(["msg_uid"])
        open_ = outbox.join(before, "msg_uid", "left_anti")
    sends = deliver(open_)
    sends = attempt.write("sends", sends if before is None else sends.unionByName(before))
    outcomes = attempt.write("outcomes", confirm_sends(outcomes, sends))
    attempt.write("ledger", delivered_ids(outcomes).hint("rebalance"))
    if keep is not None:
        failed = outcomes.where(F.col("status") != "sent").select("msg_uid", *[c for c in outcomes.columns if c == "attempts"])
        attempt.write("retry", keep.join(failed, "msg_uid"))
    attempt.publish()
    store.compact_if_due()
    return True


def run_and_write(messages: DataFrame, ledger: DataFrame, cfg: RunConfig, out_dir: str, run_id: str,
                  summarizer=None, deliver=to_outbox, plan=run_digest) -> RunStore:
    """One batch run into the store at ``out_dir``. ``ledger`` is what was read before the
    store began; what the store's runs delivered counts as read too."""
    store = RunStore(messages.sparkSession, out_dir)
    own = store.ledger(messages.schema["msg_uid"].dataType, messages).select("msg_uid")
    commit_run(store, run_id, messages, ledger.select("msg_uid").unionByName(own), cfg, summarizer, deliver, plan)
    return store
