"""Settings as a table keyed by subscription.

One JSON object per subscription (a file per subscription, or a column of
JSON text). The reference re-reads its one settings file for every key; here
the objects are read once, turned into a long table
``(subscription, key, value, json_type)`` and from there:

* ``resolve``: one row per subscription, one column per known key: absent or
  JSON null takes the default (C1), later keys override the required set
  (C6), three integers are cast and one flag is read (C3);
* ``rejects``: subscriptions that cannot run and why: unreadable JSON (C5),
  a required key absent or null (C2; an empty string passes), a bad integer,
  bad window settings;
* ``masked``: the long table for display, secrets shown as ``******`` (C4).

Subscriptions are independent rows: one bad subscription is rejected while
the others run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions.chunk import DEFAULT_MAX_TOKENS, DEFAULT_OVERLAP_RUN
from tidings.operators.prompt import SYSTEM_PROMPT
from tidings.operators.render import DEFAULT_MODEL

# --- fixed values -----------------------------------------------------------
REQUIRED_KEYS = ("gmail_user", "gmail_app_pass", "openai_api_key",
                 "target_email", "stratechery_sender_email")
OPTIONAL_NO_DEFAULT = ("forward_original_email", "openai_model_name",
                       "system_prompt")
DEFAULTS = {
    "imap_host": "imap.gmail.com",
    "smtp_host": "smtp.gmail.com",
    "smtp_port": "465",
    "openai_model_name": DEFAULT_MODEL,
    "max_tokens_per_chunk": str(DEFAULT_MAX_TOKENS),
    "chunk_overlap_tokens": str(DEFAULT_OVERLAP_RUN),
    "system_prompt": SYSTEM_PROMPT,
    "forward_original_email": "true",
    "prompt_focus": "",
}
INT_KEYS = ("smtp_port", "max_tokens_per_chunk", "chunk_overlap_tokens")
FLAG_KEYS = ("forward_original_email",)
# Keys whose string values are hidden in displays. 'pass' is added to the
# words the reference masks, so an app password is hidden too.
SECRET_KEY_RE = "pass|secret|key|token"
MASK = "******"
# ---------------------------------------------------------------------------

KNOWN_KEYS = tuple(dict.fromkeys(REQUIRED_KEYS + OPTIONAL_NO_DEFAULT + tuple(DEFAULTS)))


def read_settings_files(spark: SparkSession, path: str) -> DataFrame:
    """(subscription, raw): one JSON file per subscription, named
    ``<subscription>.json``, read whole."""
    df = spark.read.text(path, wholetext=True, pathGlobFilter="*.json")
    return df.select(
        F.regexp_extract(F.input_file_name(), "([^/]+)\\.json$", 1).alias("subscription"),
        F.col("value").alias("raw"))


def _object_ok(raw: Column) -> Column:
    """True when ``raw`` is a JSON object."""
    v = F.try_parse_json(raw)
    return v.isNotNull() & F.startswith(F.schema_of_variant(v), F.lit("OBJECT<"))


def settings_long(raw_df: DataFrame) -> DataFrame:
    """(subscription, key, value, json_type). ``value`` is the JSON value as
    text (NULL for JSON null); ``json_type`` is STRING, BOOLEAN, BIGINT, ...
    or VOID for null. Unreadable objects give no rows (see ``rejects``)."""
    ok = raw_df.where(_object_ok(F.col("raw"))).withColumn("object", F.try_parse_json("raw"))
    entries = raw_df.sparkSession.tvf.variant_explode(F.col("object").outer())
    return ok.lateralJoin(entries).select(
        "subscription", "key", F.col("value").cast("string").alias("value"),
        F.schema_of_variant("value").alias("json_type"))


def _pivot(long_df: DataFrame) -> DataFrame:
    """One row per subscription, one column per known key (raw text).
    The pivot values are listed, so no extra job is run to find them."""
    return (long_df.where(F.col("key").isin(*KNOWN_KEYS))
            .groupBy("subscription").pivot("key", list(KNOWN_KEYS))
            .agg(F.first("value")))


def resolve(long_df: DataFrame) -> DataFrame:
    """Effective settings per subscription, typed."""
    p = _pivot(long_df)
    cols = [F.col("subscription")]
    for k in KNOWN_KEYS:
        raw = F.col(f"`{k}`")
        v = F.coalesce(raw, F.lit(DEFAULTS[k])) if k in DEFAULTS else raw
        if k in INT_KEYS:
            # A present value that is not an integer stays NULL (a reject).
            v = F.coalesce(F.expr(f"try_cast(`{k}` AS INT)"),
                           F.when(raw.isNull(), F.lit(int(DEFAULTS[k]))))
        elif k in FLAG_KEYS:
            v = F.lower(v) == F.lit("true")
        cols.append(v.alias(k))
    return p.select(*cols)


def rejects(raw_df: DataFrame) -> DataFrame:
    """(subscription, reason) for every subscription that cannot
    run; a subscription may have several reasons."""
    bad_json = raw_df.where(~_object_ok(F.col("raw"))).select(
        "subscription", F.lit("bad_json").alias("reason"))
    long_df = settings_long(raw_df)
    present = long_df.where(F.col("value").isNotNull()).select("subscription", "key")
    subs = raw_df.where(_object_ok(F.col("raw"))).select("subscription")
    required = subs.select("subscription", F.explode(F.array(
        *[F.lit(k) for k in REQUIRED_KEYS])).alias("key"))
    missing = required.join(present, ["subscription", "key"], "left_anti").select(
        "subscription", F.concat(F.lit("missing:"), "key").alias("reason"))
    r = resolve(long_df)
    p = _pivot(long_df)
    bad_int = None
    for k in INT_KEYS:
        b = p.where(F.col(f"`{k}`").isNotNull()
                    & F.expr(f"try_cast(`{k}` AS INT)").isNull()).select(
            "subscription", F.lit(f"bad_int:{k}").alias("reason"))
        bad_int = b if bad_int is None else bad_int.unionByName(b)
    bad_window = r.where((F.col("max_tokens_per_chunk") < 1)
                         | (F.col("chunk_overlap_tokens") < 0)).select(
        "subscription", F.lit("bad_window").alias("reason"))
    return bad_json.unionByName(missing).unionByName(bad_int).unionByName(bad_window)


def runnable(raw_df: DataFrame) -> DataFrame:
    """Resolved settings of the subscriptions with no reject reason."""
    return resolve(settings_long(raw_df)).join(
        rejects(raw_df).select("subscription").distinct(), "subscription", "left_anti")


def masked(long_df: DataFrame) -> DataFrame:
    """C4: (subscription, key, shown) with secret string values hidden."""
    secret = F.lower("key").rlike(SECRET_KEY_RE) & (F.col("json_type") == "STRING")
    return long_df.select("subscription", "key",
                          F.when(secret, F.lit(MASK)).otherwise(F.col("value"))
                          .alias("shown"))
