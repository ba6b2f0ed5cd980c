"""Queries over settings (S5, C1-C6): one JSON object for each sender in
``documents``, some of them spoilt by rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.functions.chunk import DEFAULT_OVERLAP_RUN
from tidings.operators import settings as S
from tidings.operators.render import DEFAULT_MODEL
from tidings.operators.subscriptions import match_subscriptions
from tidings.plans.registry import query
from tidings.sources import tables as T

# --- fixed values -----------------------------------------------------------
# Variant of a sender's object, by the first four hex digits of md5(source) % 6:
#   1 an object below "extra" repeats a key of the outer one; forwarding is JSON false
#   2 gmail_app_pass is JSON null and target_email absent; forwarding is 'TRUE'
#   3 smtp_port is 'abc'
#   4 max_tokens_per_chunk is '0'
#   5 unreadable JSON
VARIANT_MOD = 6
BROKEN = "{not json"
# ---------------------------------------------------------------------------


def settings_source(spark, sf_dir):
    """(subscription, raw)."""
    s = T.documents(spark, sf_dir).where(F.col("source").isNotNull()).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"))
    v = F.conv(F.substring(F.md5("source"), 1, 4), 16, 10).cast("int") % VARIANT_MOD
    s = s.withColumn("v", v)
    v = F.col("v")
    obj = F.to_json(F.struct(
        F.when(v == 1, F.struct(F.lit("inner").alias("gmail_user"))).alias("extra"),
        F.col("source").alias("gmail_user"),
        F.when(v != 2, F.lit("p-41")).alias("gmail_app_pass"),
        F.lit("k-77").alias("openai_api_key"),
        F.when(v != 2, F.lit("digest@localhost")).alias("target_email"),
        F.col("source").alias("stratechery_sender_email"),
        F.when(v == 3, F.lit("abc")).alias("smtp_port"),
        F.when(v == 4, F.lit("0")).otherwise(F.col("n").cast("string")).alias("max_tokens_per_chunk"),
        F.when(v == 2, F.lit("TRUE")).alias("forward_original_email")))
    head = F.when(v == 1, F.lit('{"forward_original_email":false,')) \
            .when(v == 2, F.lit('{"gmail_app_pass":null,')).otherwise(F.lit("{"))
    raw = F.when(v == 5, F.lit(BROKEN)).otherwise(F.concat(head, F.substr(obj, F.lit(2))))
    return s.select(F.col("source").alias("subscription"), raw.alias("raw"))


SQL_SOURCE = f"""
s AS (SELECT source, count(*) AS n, ('0x' || substr(md5(source), 1, 4))::INT % {VARIANT_MOD} AS v
      FROM documents WHERE source IS NOT NULL GROUP BY source)"""


@query("settings_resolve", f"""
WITH {SQL_SOURCE}
SELECT source AS subscription, source AS gmail_user, source AS sender,
       CASE WHEN v <> 2 THEN 'p-41' END AS app_pass, CASE WHEN v <> 2 THEN 'digest@localhost' END AS target_email,
       CAST(CASE WHEN v <> 3 THEN {S.DEFAULTS['smtp_port']} END AS INTEGER) AS smtp_port,
       CAST(CASE WHEN v = 4 THEN 0 ELSE n END AS INTEGER) AS max_tokens,
       CAST({DEFAULT_OVERLAP_RUN} AS INTEGER) AS overlap,
       v <> 1 AS forward, '{DEFAULT_MODEL}' AS model, '{S.DEFAULTS['imap_host']}' AS imap_host
FROM s WHERE v <> 5
""")
def q_settings_resolve(spark, sf_dir):
    r = S.resolve(S.settings_long(settings_source(spark, sf_dir)))
    return r.select("subscription", "gmail_user", F.col("stratechery_sender_email").alias("sender"),
                    F.col("gmail_app_pass").alias("app_pass"), "target_email", "smtp_port",
                    F.col("max_tokens_per_chunk").alias("max_tokens"),
                    F.col("chunk_overlap_tokens").alias("overlap"),
                    F.col("forward_original_email").alias("forward"),
                    F.col("openai_model_name").alias("model"), "imap_host")


@query("settings_rejects", f"""
WITH {SQL_SOURCE}
SELECT source AS subscription,
       unnest(CASE v WHEN 2 THEN ['missing:gmail_app_pass', 'missing:target_email']
                     WHEN 3 THEN ['bad_int:smtp_port'] WHEN 4 THEN ['bad_window'] ELSE ['bad_json'] END) AS reason
FROM s WHERE v BETWEEN 2 AND 5
""")
def q_settings_rejects(spark, sf_dir):
    return S.rejects(settings_source(spark, sf_dir))


@query("settings_masked", f"""
WITH {SQL_SOURCE},
k AS (SELECT source, unnest([
        {{'key': 'extra', 'shown': '{{"gmail_user":"inner"}}', 'there': v = 1}},
        {{'key': 'gmail_user', 'shown': source, 'there': true}},
        {{'key': 'gmail_app_pass', 'shown': CASE WHEN v <> 2 THEN '{S.MASK}' END, 'there': true}},
        {{'key': 'openai_api_key', 'shown': '{S.MASK}', 'there': true}},
        {{'key': 'target_email', 'shown': 'digest@localhost', 'there': v <> 2}},
        {{'key': 'stratechery_sender_email', 'shown': source, 'there': true}},
        {{'key': 'smtp_port', 'shown': 'abc', 'there': v = 3}},
        {{'key': 'max_tokens_per_chunk', 'shown': '{S.MASK}', 'there': true}},
        {{'key': 'forward_original_email', 'shown': CASE WHEN v = 1 THEN 'false' ELSE 'TRUE' END,
          'there': v IN (1, 2)}}]) AS e
      FROM s WHERE v <> 5)
SELECT source AS subscription, e.key AS key, e.shown AS shown FROM k WHERE e.there
""")
def q_settings_masked(spark, sf_dir):
    return S.masked(S.settings_long(settings_source(spark, sf_dir)))


@query("settings_messages", f"""
WITH {SQL_SOURCE}
SELECT s.source AS subscription, CAST(n AS INTEGER) AS max_tokens, v <> 1 AS forward, d.doc_id AS msg_uid
FROM s JOIN documents d ON contains(lower(d.source), lower(s.source)) WHERE v IN (0, 1)
""")
def q_settings_messages(spark, sf_dir):
    """The messages of every subscription that can run, in one pass."""
    ready = S.runnable(settings_source(spark, sf_dir))
    msgs = T.documents(spark, sf_dir).select(F.col("doc_id").alias("msg_uid"),
                                             F.col("source").alias("sender"))
    pairs = match_subscriptions(msgs, ready, pattern="stratechery_sender_email")
    return pairs.join(ready, "subscription").select(
        "subscription", F.col("max_tokens_per_chunk").alias("max_tokens"),
        F.col("forward_original_email").alias("forward"), "msg_uid")
