"""Registered queries of the operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from tidings.llm import (exact_dedup, fim, fingerprints, licenses, merkle, mixing, packing, quality,
                         secrets, simhash, topk, toxicity, urls)
from tidings.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return add


@query("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_mixing", mixing.mix_sql())
def op2_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op3_exact_dedup", exact_dedup.COPIES_SQL)
def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.copies(table(spark, sf_dir, "documents"))


@query("op4_secrets")
def op4_secrets(spark, sf_dir):
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


@query("op5_packing")
def op5_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op6_licenses")
def op6_licenses(spark, sf_dir):
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


@query("op7_fingerprints")
def op7_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query("op8_simhash")
def op8_simhash(spark, sf_dir):
    return simhash.near_copies(table(spark, sf_dir, "documents"))


@query("op9_quality")
def op9_quality(spark, sf_dir):
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_urls")
def op10_urls(spark, sf_dir):
    return urls.filter_urls(table(spark, sf_dir, "pages"))


@query("op11_topk", topk.TOPK_SQL)
def op11_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings")).select("query_id", "rank", "vec_id", "score")


@query("op12_fim", fim.FIM_SQL)
def op12_fim(spark, sf_dir):
    return fim.digest(table(spark, sf_dir, "documents"))


@query("op13_merkle", merkle.MERKLE_SQL)
def op13_merkle(spark, sf_dir):
    return merkle.proofs(table(spark, sf_dir, "documents"))
