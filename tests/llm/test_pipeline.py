"""The corpus pipeline, stage by stage, against brute force."""

import brute
import corpus_pipeline
from test_operators import ODD, SCHEMA, _check_pieces  # noqa: F401

from tidings.llm import exact_dedup, mixing, packing, quality, simhash


def test_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], sf_small).persist())
    assert all(t.columns == columns for t in tables[:-1])
    start, good, once, far, mixed = ({r.doc_id: r.text for r in t.select("doc_id", "text").collect()} for t in tables[:-1])
    scores = {r.doc_id: r.score for r in quality.score_quality(
        docs, spark.read.parquet(f"{sf_small}/labels.parquet")).collect()}
    assert set(good) == {d for d in start if scores[d] >= 0.3}
    last = {t: d for d, t in sorted(good.items())}
    assert set(once) == set(last.values())
    want = brute.classes({d: brute.fp64(t) for d, t in once.items()})
    assert set(far) == {d for d, c in want.items() if d == c}
    drawn = {r.doc_id: r.sampled for r in mixing.mix(tables[3]).collect()}
    assert set(mixed) == {d for d in far if drawn[d]}
    assert {r.doc_id for r in tables[5].collect()} == set(mixed)
    ran = corpus_pipeline.run(spark, sf_small)
    assert sorted(r.doc_id for r in ran.select("doc_id").distinct().collect()) == sorted(mixed)


def test_stages_on_odd_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (ODD, []):
        docs = spark.createDataFrame(rows, SCHEMA)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "packing":
                assert out.columns == docs.columns
                docs = out
        assert (out.count() > 0) == bool(rows)
    assert [s[1].__module__ for s in corpus_pipeline.STAGES] == ["corpus_pipeline"] * 5
    assert exact_dedup and packing and simhash
