"""The pipeline's stages against brute force, and its SQL."""

import re

import corpus_pipeline
from gridlake.llm import minhash, mixing

from .test_operators import SF, brute_components, brute_repeats


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_dedup", "substring_dedup", "decontamination", "mixing"]
    kept = stages["language_id"](spark, docs, SF)
    assert kept.schema == docs.schema and kept.count() >= 0.99 * len(rows)
    near = stages["near_dedup"](spark, docs, SF)
    want = {d for d, _, c in brute_components([(r.doc_id, r.text) for r in rows], percent=80) if d == c}
    assert near.schema == docs.schema and sorted(r.doc_id for r in near.collect()) == sorted(want)
    cut = stages["substring_dedup"](spark, docs, SF)
    texts = {r.doc_id: r.text for r in rows}
    want = {d: kept if gone else texts[d] for d, n, gone, _, kept in brute_repeats([(r.doc_id, r.text) for r in rows]) if not gone or kept}
    assert cut.schema == docs.schema and {r.doc_id: r.text for r in cut.collect()} == want
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    clean = stages["decontamination"](spark, docs, SF)
    norm = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [norm(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in rows if not any(i in norm(r.text) for i in items))
    mixed = stages["mixing"](spark, docs, SF).collect()
    assert sorted(r.doc_id for r in mixed) == sorted(r.doc_id for r in mixing.mix_sources(docs).filter("copies > 0").collect())


def test_run(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and all(1 <= r.copies <= 2 for r in out) and len({r.doc_id for r in out}) == len(out)
    assert minhash.near_duplicates(spark.read.parquet(f"{SF}/documents.parquet")).count() >= len(out)
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_keep_columns_with_inner_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    names = ["_kept", "_bad", "_seq", "_id", "_s"]
    wide = docs.selectExpr("*", *[f"doc_id as {c}" for c in names])
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns, name
        assert all(r[c] == r.doc_id for r in out.collect() for c in names)
