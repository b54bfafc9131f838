"""Queries of the training-data operators, one per operator over its whole
table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import table


def op1_minhash(spark, sf_dir):
    from .minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_language(spark, sf_dir):
    from .langid import identify
    return identify(table(spark, sf_dir, "documents"))


def op3_decontamination(spark, sf_dir):
    from .spaced import contamination
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark, sf_dir):
    from .qda import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_lm_score(spark, sf_dir):
    from .pseudo import score
    return score(table(spark, sf_dir, "documents"))


def op6_mixing(spark, sf_dir):
    from .mixing import mix_sources
    return mix_sources(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    from .rules import quality_rules
    return quality_rules(table(spark, sf_dir, "documents"))


def op8_warc(spark, sf_dir):
    from ..session import scratch_path
    from .warc import round_trip
    return round_trip(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def op9_substring_dedup(spark, sf_dir):
    from .substring import dedup_substrings
    return dedup_substrings(table(spark, sf_dir, "documents"))


def op10_html(spark, sf_dir):
    from .dom import extract
    return extract(table(spark, sf_dir, "pages"))


def op11_whitening(spark, sf_dir):
    from .whiten import whiten
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_infill(spark, sf_dir):
    from .infill import fill_in_middle, restored
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(), 256).alias("restored_sha256"))


def op13_packing(spark, sf_dir):
    import public_tokenizers

    from .packing import pack
    pieces = pack(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {f.__name__: f for f in (
        op1_minhash, op2_language, op3_decontamination, op4_quality, op5_lm_score, op6_mixing, op7_quality_rules, op8_warc, op9_substring_dedup, op10_html,
        op11_whitening, op12_infill, op13_packing, pipeline)}


def oracle_sql():
    from . import sql
    return dict(sql.QUERIES)
