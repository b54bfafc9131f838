"""Quality rules as a ledger: every rule is evaluated once, its failure is one
bit, and policies are masks over the bits.

``ledger`` keeps each document's measurements and failure bits. A policy
(version -> rules) then needs no text: a document passes if it has none of the
policy's bits. ``ablation`` counts, from the bits alone, what each rule of a
policy removes, and what only it removes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _P, IS_SPACE, Texts, longs, map_texts, mix

#: name -> condition of failure over the measurements; a rule's bit is its place.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 12 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
}
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(RULES),
}
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def mask(policy: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in POLICIES[policy])


def _measure(rows: pa.RecordBatch, texts: Texts) -> dict:
    h, doc, n = texts.hashes(), texts.doc(), np.diff(texts.first)
    d = len(texts)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=sums[1:])
        return np.diff(sums[texts.bounds])

    lead = (texts.buf & 0xC0) != 0x80
    # words in three-word windows that occur twice or more in their text
    again = np.zeros(len(h) + 3, dtype=np.int64)
    at = np.flatnonzero(doc[:-2] == doc[2:]) if len(h) > 2 else np.zeros(0, dtype=np.int64)
    if len(at):
        three = mix(mix(mix(h[at] + np.uint64(_P)) ^ h[at + 1]) * np.uint64(3) ^ h[at + 2])
        order = np.lexsort((three, doc[at]))
        t, o = three[order], doc[at][order]
        same = (t[1:] == t[:-1]) & (o[1:] == o[:-1])
        twice = np.zeros(len(t), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        s = at[order[twice]]
        np.add.at(again, s, 1)
        np.add.at(again, s + 3, -1)
    covered = np.cumsum(again)[:len(h)] > 0
    dup, lines = np.zeros(d, dtype=np.int64), np.zeros(d, dtype=np.int64)
    raw = texts.buf.tobytes()
    for i in range(d):
        own = [x for x in raw[texts.bounds[i]:texts.bounds[i + 1]].split(b"\n") if x and not x.isspace()]
        lines[i], dup[i] = len(own), len(own) - len(set(own))
    return {"doc_id": rows.column("doc_id").cast(pa.int64())} | {k: longs(v) for k, v in zip(MEASURES, (
        n, per_text(lead & ~IS_SPACE[texts.buf]), per_text(_SYMBOL[texts.buf]), dup,
        np.bincount(doc[covered], minlength=d), lines))}


def ledger(documents: DataFrame) -> DataFrame:
    """doc_id, the measurements, and failed_rules (long, a bit for each rule)."""
    measured = map_texts(documents.select("doc_id", "text"), _measure,
                         "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = " + ".join(f"CASE WHEN {rule} THEN {1 << k}L ELSE 0L END" for k, rule in enumerate(RULES.values()))
    return measured.withColumn("failed_rules", F.expr(bits))


def passes(policy: str):
    return F.col("failed_rules").bitwiseAND(mask(policy)) == 0


def ablation(led: DataFrame, policy: str = "v1") -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone,
    and that pass once it is dropped from the policy."""
    m, names = mask(policy), list(RULES)
    bits = F.col("failed_rules").bitwiseAND(m)
    got = led.groupBy(bits.alias("bits")).agg(F.count("*").alias("n"))
    kinds = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).alias("bit")) for r in POLICIES[policy]]))
    return got.select("bits", "n", kinds.alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(F.col("bits").bitwiseAND(m - F.col("r.bit")) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"))


def quality_rules(documents: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger of ``documents (doc_id, text)`` with base_failed and kept.

    * null or empty text: no words, all measurements 0, fails ``few_words``;
    * null or repeated doc_id: the row is judged on its own like any other;
    * extra columns are not read; an empty table gives an empty result.
    """
    led = ledger(documents)
    return led.withColumn("base_failed", ~passes("base")).withColumn("kept", passes("base") & passes(policy))
