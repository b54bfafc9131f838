"""Quality classifier: regularised quadratic discriminant analysis.

Each class (labels.quality 1 and 0) is a Gaussian over transformed statistics
of the text. Its covariance is shrunk towards the pooled covariance and a
multiple of the identity, and kept as a Cholesky factor, so a score needs one
triangular solve per class: the difference of the log densities is that of
the squared Mahalanobis distances and the log determinants.

The class means and covariances come from sums and sums of products that
Spark aggregates over all labelled rows; only those sums reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, Texts, held_out, map_texts, mix, store

SHRINK_POOLED = 0.15
SHRINK_IDENTITY = 0.05
PREDICT_FROM = 0.3
STATISTICS = ("log_words", "word_length", "symbols", "uppercase", "digits", "punctuation", "distinct", "repeats",
              "same_lines", "line_words", "log_lines", "top_word")


def _class_table(test) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[i for i in range(128) if test(chr(i))]] = True
    return out


_UPPER = _class_table(str.isupper)
_DIGIT = _class_table(str.isdigit)
_STOP = _class_table(lambda c: c in ".,;:")
_MARK = _class_table(lambda c: c in "#*$%&|<>!?=_~^+\\/{}[]@")


def _statistics(rows: pa.RecordBatch, texts: Texts) -> dict:
    d, n = len(texts), np.diff(texts.first)
    some = np.maximum(n, 1)
    h, doc = texts.hashes(), texts.doc()

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=sums[1:])
        return np.diff(sums[texts.bounds])

    chars = count(((texts.buf & 0xC0) != 0x80) & ~IS_SPACE[texts.buf])
    order = np.lexsort((h, doc))
    hs, ds = h[order], doc[order]
    new = np.ones(len(hs), dtype=bool)
    new[1:] = (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])
    distinct = np.bincount(ds[new], minlength=d)
    top = np.zeros(d, dtype=np.int64)
    if len(hs):
        head = np.flatnonzero(new)
        np.maximum.at(top, ds[head], np.diff(np.append(head, len(hs))))
    next_same = np.zeros(len(h), dtype=bool)
    next_same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    lines, same = np.zeros(d, dtype=np.int64), np.zeros(d, dtype=np.int64)
    raw = texts.buf.tobytes()
    for i in range(d):
        own = [x for x in raw[texts.bounds[i]:texts.bounds[i + 1]].split(b"\n") if x and not x.isspace()]
        lines[i], same[i] = len(own), len(own) - len(set(own))
    expected = some ** -0.18                  # a longer text repeats more of its words
    table = np.stack([
        np.log1p(n), chars / some, np.log1p(20 * count(_MARK[texts.buf]) / some), np.log1p(10 * count(_UPPER[texts.buf]) / some),
        np.log1p(10 * count(_DIGIT[texts.buf]) / some), np.log1p(10 * count(_STOP[texts.buf]) / some),
        distinct / some / expected, np.log1p(20 * np.bincount(doc[next_same], minlength=d) / some),
        same / np.maximum(lines, 1), np.log1p(n / np.maximum(lines, 1)), np.log1p(lines), top / some * np.minimum(some, 100) / 100], axis=1)
    return {"doc_id": rows.column("doc_id").cast(pa.int64()),
            "x": pa.FixedSizeListArray.from_arrays(pa.array(table.ravel()), table.shape[1]).cast(pa.list_(pa.float64()))}


def statistics(documents: DataFrame) -> DataFrame:
    return map_texts(documents.select("doc_id", "text"), _statistics, "doc_id long, x array<double>")


def fit(labelled: DataFrame) -> dict | None:
    """A model from ``labelled (x, quality)``; None without labelled rows."""
    d = len(STATISTICS)
    one = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]
    two = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    got = {r["quality"]: r for r in labelled.groupBy("quality").agg(F.count("*").alias("n"), *one, *two).collect()}
    got = {k: r for k, r in got.items() if k in (0, 1)}
    if not got:
        return None
    mean, cov, n = {}, {}, {k: r["n"] for k, r in got.items()}
    for k, r in got.items():
        m = np.array([r[f"s{i}"] for i in range(d)]) / n[k]
        p = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                p[i, j] = p[j, i] = r[f"p{i}_{j}"] / n[k]
        mean[k], cov[k] = m, p - np.outer(m, m)
    pooled = sum(cov[k] * n[k] for k in got) / sum(n.values())
    out = {"log_prior": float(np.log((n.get(1, 0) + 1) / (n.get(0, 0) + 1)))}
    for k in got:
        c = (1 - SHRINK_POOLED) * cov[k] + SHRINK_POOLED * pooled
        c = (1 - SHRINK_IDENTITY) * c + SHRINK_IDENTITY * np.diag(np.maximum(np.diag(pooled), 1e-6))
        factor = np.linalg.cholesky(c)
        out[k] = (mean[k], np.linalg.inv(factor), float(np.log(np.diag(factor)).sum()))
    return out


def scores(stats: DataFrame, model: dict | None) -> DataFrame:
    """doc_id and score of ``stats (doc_id, x)``."""
    def run(batches):
        for batch in batches:
            x = batch.column("x")
            n = len(x)
            if model is None or n == 0:
                s = np.full(n, 0.5)
            else:
                v = x.flatten().to_numpy().reshape(n, len(STATISTICS))
                log = {}
                for k in (0, 1):
                    if k in model:
                        mean, inverse, half_det = model[k]
                        z = (v - mean) @ inverse.T
                        log[k] = -0.5 * (z * z).sum(1) - half_det
                if len(log) == 2:
                    s = 1 / (1 + np.exp(-np.clip(log[1] - log[0] + model["log_prior"], -500, 500)))
                else:
                    s = np.full(n, float(1 in log))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(s)})
    return stats.mapInArrow(run, "doc_id long, score double")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``documents (doc_id,
    text)``; learns from ``labels (doc_id, quality)`` of rows not held out.

    * null or empty text: all statistics 0, scored like any other;
    * null labels, or other than 0 and 1, are not learned from; with labels
      of one class only, its value is every score; with none, 0.5;
    * null doc_id: scored, has no label, not held out; repeated rows: each is
      scored, and counts again in training, as do repeated labels;
    * extra columns are not read; an empty table gives an empty result.
    """
    stats = store(statistics(documents), "statistics")
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out()).select("doc_id", "quality")
    model = fit(stats.join(known, "doc_id").select("x", "quality"))
    out = scores(stats, model)
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      F.when(F.col("score") >= PREDICT_FROM, 1).otherwise(0).alias("predicted"))
