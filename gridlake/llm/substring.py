"""Removal of long repeated passages, found by recompression.

Each text's word sequence is compressed in rounds. A round first freezes the
units of runs of one symbol, then joins neighbours a b where a falls in the
left and b in the right half of the names under the round's partition. Names
are hashes of what they stand for, so every task gives one pair one name, and
equal passages get equal symbols except next to their ends: a round changes at
most two symbols at each end. What is left inside a window of ``WINDOW`` equal
words is long enough to hold at least one chosen symbol, one of the smallest
name among those that start in ``_span()`` consecutive words.

A chosen symbol stands for the ``LENGTH`` words from its start. Those that occur
in two different texts show where long repeats can be: the windows around
them, and no others, are named by their whole word sequence, and a window is
removed from each document but the first it is in. Exact copies of a whole
text are settled by one name for the text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import _IP, _P, _pow, Texts, free_name, lists, longs, map_texts, maybe_in, mix, released, slices, store

WINDOW = 50
ROUNDS = 2
LENGTH = 16
_TOP = np.uint64((1 << 64) - 1)


def _span(rounds: int = ROUNDS, window: int = WINDOW, length: int = LENGTH) -> int:
    """Consecutive start words among which a symbol is chosen: those of the
    window without two symbols at each end for each round (sizes 1, 2, 4,
    ...), from which the symbol and the words it stands for are still inside."""
    edge = 2 * (2 ** rounds - 1)
    return min(window - edge - 2 ** rounds, window - length) - edge + 1


def recompress(name: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS):
    """Symbols of word sequences: (name, first word, text)."""
    at, frozen = np.arange(len(name)), np.zeros(len(name), dtype=bool)
    for turn in range(1, rounds + 1):
        if not len(name):
            break
        near = doc[1:] == doc[:-1]
        same = near & (name[1:] == name[:-1])
        frozen[1:] |= same
        frozen[:-1] |= same
        left = (mix(name + np.uint64(turn * _P & (1 << 64) - 1)) >> np.uint64(63)).astype(bool) & ~frozen
        right = ~left & ~frozen
        i = np.flatnonzero(left[:-1] & right[1:] & near)
        name = name.copy()
        name[i] = mix(mix(name[i] + np.uint64(turn)) ^ (name[i + 1] * np.uint64(_P)))
        keep = np.ones(len(name), dtype=bool)
        keep[i + 1] = False
        name, at, doc, frozen = name[keep], at[keep], doc[keep], frozen[keep]
    return name, at, doc


def _sliding(a: np.ndarray, n: int, op) -> np.ndarray:
    """op over a[i:i+n], for each i where that fits."""
    done, out = 1, a
    while done < n:
        step = min(done, n - done)
        out = op(out[:-step], out[step:])
        done += step
    return out


def choose(name: np.ndarray, at: np.ndarray, doc: np.ndarray, words: int, texts: int, span: int) -> np.ndarray:
    """Which symbols are chosen: each that has the smallest name among those
    that start in some ``span`` consecutive words."""
    place = at + (doc + 1) * span                    # texts are set apart, so no stretch sees two of them
    line = np.full(words + (texts + 2) * span, _TOP, dtype=np.uint64)
    line[place] = name
    least = _sliding(line, span, np.minimum)
    most = _sliding(least, span, np.maximum)         # most[i]: over the stretches that start at i .. i+span-1
    return most[place - span + 1] == name


def _text_name(h: np.ndarray, texts: Texts) -> np.ndarray:
    """One 64-bit name for each whole word sequence."""
    n = len(h)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * _pow(_P, n), out=sums[1:])
    a, b = texts.first[:-1], texts.first[1:]
    return mix((sums[b] - sums[a]) * _pow(_IP, n + 1)[a] + (b - a).astype(np.uint64))


def _pass(rows: pa.RecordBatch, texts: Texts) -> dict:
    h = texts.hashes()
    n = np.diff(texts.first)
    name, at, doc = recompress(h, texts.doc())
    end = texts.first[1:][doc]
    take = choose(name, at, doc, len(h), len(n), _span()) & (at + LENGTH <= end) & (n[doc] >= WINDOW)
    at, doc = at[take], doc[take]
    sums = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * _pow(_P, len(h)), out=sums[1:])
    symbol = mix((sums[at + LENGTH] - sums[at]) * _pow(_IP, len(h) + 1)[at])
    sha = [hashlib.sha256(b" ".join(texts.bytes_of(i).split())).hexdigest() for i in range(len(texts))]
    counts = np.bincount(doc, minlength=len(n))
    return {
        "doc_id": rows.column("doc_id").cast(pa.int64()), "seen": rows.column("seen"), "n_words": longs(n), "seq": longs(_text_name(h, texts)),
        "sha": pa.array(sha, type=pa.string()), "symbols": lists(longs(symbol), counts),
        "places": lists(pa.array((at - texts.first[:-1][doc]).astype(np.int32)), counts),
    }


def _windows(rows: pa.RecordBatch, texts: Texts) -> dict:
    """The names of the windows that hold the words of the given symbols."""
    h = texts.hashes()
    n = len(h)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * _pow(_P, n), out=sums[1:])
    places = rows.column("places")
    edge = np.zeros(n + 1, dtype=np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(np.asarray(places.offsets)))
    at = places.flatten().to_numpy()
    base, words = texts.first[:-1][doc], np.diff(texts.first)[doc]
    np.add.at(edge, base + np.maximum(at + LENGTH - WINDOW, 0), 1)
    np.add.at(edge, base + np.minimum(at, words - WINDOW) + 1, -1)
    s = np.flatnonzero(np.cumsum(edge)[:n] > 0)
    name = mix((sums[s + WINDOW] - sums[s]) * _pow(_IP, n + 1)[s])
    doc = texts.doc()[s]
    take = pa.array(doc)
    return {"window": longs(name), "doc_id": rows.column("doc_id").take(take), "seq": rows.column("seq").take(take),
            "start": pa.array((s - texts.first[:-1][doc]).astype(np.int32))}


def _gone(rows: pa.RecordBatch, texts: Texts) -> np.ndarray:
    """Which words the removed windows cover."""
    n = texts.first[-1]
    edge = np.zeros(n + 1, dtype=np.int64)
    starts = rows.column("starts")
    base = np.repeat(texts.first[:-1], np.diff(np.asarray(starts.offsets)))
    s = base + starts.flatten().to_numpy()
    np.add.at(edge, s, 1)
    np.add.at(edge, s + WINDOW, -1)
    return np.cumsum(edge)[:n] > 0


def _cut(rows: pa.RecordBatch, texts: Texts) -> dict:
    gone = _gone(rows, texts)
    raw = texts.buf.tobytes()
    kept = []
    for i in range(len(texts)):
        a, b = texts.first[i], texts.first[i + 1]
        w = raw[texts.bounds[i]:texts.bounds[i + 1]].split()
        kept.append(b" ".join(x for x, g in zip(w, gone[a:b].tolist()) if not g))
    return {"doc_id": rows.column("doc_id"), "seq": rows.column("seq"),
            "n_removed": longs(np.add.reduceat(np.append(gone, False).astype(np.int64), texts.first[:-1]) * (np.diff(texts.first) > 0)),
            "kept": pa.array([x.decode("utf-8", "surrogateescape") for x in kept]),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept])}


def repeated_passages(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For ``documents (doc_id, text)``: (rows, cuts). rows: doc_id, seq,
    n_words, sha, whole (true: every word goes, as the text is a copy). cuts:
    doc_id, seq, n_removed, kept, kept_sha256 of the documents that lose
    some words otherwise; one row for each (doc_id, seq)."""
    documents = documents.select("doc_id", "text", F.xxhash64("text").alias("seen"))
    seen = store(map_texts(documents, _pass, "doc_id long, seen long, n_words long, seq long, sha string, "
                           "symbols array<long>, places array<int>"), "symbols")
    texts = store(seen.groupBy("seq").agg(F.min("doc_id").alias("rep")), "texts")
    rows = seen.select("doc_id", "seq", "n_words", "sha").join(texts, "seq").withColumn(
        "whole", (F.col("n_words") >= WINDOW) & F.coalesce(F.col("doc_id") > F.col("rep"), F.lit(False)))
    rows = store(rows, "rows")
    each = seen.select("doc_id", "seen", "seq", F.explode(F.arrays_zip("symbols", "places")).alias("x")).select(
        "doc_id", "seen", "seq", F.col("x.symbols").alias("symbol"), F.col("x.places").alias("place"))
    shared = store(each.groupBy("symbol").agg(F.min("seq").alias("a"), F.max("seq").alias("b"))
                   .filter("a <> b").select("symbol"), "shared")
    near = store(each.join(shared, "symbol").groupBy("doc_id", "seen", "seq").agg(F.collect_set("place").alias("places")), "near")
    first = rows.filter("not whole").select("doc_id", "seq").distinct()
    near = store(near.join(first, [near.doc_id.eqNullSafe(first.doc_id), near.seq == first.seq], "left_semi"), "look")
    # texts are fetched by id and hash, and few others are moved
    n_near = near.count()
    texts = maybe_in(documents.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "seen", "text"),
                     "seen", near, n_near).filter("_maybe").drop("_maybe")
    found = texts.join(near.withColumn("id", F.coalesce("doc_id", F.lit(0))).withColumn("none", F.col("doc_id").isNull()),
                       ["id", "none", "seen"]).select("doc_id", "seq", "text", "places")
    found = store(map_texts(found, _own, "doc_id long, seq long, text string, places array<int>")
                  .dropDuplicates(["doc_id", "seq"]), "look")
    windows = store(map_texts(found, _windows, "window long, doc_id long, seq long, start int"), "windows")
    origin = store(windows.groupBy("window").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                   .filter("lo < hi").select("window", "lo"), "origin")
    starts = windows.join(origin, "window").filter("doc_id > lo").groupBy("doc_id", "seq").agg(
        F.collect_list("start").alias("starts"))
    starts = store(starts, "starts")
    cuts = map_texts(found.select("doc_id", "seq", "text").join(starts, ["doc_id", "seq"]), _cut,
                     "doc_id long, seq long, n_removed long, kept string, kept_sha256 string")
    return rows, store(cuts, "cuts")


def _own(rows: pa.RecordBatch, texts: Texts) -> dict:
    """Rows whose text is the one named (an id can have several texts)."""
    own = pa.array(_text_name(texts.hashes(), texts).view(np.int64) == rows.column("seq").to_numpy())
    return {c: rows.column(c).filter(own) for c in ("doc_id", "seq", "text", "places")}


_NOTHING = hashlib.sha256(b"").hexdigest()


def dedup_substrings(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents (doc_id, text)``: doc_id, n_words,
    n_removed, kept_sha256 (of the kept words, joined by one space).

    A word is removed if a window of 50 consecutive words that covers it also
    starts in a document with a smaller doc_id, judged on the input.

    * null or empty text: no words, nothing removed;
    * under 50 words: nothing removed;
    * repeated rows and rows that share a doc_id: neither is smaller, so they
      take nothing from each other;
    * null doc_id: neither smaller nor larger than any other: keeps its words
      and takes none;
    * extra columns are not read; an empty table gives an empty result.
    """
    rows, cuts = repeated_passages(documents)
    out = rows.join(cuts.select("doc_id", "seq", "n_removed", "kept_sha256"), ["doc_id", "seq"], "left")
    return out.select(
        "doc_id", "n_words",
        F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("whole"), F.lit(_NOTHING)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))


def remove_repeats(documents: DataFrame) -> DataFrame:
    """The rows of documents with all their columns, text without the words
    that ``dedup_substrings`` removes. A changed text has its words joined by
    one space, and n_chars (if there) its new length; rows that lose all their
    words go."""
    own_seq, of_id, of_seq, kept = (free_name(c, documents) for c in ("_seq", "_id", "_s", "_kept"))

    def name(batches):
        for batch in batches:
            seq = [_text_name(t.hashes(), t) for _, _, t in slices(batch.column("text"))]
            yield batch.append_column(own_seq, longs(np.concatenate(seq) if seq else np.zeros(0, np.uint64)))

    schema = StructType(documents.schema.fields + [StructField(own_seq, LongType())])
    rows, cuts = repeated_passages(documents)
    whole = rows.filter("whole").select(F.col("doc_id").alias(of_id), F.col("seq").alias(of_seq)).distinct()
    cuts = cuts.select(F.col("doc_id").alias(of_id), F.col("seq").alias(of_seq), F.col("kept").alias(kept))
    changes = store(cuts.union(whole.withColumn(kept, F.lit(""))), "changes")
    # only rows that may change are moved
    maybe = free_name("_maybe", documents)
    named = maybe_in(documents.mapInArrow(released(name), schema), own_seq, changes.withColumnRenamed(of_seq, own_seq), changes.count(), maybe)
    some = named.filter(maybe).drop(maybe).join(
        changes, (F.col("doc_id") == F.col(of_id)) & (F.col(own_seq) == F.col(of_seq)), "left")
    same = named.filter(~F.col(maybe)).drop(maybe)
    out = some.unionByName(same, allowMissingColumns=True)
    out = out.filter(F.col(kept).isNull() | (F.col(kept) != "")).withColumn("text", F.coalesce(kept, "text"))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(documents.columns)
