"""Benchmark decontamination by spaced seeds.

Texts and benchmark items are lower-cased and split into tokens, the runs of
letters and digits. Masks of counted positions are laid on every position; the
hash of the counted tokens is a seed. Tokens on other positions may differ, so
a passage with substitutions still shares seeds with its item. Shared seeds
give diagonals (the item's place in the text); on each the whole overlap of
text and item is compared token by token, and it is a match if some ``LEAST``
consecutive tokens of it (all of a shorter item) agree in at least ``AGREE``
percent.

The masks leave out nothing that this rule accepts: wherever the differing
tokens that ``AGREE`` allows stand in ``LEAST`` tokens (or in a shorter item),
some mask counts none of them in one of its places.

Only DataFrame functions are used. Benchmark seeds are broadcast where their
measured number is small enough, else joined by shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, store

#: counted positions of the masks for each number of tokens compared, found by
#: enumerating the placements of the tokens that may differ
MASKS = {
    1: ((0,),),
    2: ((0, 1),),
    3: ((0, 1, 2),),
    4: ((0, 1, 2), (0, 1, 3), (0, 2, 3)),
    5: ((0, 1, 2), (0, 1, 3)),
    6: ((0, 1, 2, 3), (0, 1, 3, 4)),
    7: ((0, 1, 3, 4),),
    8: ((0, 1, 3, 4), (0, 1, 2, 3), (0, 1, 5, 6)),
    9: ((0, 1, 2, 4, 5), (0, 3, 4, 5, 6), (0, 1, 3, 6, 7), (0, 1, 2, 3, 5)),
    10: ((0, 1, 2, 4, 5), (0, 1, 3, 6, 7), (0, 1, 2, 3, 4)),
    11: ((0, 1, 2, 3, 7, 8), (0, 1, 3, 4, 5, 6), (0, 1, 5, 6, 8, 9)),
    12: ((0, 1, 2, 4, 5), (0, 1, 3, 7, 8), (0, 1, 4, 6, 7), (0, 1, 3, 4, 5)),
    13: ((0, 1, 2, 4, 5), (0, 1, 6, 8, 9), (0, 1, 3, 4, 5)),
}
LEAST = 13
AGREE = 75
#: benchmark seeds that may be broadcast (24 bytes each)
BROADCAST_SEEDS = 1_000_000


def tokens(text: str) -> Column:
    """Hashes of the text's tokens, in order."""
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def seeds(texts: DataFrame, h: str, masks: list[tuple[int, ...]], *keep: str) -> DataFrame:
    """(keep, at, seed) of each mask on each position of an array of token
    hashes. Positions are made first, and hashed as rows in compiled code."""
    places = F.when(F.size(h) > 0, F.sequence(F.lit(0), F.size(h) * len(masks) - 1)).otherwise(F.array().cast("array<int>"))
    at, mask = F.floor(F.col("_place") / len(masks)).cast("int"), F.col("_place") % len(masks)

    def one(m: tuple[int, ...]) -> Column:
        # a mask is named by its positions: equal in every set of masks
        return F.xxhash64(F.lit(" ".join(map(str, m))), *[F.get(F.col(h), F.col("at") + p) for p in m])

    seed, last = one(masks[0]), F.lit(masks[0][-1])
    for k in range(1, len(masks)):
        seed = F.when(mask == k, one(masks[k])).otherwise(seed)
        last = F.when(mask == k, masks[k][-1]).otherwise(last)
    placed = texts.select(*keep, h, F.explode(places).alias("_place")).withColumn("at", at).filter(F.col("at") + last < F.size(h))
    return placed.select(*keep, "at", seed.alias("seed"))


def _best(agree: Column) -> Column:
    """The most agreeing tokens in LEAST consecutive ones (or in all)."""
    def count(i: Column) -> Column:
        # places beyond a shorter overlap count nothing
        return reduce(lambda x, y: x + y, [F.coalesce(F.get(agree, i + k), F.lit(0)) for k in range(LEAST)])

    return F.array_max(F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(agree) - LEAST)), count))


def _name(key: str, hashes: Column) -> Column:
    """Names the rows of one id and text, also where the id is null, so that
    rows without an id do not all meet."""
    return F.xxhash64(key, F.col(key).isNull(), hashes)


def _overlaps(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, doc, item_id, start, n_tokens, n_agree) of each diagonal on
    which a document and an item overlap; doc names the document's id and text."""
    items = benchmark.select("item_id", tokens("text").alias("item")).distinct()
    items = store(items.withColumn("of", _name("item_id", F.col("item"))), "items")
    width = F.least(F.lit(LEAST), F.size("item"))
    # a row for each number of tokens compared that occurs
    widths = sorted(r.width for r in items.select(width.alias("width")).distinct().collect() if r.width) or [LEAST]
    own = [seeds(items.filter(width == w), "item", list(MASKS[w]), "of") for w in widths]
    probes = store(reduce(DataFrame.union, own).withColumnRenamed("at", "item_at").distinct(), "seeds")
    texts = documents.select("doc_id", tokens("text").alias("h")).withColumn("doc", _name("doc_id", F.col("h")))
    found = seeds(texts, "h", sorted({m for w in widths for m in MASKS[w]}), "doc")
    known = F.broadcast(probes) if probes.count() <= BROADCAST_SEEDS else probes
    hits = found.join(known, "seed").select("doc", "of", (F.col("at") - F.col("item_at")).alias("start"))
    hits = store(hits.distinct(), "hits")
    near = store(hits.join(items, "of").select("doc", "item_id", "start", "item"), "near")
    # texts are dealt by name at any size: what is found grows with them
    both = texts.join(near.hint("merge"), "doc")
    low, high = F.greatest(F.lit(0), -F.col("start")), F.least(F.size("item"), F.size("h") - F.col("start"))
    agree = F.transform(F.sequence(low, high - 1), lambda i: (F.get(F.col("h"), i + F.col("start")) == F.get(F.col("item"), i)).cast("int"))
    # exploded, so that the array is made once and not again for each place
    seen = both.filter(low < high).select("doc_id", "doc", "item_id", "start", F.size("item").alias("of"), F.explode(F.array(agree)).alias("agree"))
    wide = F.least(F.lit(LEAST), F.col("of"))
    seen = seen.filter((F.size("agree") >= wide) & (100 * _best(F.col("agree")) >= AGREE * wide))
    return seen.select("doc_id", "doc", "item_id", "start", F.size("agree").alias("n_tokens"),
                       F.aggregate("agree", F.lit(0), lambda a, x: a + x).alias("n_agree"))


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item that overlap: doc_id,
    item_id, starts (the item's first token would be the text's token number
    ``start``, 0 or more unless the text begins inside the item), n_tokens
    compared and n_agree, of the best diagonal; clean documents have no row.

    * null or empty text on either side: no tokens, no row;
    * an item under ``LEAST`` tokens is matched as a whole, so one of up to
      three tokens only where all of them agree;
    * null doc_id or item_id: matched like any other id;
    * repeated rows: rows with one doc_id (or item_id) are one document (item);
    * ties between diagonals go to the smallest start;
    * extra columns are not read; empty tables give an empty result.
    """
    best = F.max(F.struct("n_agree", (-F.col("start")).alias("back"), "n_tokens"))
    return _overlaps(documents, benchmark).groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", (-F.col("b.back")).cast("long").alias("start"),
        F.col("b.n_tokens").cast("long").alias("n_tokens"), F.col("b.n_agree").cast("long").alias("n_agree"))


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents that overlap with no benchmark item, with all
    their columns. Rows with one doc_id are one document and stay or go
    together; rows without an id are judged each by its own text. Null and
    empty texts overlap with nothing; empty tables drop nothing."""
    text, bad_id, bad_text = (free_name(n, documents) for n in ("_text", "_bad", "_bad_text"))
    bad = _overlaps(documents, benchmark).select(F.col("doc_id").alias(bad_id), F.when(F.col("doc_id").isNull(), F.col("doc")).alias(bad_text))
    bad = store(bad.distinct(), "contaminated")
    own = F.when(F.col("doc_id").isNull(), _name("doc_id", tokens("text")))
    same = F.col("doc_id").eqNullSafe(F.col(bad_id)) & F.col(text).eqNullSafe(F.col(bad_text))
    return documents.withColumn(text, own).join(bad, same, "left_anti").drop(text)
