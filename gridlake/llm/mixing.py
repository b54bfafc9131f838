"""Mixing sources to target weights by weighted fair queueing.

Every document is offered ``PASSES`` times. A source's offers stand in the
order (pass, hash of the id), which shuffles each pass; an offer's virtual
finish time is the words of its source up to and with it, divided by the
source's target. Offers are then ranged by that time over all sources, and cut
where the words taken reach the total budget, so each source has got the same
part of its target at every point of the mix.

The running sums need neither one task for a source nor one for the whole:
offers fall into ranges of the order (by hash, or by virtual time) of some
thousand rows each, ranges are summed first, and a window runs inside each
range on top of the sum of the ranges before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, store

#: weights by the place of the source's name, repeating
WEIGHTS = (5, 2, 1)
PASSES = 2
#: budget, as a percentage of all words
BUDGET_PERCENT = 150
#: rows of a range of the order, about, as long as there are under MOST_RANGES
RANGE_ROWS = 2000
MOST_RANGES = 1 << 16


def n_words(text: Column | str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[tuple], weights: dict | None = None) -> dict:
    """Words to take from each source of ``(source, words)``: shares of the
    budget by weight, at most ``PASSES`` times the source, what is over going
    to the others by weight until no share is above its limit."""
    ordered = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode("utf-8", "surrogatepass")))
    weight = {s: (weights or {}).get(s, WEIGHTS[i % len(WEIGHTS)]) for i, (s, _) in enumerate(ordered)}
    limit = {s: float(PASSES * n) for s, n in ordered}
    left, free, out = BUDGET_PERCENT * sum(n for _, n in ordered) / 100, list(weight), {}
    while free:
        total = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / total >= limit[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in free}
        for s in full:
            out[s] = limit[s]
            left -= limit[s]
        free = [s for s in free if s not in full]
    return out


def _cells(rows: int) -> int:
    return min(max(1, rows // RANGE_ROWS), MOST_RANGES)


def _running(rows: DataFrame, keys: list[str], place: Column, order: list, value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of value up to and with the row, within keys, by
    (place, order); place is a whole number that ``order`` agrees with."""
    rows = store(rows.withColumn("_range", place), f"mix-{name}")
    ranges = rows.groupBy(*keys, "_range").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    same = [rows[k].eqNullSafe(ranges[k]) for k in [*keys, "_range"]]
    both = rows.join(ranges, same).select(rows["*"], ranges["_before"])
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(name, F.col("_before") + F.sum(value).over(inside)).drop("_range", "_before")


def mix_sources(documents: DataFrame, weights: dict | None = None) -> DataFrame:
    """doc_id, size, source, source_size, target, copies and taken for each
    row of ``documents (doc_id, text, source)``; weights may be given by
    source, else 5, 2, 1 repeat over the sources by code point, null last.

    Whole documents are taken. Where a source's target lies inside a document,
    the nearer of its two ends counts as the target, so a source is off by
    about half a document.

    * null or empty text: size 0, taken 0;
    * null source: a source of its own; null doc_id: an ordinary document;
    * rows equal in doc_id, source and text are taken or left together;
    * no words at all: targets and taken are 0; extra columns are not read; an
      empty table gives an empty result.
    """
    docs = _sized(documents)
    taken, goal = _taken(docs, weights)
    rows = docs.join(taken, "unit", "left")
    return rows.join(goal, rows.source.eqNullSafe(goal.of)).select(
        "doc_id", "size", "source", "source_size", "target", F.coalesce("offers", F.lit(0)).cast("long").alias("copies"),
        (F.coalesce("offers", F.lit(0)) * F.col("size")).alias("taken"))


def mix_documents(documents: DataFrame, weights: dict | None = None) -> DataFrame:
    """The rows of documents that ``mix_sources`` takes, with all their columns
    and ``copies``, the times that each is taken. Nulls, repeats and empty
    tables as there: a row without words is never taken."""
    unit, copies = free_name("_unit", documents), free_name("copies", documents)
    taken, _ = _taken(_sized(documents), weights)
    named = documents.withColumn(unit, _unit()).filter(n_words() > 0)
    taken = taken.select(F.col("unit").alias(unit), F.col("offers").alias(copies))
    return named.join(taken, unit).select(*documents.columns, copies)


def _unit() -> Column:
    """A name for the rows that are equal in id, source and text."""
    return F.xxhash64("doc_id", F.col("doc_id").isNull(), "source", F.col("source").isNull(), "text")


def _sized(documents: DataFrame) -> DataFrame:
    return store(documents.select("doc_id", "source", n_words().alias("size"), _unit().alias("unit")), "mix-sizes")


def _taken(docs: DataFrame, weights: dict | None) -> tuple[DataFrame, DataFrame]:
    """(unit, offers) of what the mix takes, and the sources' targets."""
    got = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")).collect()
    want = targets([(r.source, r.source_size) for r in got], weights)
    goal = docs.sparkSession.createDataFrame(
        [(r.source, r.source_size, float(want[r.source])) for r in got], "of string, source_size long, target double")
    units = docs.filter("size > 0").groupBy("unit", "source").agg(
        F.sum("size").alias("words"), F.min("doc_id").alias("doc_id"))
    units = units.join(goal, units.source.eqNullSafe(goal.of)).select(units["*"], "target").filter("target > 0")
    offers = units.withColumn("pass", F.explode(F.sequence(F.lit(1), F.lit(PASSES)))).withColumn(
        "key", F.pmod(F.xxhash64(F.lit("mix"), "pass", "unit"), F.lit(1 << 40)))
    cells = _cells(max([r.n for r in got], default=1))
    place = F.col("pass") * cells + F.floor(F.col("key") * cells / float(1 << 40))
    offers = _running(offers, ["source"], place, ["key", "unit"], "words", "upto")
    nearer = (F.col("upto") > F.col("target")) & (F.col("upto") - F.col("words") / 2 <= F.col("target"))
    offers = offers.withColumn("finish", F.when(nearer, 1.0).otherwise(F.col("upto") / F.col("target")))
    # all targets are reached at time 1; twice that is beyond any cut
    offers = offers.filter("finish <= 2")
    cells = _cells(PASSES * sum(r.n for r in got))
    offers = _running(offers, [], F.floor(F.col("finish") * cells).cast("long"), ["finish", "source", "key", "unit"], "words", "queue")
    taken = offers.filter(F.col("queue") - F.col("words") / 2 <= sum(want.values())).groupBy("unit").agg(
        F.count("*").alias("offers"))
    return taken, goal
