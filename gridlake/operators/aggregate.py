"""Aggregation operators.

Sums of measurements are computed exactly in DECIMAL(38,6) and returned as
DOUBLE: a double sum depends on the order rows meet in, which changes with
partitioning, so the same data would give last-bit differences run to run.
A decimal sum is associative, so results are identical at any parallelism.
Values that the decimal does not hold exactly (NaN, infinities, huge or tiny
ones) are summed as doubles beside it, in the same pass, and added: nothing is
left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = "decimal(38,6)"


#: Larger values stay doubles, so that 10^12 of them cannot overflow the sum.
EXACT_BELOW = 1e20


def exact_parts(col) -> tuple[Column, Column]:
    """The sums of the values that the decimal holds, as a decimal, and of the
    others, as a double (NULL where there are none). Both can be summed on."""
    c = F.col(col) if isinstance(col, str) else col
    d = c.try_cast(EXACT)
    held = F.coalesce((F.abs(c) < EXACT_BELOW) & (d.cast("double") == c.cast("double")), F.lit(False))
    return F.sum(F.when(held, d)), F.sum(F.when(~held, c.cast("double")))


def exact_sum(col) -> Column:
    """Sum of the non-NULL values; NULL if there are none."""
    exact, rest = exact_parts(col)
    exact = exact.cast("double")
    return F.coalesce(exact + rest, exact, rest)


def exact_avg(col) -> Column:
    """Average over non-NULL values, via the exact sum."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_divide(exact_sum(c), F.count(c))


def count_true(col) -> Column:
    """Rows where ``col`` is TRUE (NULL and FALSE count 0), as BIGINT."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(F.when(c, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def feeder_rollup(segments: DataFrame, key: str = "feeder_id",
                  values: dict | None = None, order: tuple = ("_ingestion_ts", "section_id"),
                  count_col: str = "section_id") -> DataFrame:
    """Segment -> feeder roll-up.

    Feeder-level attributes are repeated on every segment, so one segment's
    values stand for the feeder. The segment is chosen deterministically: the
    greatest (``order`` ..., then the value columns themselves), which makes
    ties harmless. ``max`` over that struct is an ordinary partial/final
    aggregate, so a feeder holding a third of all segments is pre-reduced on
    every map task before the shuffle; the struct holds the values, which are
    taken from it. Also counts non-NULL ``count_col``.
    """
    values = values or {
        "voltage_kv": "voltage_kv",
        "max_hosting_capacity_mw": "feeder_max_hc_mw",
        "min_hosting_capacity_mw": "feeder_min_hc_mw",
        "hca_refresh_date": "hca_date",
        "feeder_name": "feeder_name",
    }
    srcs = list(dict.fromkeys(values.values()))
    rank = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in srcs if c not in order])
    picked = F.max(rank).alias("_pick")
    agg = segments.groupBy(key).agg(picked, F.count(count_col).alias("segment_count"))
    return agg.select(
        F.col(key),
        *[F.col(f"_pick.{src}").alias(out) for out, src in values.items()],
        F.col("segment_count"),
    )
