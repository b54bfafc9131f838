"""Data-quality operators: row expectations, schema contracts, alert filters.

Everything is a distributed aggregate; nothing is collected row-wise."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridlake.registry import NULL_FEEDER_ALERT_PCT, Expectation

# Contract type names -> Spark simpleString.
_SPARK_TYPE = {"string": "string", "long": "bigint", "int": "int", "double": "double",
               "float": "float", "boolean": "boolean", "timestamp": "timestamp",
               "date": "date", "binary": "binary"}


def _passes(e: Expectation):
    # A row passes only when the predicate is TRUE (NULL counts as a failure).
    return F.coalesce(F.expr(e.predicate), F.lit(False))


def expectation_metrics(df: DataFrame, expectations: Sequence[Expectation], table: str) -> DataFrame:
    """One row per expectation: table, expectation, action, total_rows,
    failed_rows, computed in a single partial/final aggregate over ``df``."""
    if not expectations:
        raise ValueError("no expectations")
    aggs = [F.count(F.lit(1)).alias("_total")] + [
        F.count_if(~_passes(e)).alias(f"_f{i}") for i, e in enumerate(expectations)]
    wide = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(e.name).alias("expectation"), F.lit(e.action).alias("action"),
                 F.col(f"_f{i}").alias("failed_rows"))
        for i, e in enumerate(expectations)])
    return (wide.select(F.col("_total").alias("total_rows"), F.inline(rows))
            .select(F.lit(table).alias("table_name"), "expectation", "action",
                    "total_rows", "failed_rows"))


def apply_expectations(df: DataFrame, expectations: Sequence[Expectation],
                       observation: Observation | None = None) -> DataFrame:
    """Attach expectation metrics to the plan (collected by the next action,
    no extra pass) and drop the violators of ``drop`` expectations."""
    if observation is not None and expectations:
        df = df.observe(observation, F.count(F.lit(1)).alias("total_rows"),
                        *[F.count_if(~_passes(e)).alias(e.name) for e in expectations])
    for e in expectations:
        if e.action == "drop":
            df = df.filter(_passes(e))
    return df


@dataclass(frozen=True)
class Split:
    """Rows that satisfy every ``drop`` rule, rows that do not (with the names
    of all rules that they fail), and the counts of the pass that wrote both."""
    kept: DataFrame
    quarantined: DataFrame
    stored: DataFrame
    metrics: dict


def split_by_expectations(df: DataFrame, expectations: Sequence[Expectation], path: str) -> Split:
    """Evaluate every rule once per row and store all rows in one pass, those
    that a ``drop`` rule removes beside the others: ``stored`` has the columns
    of df, ``_failed`` (bit i: rule i is not TRUE) and ``_quarantined``, by
    which its files are partitioned, so readers of kept rows open no others."""
    if not expectations or len(expectations) > 62:
        raise ValueError("from 1 to 62 expectations")
    failed = reduce(lambda a, b: a + b, [F.when(_passes(e), 0).otherwise(1 << i) for i, e in enumerate(expectations)])
    drops = sum(1 << i for i, e in enumerate(expectations) if e.action == "drop")
    counted = Observation()
    rows = df.withColumn("_failed", failed.cast("long"))
    rows = rows.withColumn("_quarantined", (F.col("_failed").bitwiseAND(F.lit(drops)) != 0).cast("int"))
    rows = rows.observe(counted, F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col("_quarantined") == 1).alias("quarantined_rows"),
                        *[F.count_if(F.col("_failed").bitwiseAND(F.lit(1 << i)) != 0).alias(e.name) for i, e in enumerate(expectations)])
    # a task holds a file open for each of the two values, so that it need not sort its rows by them
    spark, key = df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        rows.write.partitionBy("_quarantined").parquet(path)
    finally:
        spark.conf.set(key, before)
    stored = df.sparkSession.read.schema(rows.schema).parquet(path)
    names = F.filter(F.array(*[F.when(F.col("_failed").bitwiseAND(F.lit(1 << i)) != 0, e.name) for i, e in enumerate(expectations)]),
                     lambda x: x.isNotNull())
    return Split(stored.filter("_quarantined = 0").select(df.columns),
                 stored.filter("_quarantined = 1").select(*df.columns, names.alias("failed_rules")), stored, counted.get)


def check_contract(df: DataFrame, contract: Sequence[tuple], table: str) -> DataFrame:
    """Violations of a schema contract against the data itself.

    Output: table_name, column_name, violation (``missing_column`` |
    ``type_mismatch`` | ``null_in_non_nullable``), expected, actual, rows.
    Schema checks read metadata only; NULL counts are one aggregate."""
    spark: SparkSession = df.sparkSession
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    static = []
    null_checked = []
    for name, typ, nullable in contract:
        want = _SPARK_TYPE.get(typ, typ)
        if name not in actual:
            static.append((table, name, "missing_column", want, None, None))
            continue
        if actual[name] != want:
            static.append((table, name, "type_mismatch", want, actual[name], None))
        if not nullable:
            null_checked.append(name)
    schema = ("table_name string, column_name string, violation string, expected string, "
              "actual string, rows bigint")
    out = spark.createDataFrame(static, schema)
    if null_checked:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in null_checked])
        stacked = counts.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("rows")) for c in null_checked])))
        nulls = stacked.filter(F.col("rows") > 0).select(
            F.lit(table).alias("table_name"), "column_name",
            F.lit("null_in_non_nullable").alias("violation"), F.lit("not null").alias("expected"),
            F.lit("null").alias("actual"), "rows")
        out = out.unionByName(nulls)
    return out


def dq_alerts(report: DataFrame, threshold_pct: float = NULL_FEEDER_ALERT_PCT) -> DataFrame:
    """Utilities whose installed-DER null-feeder share exceeds the threshold."""
    return report.filter(F.col("installed_null_feeder_pct") > F.lit(threshold_pct))


def stale_datasets(freshness: DataFrame) -> DataFrame:
    return freshness.filter(F.col("is_stale"))
