"""Gold: conformed feeder dimension, DER facts, static dimensions.

The conformed tables are built from the registry alone: ``GOLD_COLUMNS`` says
what a table holds, ``DatasetSpec.gold`` where a utility's Silver table names
it otherwise. A further utility is one more entry there.

``as_of`` (a timestamp Column) stamps audit columns; the default is the
query's current_timestamp(). Passing a literal makes runs reproducible.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions import global_id, global_id_nullsafe
from gridlake.operators.aggregate import feeder_rollup
from gridlake.registry import DER_TYPES, GOLD_COLUMNS, GOLD_DATASET, GOLD_ORDER, SPECS, UTILITIES, DatasetSpec, RunOptions


def _ts(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of.cast("timestamp")


def _conform(table: str, s: DatasetSpec, silver: DataFrame) -> DataFrame:
    """One utility's rows in the columns of a Gold table."""
    if s.segments:
        silver = feeder_rollup(silver)
    elif s.dataset == "circuits":
        silver = silver.withColumn("segment_count", F.lit(1))
    have = set(silver.columns)

    def column(name: str, kind: str) -> Column:
        source = s.gold.get(name, name)
        return (F.col(source) if source in have else F.lit(None)).cast(kind).alias(name)

    return silver.select(F.lit(s.utility_id).alias("utility_id"), *[column(*c) for c in GOLD_COLUMNS[table]])


def conformed(table: str, silver: Mapping, as_of: Column | None = None,
              options: RunOptions | None = None) -> DataFrame:
    """The dimension or fact ``table`` over every utility's Silver table of its
    dataset. Ids of feeders and DER are NULL-safe by option only; a fact's
    reference to its feeder always is."""
    own_id = global_id_nullsafe if (options or RunOptions()).null_safe_ids else global_id
    dataset = GOLD_DATASET[table]
    rows = reduce(DataFrame.unionByName,
                  [_conform(table, s, silver[s.silver_table]) for s in SPECS if s.dataset == dataset])
    if dataset == "circuits":
        more = {"global_feeder_id": own_id("utility_id", "feeder_id"),
                "has_hosting_capacity": F.col("max_hosting_capacity_mw") > 0}
    else:
        more = {"global_der_id": own_id("utility_id", "der_id"),
                "global_feeder_id": global_id_nullsafe("utility_id", "feeder_id"),
                "der_status": F.lit(dataset.removesuffix("_der")),
                "_feeder_missing": F.col("feeder_id").isNull()}
    return rows.select("*", *[c.alias(n) for n, c in more.items()], _ts(as_of).alias("_gold_created_ts")).select(*GOLD_ORDER[table])


def dim_utility(spark: SparkSession, as_of: Column | None = None) -> DataFrame:
    rows = [(u.utility_id, u.name, u.region, u.refresh_cadence, u.is_active) for u in UTILITIES]
    schema = ("utility_id string, utility_name string, region string, refresh_cadence string, "
              "is_active boolean")
    return spark.createDataFrame(rows, schema).withColumn("_created_ts", _ts(as_of))


def dim_der_type(spark: SparkSession, as_of: Column | None = None) -> DataFrame:
    schema = "type_code string, type_name string, description string, category string"
    return spark.createDataFrame(list(DER_TYPES), schema).withColumn("_created_ts", _ts(as_of))
