"""Layer composition: raw -> Silver -> Gold -> Platinum.

``Layers`` exposes every table of the model as a lazy DataFrame (one
Catalyst plan per table; nothing runs until an action). ``materialize``
writes each layer as parquet and reads it back, cutting lineage at layer
boundaries the way a scheduled pipeline does: downstream layers read
compact typed tables instead of re-running upstream plans, and a lost
executor only recomputes the stage it was in.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.plans import gold as G
from gridlake.plans import platinum as P
from gridlake.plans.silver import build_silver, build_typed
from gridlake.registry import GOLD_COLUMNS, SPECS, RunOptions
from gridlake.session import scratch_path
from gridlake.sources.derived import RAW_TABLES, raw_frame
from gridlake.sources.store import CLUSTER_BY, ZORDER_BY, write_balanced, write_clustered, write_zordered

SILVER_TABLES = frozenset(s.silver_table for s in SPECS)

DEFAULT_AS_OF = "2024-02-15 00:00:00"


def as_of_literal(ts: str = DEFAULT_AS_OF) -> Column:
    return F.lit(ts).cast("timestamp")


class LazyTables(Mapping):
    """Read-only mapping whose values are built on first access. Building a
    DataFrame analyses its plan on the driver; a query touching one table
    should not pay for all of them."""

    def __init__(self, factories: dict):
        self._factories = dict(factories)
        self._built: dict = {}

    def __getitem__(self, name):
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def __contains__(self, name):
        return name in self._factories

    def __iter__(self):
        return iter(self._factories)

    def __len__(self):
        return len(self._factories)


class Layers:
    """All tables of the model as lazy DataFrames over a set of raw tables."""

    def __init__(self, spark: SparkSession, raw: Mapping, as_of: Column | None = None,
                 options: RunOptions | None = None):
        self.spark = spark
        self.raw = raw
        self.as_of = as_of
        self.options = options or RunOptions()
        o = self.options
        # Silver rows before expectations (what expectation metrics count)
        self.silver_typed: Mapping = LazyTables({
            s.silver_table: (lambda s=s: build_typed(self.raw[s.raw_table], s, o))
            for s in SPECS if s.raw_table in raw})
        self.silver: Mapping = LazyTables({
            s.silver_table: (lambda s=s: build_silver(
                None, s, o, typed=self.silver_typed[s.silver_table]))
            for s in SPECS if s.raw_table in raw})
        self.wire_gold()

    def wire_gold(self) -> None:
        """(Re)define Gold and Platinum over the current ``silver`` mapping."""
        sv, a, o, spark = self.silver, self.as_of, self.options, self.spark
        self.gold: Mapping = LazyTables({
            **{t: (lambda t=t: G.conformed(t, sv, a, o)) for t in GOLD_COLUMNS},
            "dim_utility": lambda: G.dim_utility(spark, a),
            "dim_der_type": lambda: G.dim_der_type(spark, a),
        })
        self.wire_platinum()

    def wire_platinum(self) -> None:
        """(Re)define Platinum over the current ``gold`` mapping."""
        g, a = self.gold, self.as_of
        self.platinum: Mapping = LazyTables({
            "v_feeders_by_hc": lambda: P.v_feeders_by_hc(g["dim_feeder"]),
            "v_der_by_feeder": lambda: P.v_der_by_feeder(g["fact_installed_der"], g["fact_planned_der"]),
            "v_feeder_map_summary": lambda: P.v_feeder_map_summary(
                g["dim_feeder"], g["fact_installed_der"], g["fact_planned_der"]),
            "v_data_quality_report": lambda: P.v_data_quality_report(
                g["dim_feeder"], g["fact_installed_der"], g["fact_planned_der"], a),
            "v_ingestion_metadata": lambda: P.v_ingestion_metadata(dict(self.raw), a),
        })

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, as_of: Column | None = None,
                      options: RunOptions | None = None, stage_raw: bool = True) -> Layers:
        """Model over raw tables derived from the driver's tables. With
        ``stage_raw`` each raw table is written once (on first use) as a
        parquet Bronze table in the shared checkpoint folder and read from
        there — the shape of a real deployment, where Bronze is stored — so
        queries sharing a raw table do not re-derive it, and its lineage is
        cut."""
        def factory(name):
            if not stage_raw:
                return lambda: raw_frame(spark, sf_dir, name)
            return lambda: stage(raw_frame(spark, sf_dir, name), scratch_path(spark, f"bronze-{name}"))
        raw = LazyTables({n: factory(n) for n in RAW_TABLES})
        return cls(spark, raw, as_of, options)

    def table(self, name: str) -> DataFrame:
        for layer in (self.raw, self.silver, self.gold, self.platinum):
            if name in layer:
                return layer[name]
        raise KeyError(name)


def store_table(spark: SparkSession, df: DataFrame, path: str, name: str = "") -> DataFrame:
    """Store one table (clustered when it is a serving view with lookup keys,
    otherwise AQE-balanced files) and return the stored copy. The rows of a
    Silver table have just been dealt by a hash of their keys, one row a key:
    they are even as they come, and are not shuffled a second time."""
    if name in CLUSTER_BY:
        cols, tiebreak = CLUSTER_BY[name]
        write_clustered(df, path, cols, tiebreak=tiebreak)
    elif name in ZORDER_BY:
        cols, tiebreak = ZORDER_BY[name]
        write_zordered(df, path, cols, tiebreak=tiebreak)
    elif name in SILVER_TABLES:
        df.write.mode("overwrite").parquet(path)
    else:
        write_balanced(df, path)
    return spark.read.parquet(path)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet at ``path`` and return the stored table. The
    derived raw tables are narrow projections of evenly split scans, so the
    files follow those splits; no extra shuffle is spent on rebalancing."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize(layers: Layers, root: str) -> Layers:
    """Write Silver, then Gold over the stored Silver, then Platinum over the
    stored Gold, under ``root`` (a shared folder such as one below
    ``spark.checkpoint.dir``). Returns a Layers whose tables are the stored
    copies."""
    spark = layers.spark
    root = root.rstrip("/")
    out = Layers(spark, layers.raw, layers.as_of, layers.options)
    out.silver = {n: store_table(spark, layers.silver[n], f"{root}/silver/{n}", n)
                  for n in layers.silver}
    out.wire_gold()
    out.gold = {n: store_table(spark, out.gold[n], f"{root}/gold/{n}", n) for n in out.gold}
    out.wire_platinum()
    out.platinum = {n: store_table(spark, out.platinum[n], f"{root}/platinum/{n}", n)
                    for n in out.platinum}
    return out
