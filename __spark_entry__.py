"""

Every query reads the driver's tables (through the raw derivations of
gridlake.sources.derived) so its work grows with them. Audit clocks are
pinned to one ``as_of`` literal so results are reproducible.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from gridlake import functions as GF  # noqa: E402
from gridlake.operators import (  # noqa: E402
    LatestState,
    apply_column_map,
    check_contract,
    dq_alerts,
    expectation_metrics,
    feeder_rollup,
    latest_per_key,
    normalize_nulls,
    split_by_expectations,
    stale_datasets,
)
from gridlake.plans import platinum as P  # noqa: E402
from gridlake.plans.medallion import Layers, as_of_literal  # noqa: E402
from gridlake.plans.refresh import current_run, open_model, refresh  # noqa: E402
from gridlake.registry import (  # noqa: E402
    CONTRACTS,
    GOLD_EXPECTATIONS,
    NULL_TOKENS_8,
    NULL_TOKENS_9,
    COLUMN_MAPS,
    SPECS,
    TYPE_MAPS,
    U1_PROJECT_TYPE_TO_CANONICAL,
    U2_TYPE_TO_CANONICAL,
    spec,
)
from gridlake.session import ensure_compiled, ensure_splits, ensure_utc, scratch_path  # noqa: E402
from gridlake.sources.compact import CompactedTable  # noqa: E402
from gridlake.sources.footers import contract_drift  # noqa: E402
from gridlake.sources.landing import read_landing, write_landing  # noqa: E402
from gridlake.sources.store import (  # noqa: E402
    CLUSTER_BY,
    ZORDER_BY,
    files_for,
    files_to_read,
    stored_bytes,
    text_bytes,
    write_bucketed,
    write_clustered,
    write_hashed,
    write_zordered,
)
from gridlake.streaming.arrivals import read_arrivals, start_arrivals  # noqa: E402
from gridlake.streaming.bronze import ingest, landing_path, read_raw_table  # noqa: E402
from gridlake.streaming.ledger import append_entries  # noqa: E402

try:                                    # the subpackage can be absent: all else works without it
    from gridlake.llm import queries as llm  # noqa: E402
except ImportError:
    llm = None

SF_SMOKE = "/root/testdata/sf0.001"


_PLANS: dict = {}


def _layers(spark: SparkSession, sf_dir: str) -> Layers:
    """Lazy plans for one session and data folder, shared by the queries of a
    run (plan objects only: nothing is cached or stored, and building a query
    runs no job; every action reads the columns it needs from the sources)."""
    ensure_utc(spark)
    ensure_compiled(spark)
    ensure_splits(spark)
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _PLANS:
        while len(_PLANS) >= 4:          # keep the most recent few data folders
            _PLANS.pop(next(iter(_PLANS)))
        _PLANS[key] = Layers.from_testdata(spark, sf_dir, as_of_literal(), stage_raw=False)
    return _PLANS[key]


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _layers(spark, sf_dir).raw[name]


def _u1_der(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Installed and planned raw rows of utility 1, i.e. every row of their
    source; a column that only one of them has is NULL for the other."""
    return _raw(spark, sf_dir, "u1_install_der_raw").unionByName(
        _raw(spark, sf_dir, "u1_planned_der_raw"), allowMissingColumns=True)


def _u1_der_clean(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    silver = _layers(spark, sf_dir).silver
    return silver["u1_install_der_clean"].select(*columns).unionByName(
        silver["u1_planned_der_clean"].select(*columns))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the per-feeder map summary over the whole model at sf0.001."""
    ensure_utc(spark)
    ensure_compiled(spark)
    ensure_splits(spark)
    layers = Layers.from_testdata(spark, SF_SMOKE, as_of_literal(), stage_raw=False)
    return layers.platinum["v_feeder_map_summary"]


# -- library operators ------------------------------------------------------

def q_null_tokens_9(spark, sf_dir):
    return normalize_nulls(_raw(spark, sf_dir, "u1_circuits_raw"), NULL_TOKENS_9)


def q_null_tokens_8(spark, sf_dir):
    return normalize_nulls(_u1_der(spark, sf_dir), NULL_TOKENS_8)


def q_lenient_casts(spark, sf_dir):
    r = _raw(spark, sf_dir, "u1_circuits_raw")
    return r.select(
        "NYHCPV_csv_NSECTION", GF.lenient_long("NYHCPV_csv_NSECTION").alias("section_id"),
        "NYHCPV_csv_NFEEDER", GF.lenient_long("NYHCPV_csv_NFEEDER").alias("feeder_id"),
        "NYHCPV_csv_NVOLTAGE", GF.lenient_double("NYHCPV_csv_NVOLTAGE").alias("voltage_kv"),
        "Circuits_Phase3_NUMPHASES", GF.lenient_int("Circuits_Phase3_NUMPHASES").alias("num_phases"),
        "NYHCPV_csv_FHCADATE", GF.lenient_ts("NYHCPV_csv_FHCADATE").alias("hca_date"),
    )


def q_lenient_bool_dates(spark, sf_dir):
    r = _u1_der(spark, sf_dir)
    return r.select(
        "ProjectID", "Hybrid", GF.lenient_bool("Hybrid").alias("is_hybrid"),
        "InServiceDate", GF.lenient_ts("InServiceDate").alias("in_service_date"),
        "CompletionDate", GF.lenient_ts("CompletionDate").alias("completion_date"),
        "NamePlateRating", GF.lenient_double("NamePlateRating").alias("nameplate_rating"),
    )


def q_latest_per_key(spark, sf_dir):
    r = normalize_nulls(_raw(spark, sf_dir, "u1_circuits_raw"), NULL_TOKENS_9)
    return latest_per_key(r, spec("utility_1", "circuits").key)


def q_latest_null_key(spark, sf_dir):
    r = normalize_nulls(_u1_der(spark, sf_dir), NULL_TOKENS_8)
    return latest_per_key(r, spec("utility_1", "installed_der").key, keep_null_keys=True)


def q_first_match_type(spark, sf_dir):
    r = _u1_der(spark, sf_dir)
    s = spec("utility_1", "installed_der")
    return r.select("ProjectID", GF.first_match(s.tech_columns, TYPE_MAPS["utility_1"])
                    .alias("der_type"))


def q_column_map(spark, sf_dir):
    """The published names of every dataset whose source is ``events``."""
    parts = [apply_column_map(_raw(spark, sf_dir, spec("utility_2", d).raw_table), COLUMN_MAPS["utility_2", d])
             for d in ("installed_der", "planned_der")]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def q_column_maps(spark, sf_dir):
    """P7: the published names of all six datasets, tagged with theirs."""
    parts = [apply_column_map(_raw(spark, sf_dir, spec(u, d).raw_table), COLUMN_MAPS[u, d]).withColumns(
        {"utility_id": F.lit(u), "dataset": F.lit(d)}) for u, d in COLUMN_MAPS]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def q_type_map(spark, sf_dir):
    r = _raw(spark, sf_dir, "u2_install_der_raw").unionByName(
        _raw(spark, sf_dir, "u2_planned_der_raw"), allowMissingColumns=True)
    src = F.trim("DER_TYPE")
    return r.select("DER_ID", "INTERCONNECTION_QUEUE_REQUEST_ID", src.alias("der_type_source"),
                    GF.map_values(src, U2_TYPE_TO_CANONICAL).alias("der_type"))


def q_project_type_map(spark, sf_dir):
    r = _u1_der(spark, sf_dir)
    return r.select("ProjectID", "ProjectType",
                    GF.map_values("ProjectType", U1_PROJECT_TYPE_TO_CANONICAL)
                    .alias("project_type_canonical"))


def q_unit_normalize(spark, sf_dir):
    s = _u1_der_clean(spark, sf_dir, "project_id", "nameplate_rating_kw")
    unit = spec("utility_1", "installed_der").rating_unit
    return s.select("project_id", F.col("nameplate_rating_kw").alias("nameplate_rating_w"),
                    GF.rating_to_kw("nameplate_rating_kw", unit).alias("nameplate_rating_kw"))


def q_global_ids(spark, sf_dir):
    s = _u1_der_clean(spark, sf_dir, "project_id", "feeder_id", "_utility_id")
    return s.select("project_id", "feeder_id",
                    GF.global_id("_utility_id", "feeder_id").alias("global_feeder_id_concat"),
                    GF.global_id_nullsafe("_utility_id", "feeder_id").alias("global_feeder_id_nullsafe"))


def q_feeder_rollup(spark, sf_dir):
    return feeder_rollup(_layers(spark, sf_dir).silver["u1_circuits_clean"])


def q_expectation_metrics(spark, sf_dir):
    """Q1/Q2: every expectation of every Silver and Gold table, counted over
    the rows the rule sees (before drop rules remove violators)."""
    L = _layers(spark, sf_dir)
    frames = [expectation_metrics(L.silver_typed[s.silver_table], s.expectations, s.silver_table)
              for s in SPECS]
    frames += [expectation_metrics(L.gold[t], exps, t) for t, exps in GOLD_EXPECTATIONS.items()]
    return reduce(DataFrame.unionByName, frames)


def q_expectation_quarantine(spark, sf_dir):
    """Q1/Q2: every Silver table stored in one pass with its rules' failure
    bits. For each rule the failures that the pass has counted, those found in
    what it has stored, and the rows kept and quarantined."""
    parts = []
    for s in SPECS:
        split = split_by_expectations(_layers(spark, sf_dir).silver_typed[s.silver_table], s.expectations,
                                      scratch_path(spark, f"split-{s.silver_table}"))
        found = split.stored.agg(F.count_if(F.col("_quarantined") == 0).alias("kept_rows"),
                                 F.count_if(F.col("_quarantined") == 1).alias("quarantined_rows"),
                                 *[F.count_if(F.col("_failed").bitwiseAND(F.lit(1 << i)) != 0).alias(f"f{i}") for i in range(len(s.expectations))])
        rules = F.array(*[F.struct(F.lit(e.name).alias("expectation"), F.lit(e.action).alias("action"),
                                   F.lit(split.metrics[e.name]).cast("long").alias("failed_rows"), F.col(f"f{i}").alias("stored_failed_rows"))
                          for i, e in enumerate(s.expectations)])
        parts.append(found.select(F.lit(s.silver_table).alias("table_name"), F.inline(rules), "kept_rows", "quarantined_rows"))
    return reduce(DataFrame.unionByName, parts)


LATEST_DROPS = 6


def q_latest_incremental(spark, sf_dir):
    """W1 over drops: the circuits' raw files arrive in LATEST_DROPS drops (by a
    hash of the file) and are merged one by one into a stored state, whose rows
    are those of one pass over everything."""
    r = normalize_nulls(_raw(spark, sf_dir, "u1_circuits_raw"), NULL_TOKENS_9)
    state = LatestState(spark, scratch_path(spark, "latest"), spec("utility_1", "circuits").key, fanout=3)
    drop = F.pmod(F.xxhash64("_source_file"), F.lit(LATEST_DROPS))
    for k in range(LATEST_DROPS):
        state.merge(r.filter(drop == k))
    return state.latest()


def q_contract_violations(spark, sf_dir):
    L = _layers(spark, sf_dir)
    frames = [check_contract(L.table(table), cols, table) for (_layer, table), cols in CONTRACTS.items()]
    return reduce(DataFrame.unionByName, frames)


def q_feeders_by_hc_lookup(spark, sf_dir):
    return P.feeders_by_hc(_layers(spark, sf_dir).platinum["v_feeders_by_hc"], min_hc=500.0)


def q_feeders_by_hc_utility_lookup(spark, sf_dir):
    return P.feeders_by_hc(_layers(spark, sf_dir).platinum["v_feeders_by_hc"], min_hc=0.0,
                           utility="utility_2")


def q_der_for_feeder_lookup(spark, sf_dir):
    return P.der_for_feeder(_layers(spark, sf_dir).platinum["v_der_by_feeder"], "24")


def q_stale_datasets(spark, sf_dir):
    return stale_datasets(_layers(spark, sf_dir).platinum["v_ingestion_metadata"])


def q_dq_alerts(spark, sf_dir):
    return dq_alerts(_layers(spark, sf_dir).platinum["v_data_quality_report"])


# -- ingestion (Bronze) -------------------------------------------------------

_DROP2_FROM = "landing/utility_1/installed_der/der_1998.csv"  # files from 1998 on: 2nd layout
_LINEAGE = ("_source_file", "_ingestion_ts", "_utility_id", "_environment")


def _two_layouts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Utility 1's DER rows in two layouts: the original column order, and (for
    later files) reversed order plus a new column; and all columns."""
    raw = _u1_der(spark, sf_dir)
    data_cols = [c for c in raw.columns if c not in _LINEAGE]
    late = F.col("_source_file") >= F.lit(_DROP2_FROM)
    early = raw.filter(~late).select(*data_cols)
    later = raw.filter(late).select(*reversed(data_cols), F.lit("added").alias("Notes"))
    return early, later, data_cols + ["Notes"]


def _drop_files(part: DataFrame) -> int:
    """Files of ~128 MB (at least two, so files of both layouts interleave)."""
    return max(2, files_for(text_bytes(part)))


def _land_two_layouts(spark: SparkSession, sf_dir: str, landing: str) -> list[str]:
    """Land both layouts as CSV drops."""
    early, later, cols = _two_layouts(spark, sf_dir)
    for part in (early, later):
        write_landing(part, landing, files=_drop_files(part))
    return cols


def q_csv_landing_read(spark, sf_dir):
    """S1-S6 (batch): header-aware read of mixed-layout CSV drops."""
    landing = scratch_path(spark, "landing")
    cols = _land_two_layouts(spark, sf_dir, landing)
    df = read_landing(spark, landing, "utility_1", columns=cols)
    return normalize_nulls(df.select(*cols), NULL_TOKENS_8)


def q_bronze_stream_ingest(spark, sf_dir):
    """S1-S7 (streaming): file-source stream -> append-only parquet raw table
    with availableNow; the table read back holds every landed row once."""
    landing = scratch_path(spark, "landing")
    cols = _land_two_layouts(spark, sf_dir, landing)
    table, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "bronze-ckpt")
    ingest(spark, landing, "utility_1", table, ckpt, columns=cols)
    return normalize_nulls(read_raw_table(spark, table).select(*cols), NULL_TOKENS_8)


def q_bronze_arrivals(spark, sf_dir):
    """S1/S3 while files land: drops of the second layout, with a column that no
    earlier file has, land between the micro-batches of a running stream."""
    landing, table = scratch_path(spark, "landing"), scratch_path(spark, "arrivals")
    early, later, cols = _two_layouts(spark, sf_dir)
    write_landing(early, landing, files=_drop_files(early))
    running = start_arrivals(spark, landing, "utility_1", table, scratch_path(spark, "arrivals-ckpt"))
    try:
        running.processAllAvailable()
        write_landing(later, landing, files=_drop_files(later))
        running.processAllAvailable()
    finally:
        running.stop()
    return normalize_nulls(read_arrivals(spark, table).select(*cols), NULL_TOKENS_8)


COMPACT_DROPS, COMPACT_FILES = 4, 6


def q_bronze_compaction(spark, sf_dir):
    """S11: a raw table of many small appends (COMPACT_DROPS of them, of
    COMPACT_FILES files each), packed into about COMPACT_FILES files after the
    third and again after the last; every row once."""
    raw = _raw(spark, sf_dir, "u1_circuits_raw")
    table = scratch_path(spark, "bronze")
    drops, packed = scratch_path(spark, "drops"), None
    # the rows are made once, with the number of their drop, not once for each drop
    raw.withColumn("_drop", F.pmod(F.xxhash64(*raw.columns), F.lit(COMPACT_DROPS))).write.parquet(drops)
    made = spark.read.parquet(drops)
    for drop in range(COMPACT_DROPS):
        made.filter(F.col("_drop") == drop).drop("_drop").repartition(COMPACT_FILES, F.monotonically_increasing_id()).write.mode("append").parquet(table)
        if drop == COMPACT_DROPS - 2:
            packed = CompactedTable(spark, table, scratch_path(spark, "packed"), max(1, stored_bytes(spark, table) // COMPACT_FILES))
            packed.compact()
    packed.compact()
    return packed.read()


def q_freshness_ledger(spark, sf_dir):
    """A8/T16 from ledgers: every raw table arrives in two appends, each entered
    in its ledger (the second entry is repeated, as after a failure); the report
    reads ledgers alone."""
    ledgers = {}
    for s in SPECS:
        raw, table, book = _raw(spark, sf_dir, s.raw_table), scratch_path(spark, "bronze"), scratch_path(spark, "ledger")
        late = F.pmod(F.xxhash64("_source_file"), F.lit(2)) == 1
        for again, part in ((1, raw.filter(~late)), (2, raw.filter(late))):
            part.write.mode("append").parquet(table)
            for _ in range(again):
                ledgers[s.raw_table] = append_entries(spark, table, book)
    return P.v_ingestion_metadata_of_ledgers(ledgers, as_of_literal())


def q_contract_drift(spark, sf_dir):
    """Q3 on stored files: the installed DER of utility 1 as their contract has
    them, those of utility 2 from a run that wrote ratings as text, left out
    is_hybrid and added a column. Rows of the files that depart, by run."""
    fact, path = _layers(spark, sf_dir).gold["fact_installed_der"], scratch_path(spark, "drift")
    contract = CONTRACTS["gold", "fact_installed_der"]
    whole = fact.select(*[name for name, *_ in contract])
    changed = whole.withColumn("nameplate_rating_kw", F.col("nameplate_rating_kw").cast("string")).withColumn(
        "remark", F.lit("new")).drop("is_hybrid")
    whole.filter("utility_id = 'utility_1'").write.parquet(f"{path}/run_1")
    changed.filter("utility_id = 'utility_2'").write.parquet(f"{path}/run_2")
    found = contract_drift(spark, [f"{path}/run_1", f"{path}/run_2"], contract, "fact_installed_der", root=path)
    return found.groupBy("table_name", "folder", "column_name", "violation", "expected", "actual").agg(
        F.sum("n_rows").alias("n_rows")).filter("n_rows > 0")


MAP_BUCKETS = 16


def q_bucketed_map_summary(spark, sf_dir):
    """J1/J2, A2/A3 without a shuffle: the dimension and a rollup of both facts
    stored in buckets by feeder; the summary moves no row."""
    gold, db = _layers(spark, sf_dir).gold, f"b{uuid.uuid4().hex[:12]}"
    home = scratch_path(spark, "bucketed")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{home}/db'")
    rollup = P.der_rollup(gold["fact_installed_der"], gold["fact_planned_der"])
    dim = write_bucketed(gold["dim_feeder"], f"{db}.dim_feeder", f"{home}/dim_feeder", P.FEEDER_KEYS, MAP_BUCKETS)
    return P.v_feeder_map_of_rollup(dim, write_bucketed(rollup, f"{db}.der_rollup", f"{home}/der_rollup", P.FEEDER_KEYS, MAP_BUCKETS))


def _land_all(spark: SparkSession, sf_dir: str, landing: str) -> None:
    for s in SPECS:
        raw = _raw(spark, sf_dir, s.raw_table).drop(*_LINEAGE)
        # a file for each share of the scan: no pass to measure the text, no shuffle of it
        write_landing(raw, landing_path(landing, s.utility_id, s.dataset), quote_all=False)


def q_refresh_failed_run(spark, sf_dir):
    """S9: a run over all drops, then more drops (every DER row of
    utility 1 again, under new ids) and a run that fails in Platinum. Readers
    see run one whole, through the catalog and through the pointer alike."""
    landing, model = scratch_path(spark, "landing"), scratch_path(spark, "model")
    _land_all(spark, sf_dir, landing)
    prefix = f"r{uuid.uuid4().hex[:12]}_"
    first = refresh(spark, landing, model, as_of=as_of_literal(), database_prefix=prefix, consume=True)
    for s in SPECS:
        if s.utility_id == "utility_1" and s.dataset != "circuits":
            again = _raw(spark, sf_dir, s.raw_table).drop(*_LINEAGE)
            write_landing(again.withColumn(s.key, F.concat(F.lit("again-"), s.key)), landing_path(landing, s.utility_id, s.dataset), quote_all=False)

    class Stopped(Exception):
        pass

    def stop(name: str) -> None:
        if name == "platinum.v_der_by_feeder":
            raise Stopped
    try:
        refresh(spark, landing, model, as_of=as_of_literal(), database_prefix=prefix, on_table=stop, consume=True)
    except Stopped:
        pass
    seen = open_model(spark, model)
    parts = []
    for t in ("dim_feeder", "fact_installed_der", "fact_planned_der"):
        for how, df in (("catalog", spark.table(f"{prefix}gold.{t}")), ("pointer", seen[f"gold.{t}"])):
            parts.append(df.groupBy(F.lit(t).alias("table_name"), F.lit(how).alias("read_through"), "utility_id").agg(
                F.count("*").alias("n_rows"), F.lit(current_run(spark, model) == first.run).alias("of_first_run")))
    return reduce(DataFrame.unionByName, parts)


def q_refresh_tables(spark, sf_dir):
    """The whole refresh, CSV drops of all six datasets to serving views, read
    through the catalog: rows of each stored Bronze and fact table by utility
    and environment, with how many of them name a CSV file of their own drop
    and how many load times they carry (one for each triggered run)."""
    landing = scratch_path(spark, "landing")
    _land_all(spark, sf_dir, landing)
    prefix = f"r{uuid.uuid4().hex[:12]}_"
    refresh(spark, landing, scratch_path(spark, "model"), as_of=as_of_literal(), database_prefix=prefix, consume=True)
    parts = [spark.table(f"{prefix}bronze.{s.raw_table}").groupBy(
        F.lit(f"bronze.{s.raw_table}").alias("table_name"), F.col("_utility_id").alias("utility_id"),
        F.col("_environment").alias("environment")).agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.col("_source_file").contains(f"/{s.utility_id}/{s.dataset}/")
                       & F.col("_source_file").endswith(".csv")).alias("from_own_drop"),
            F.count_distinct("_ingestion_ts").alias("load_times")) for s in SPECS]
    parts += [spark.table(f"{prefix}gold.{t}").groupBy(
        F.lit(f"gold.{t}").alias("table_name"), "utility_id", F.lit(None).cast("string").alias("environment")).agg(
            F.count("*").alias("n_rows"), F.lit(None).cast("long").alias("from_own_drop"),
            F.lit(None).cast("long").alias("load_times")) for t in ("fact_installed_der", "fact_planned_der")]
    return reduce(DataFrame.unionByName, parts)


def q_clustered_hc_lookup(spark, sf_dir):
    """S10/S11 + F10: store v_feeders_by_hc range-clustered on
    max_hosting_capacity_mw, then run the hosting-capacity lookup against
    the stored copy (the predicate reaches the parquet scan)."""
    path = scratch_path(spark, "v_feeders_by_hc")
    view = _layers(spark, sf_dir).platinum["v_feeders_by_hc"]
    cols, tiebreak = CLUSTER_BY["v_feeders_by_hc"]
    write_clustered(view, path, cols, tiebreak=tiebreak)
    return P.feeders_by_hc(spark.read.parquet(path), min_hc=500.0)


LOOKUP_FOLDERS = 16


def q_der_for_requested_feeders(spark, sf_dir):
    """F11 for many keys: the DER on every feeder of utility 1 that can host
    9000 MW or more, from a copy in folders by feeder."""
    path = scratch_path(spark, "v_der_by_feeder")
    tables = _layers(spark, sf_dir).platinum
    write_hashed(tables["v_der_by_feeder"], path, "feeder_id", folders=LOOKUP_FOLDERS, tiebreak=CLUSTER_BY["v_der_by_feeder"][1])
    requested = P.feeders_by_hc(tables["v_feeders_by_hc"], min_hc=9000.0, utility="utility_1")
    return P.der_for_feeders(spark.read.parquet(path), requested)


ZORDER_FILES = 16


def q_zorder_lookup(spark, sf_dir):
    """S10: v_feeder_map_summary along a Z-curve over (utility_id, feeder_id):
    for every value of either column the rows that a lookup finds, and whether
    the files' spans rule out part of the files."""
    path = scratch_path(spark, "v_feeder_map_summary")
    cols, tiebreak = ZORDER_BY["v_feeder_map_summary"]
    write_zordered(_layers(spark, sf_dir).platinum["v_feeder_map_summary"], path, cols, files=ZORDER_FILES, tiebreak=tiebreak)
    stored = spark.read.parquet(path)
    return reduce(DataFrame.unionByName, [files_to_read(stored, c).select(
        F.lit(c).alias("column_name"), "value", "n_rows", (F.col("files_to_read") < F.col("files")).alias("skips")) for c in cols])


def q_clustered_der_lookup(spark, sf_dir):
    """S10 + F11: v_der_by_feeder clustered on feeder_id, point lookup."""
    path = scratch_path(spark, "v_der_by_feeder")
    view = _layers(spark, sf_dir).platinum["v_der_by_feeder"]
    cols, tiebreak = CLUSTER_BY["v_der_by_feeder"]
    write_clustered(view, path, cols, tiebreak=tiebreak)
    return P.der_for_feeder(spark.read.parquet(path), "24")


def _table_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        return _layers(spark, sf_dir).table(name)
    run.__name__ = f"q_{name}"
    return run


_TABLES = [s.silver_table for s in SPECS] + [
    "dim_feeder", "fact_installed_der", "fact_planned_der",
    "v_feeders_by_hc", "v_der_by_feeder", "v_feeder_map_summary",
    "v_data_quality_report", "v_ingestion_metadata",
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "null_tokens_9": q_null_tokens_9,
        "null_tokens_8": q_null_tokens_8,
        "lenient_casts": q_lenient_casts,
        "lenient_bool_dates": q_lenient_bool_dates,
        "latest_per_key": q_latest_per_key,
        "latest_null_key": q_latest_null_key,
        "first_match_type": q_first_match_type,
        "column_map": q_column_map,
        "column_maps": q_column_maps,
        "type_map": q_type_map,
        "project_type_map": q_project_type_map,
        "unit_normalize": q_unit_normalize,
        "global_ids": q_global_ids,
        "feeder_rollup": q_feeder_rollup,
    }
    for t in _TABLES:
        out[t] = _table_query(t)
    out.update({
        "expectation_metrics": q_expectation_metrics,
        "contract_violations": q_contract_violations,
        "feeders_by_hc_lookup": q_feeders_by_hc_lookup,
        "feeders_by_hc_utility_lookup": q_feeders_by_hc_utility_lookup,
        "der_for_feeder_lookup": q_der_for_feeder_lookup,
        "stale_datasets": q_stale_datasets,
        "dq_alerts": q_dq_alerts,
        "csv_landing_read": q_csv_landing_read,
        "bronze_stream_ingest": q_bronze_stream_ingest,
        "refresh_tables": q_refresh_tables,
        "clustered_hc_lookup": q_clustered_hc_lookup,
        "clustered_der_lookup": q_clustered_der_lookup,
        "zorder_lookup": q_zorder_lookup,
        "der_for_requested_feeders": q_der_for_requested_feeders,
        "latest_incremental": q_latest_incremental,
        "expectation_quarantine": q_expectation_quarantine,
        "refresh_failed_run": q_refresh_failed_run,
        "bronze_arrivals": q_bronze_arrivals,
        "bronze_compaction": q_bronze_compaction,
        "freshness_ledger": q_freshness_ledger,
        "contract_drift": q_contract_drift,
        "bucketed_map_summary": q_bucketed_map_summary,
    })
    if llm is not None:
        out.update(llm.queries())
    return out


def oracle_sql() -> dict[str, str]:
    from oracle_duckdb import sql_for
    out = {}
    for name in queries():
        try:
            out[name] = sql_for(name)
        except KeyError:
            pass  # no SQL form: rows-only check
    if llm is not None:
        out.update(llm.oracle_sql())
    return out
