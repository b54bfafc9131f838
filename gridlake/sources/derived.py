"""Raw (Bronze-shaped) utility tables derived from the driver's star-schema
tables by pure projections.

No utility CSV drops ship with the test data, so each raw dataset is a
SELECT over a given table: every value becomes text, and the text carries
the defects the pipeline must survive — null tokens, padded keys, duplicate
keys with older and equal ingestion times, ``12.0``/``12.9``/``00123``/
``1e3``/``abc`` numbers, ``yes``/``1``/``2`` booleans, ``MM/dd/yyyy`` dates,
rows with no, two, textual or negative technology flags.

Each expression is written in the SQL subset shared by Spark SQL and DuckDB,
so the same text builds the Spark frame (``selectExpr``) and the oracle CTE.
Work grows with the source tables: these are narrow, shuffle-free scans
(the circuits one joins the supplier dimension).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.registry import U1_TECH_COLUMNS, U2_TYPE_TO_CANONICAL
from gridlake.session import SCAN_BYTES
from gridlake.sources.store import files_for, row_group_bytes, stored_bytes


@dataclass(frozen=True)
class Derivation:
    name: str
    utility_id: str
    source: str               # main table
    where: str | None         # row predicate on the main table
    join: tuple | None        # (table, left key, right key) inner join
    columns: tuple            # ((column, sql expression), ...)


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _dec(expr: str, scale: int) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,{scale})) AS STRING)"


def _date(expr: str) -> str:
    return f"CAST(CAST({expr} AS DATE) AS STRING)"


def _us_date(expr: str) -> str:
    # MM/dd/yyyy: not a default timestamp format, so it parses to NULL.
    return (f"concat(lpad({_s(f'month({expr})')}, 2, '0'), '/', lpad({_s(f'day({expr})')}, 2, '0'), "
            f"'/', {_s(f'year({expr})')})")


def _flags(key: str) -> tuple:
    """The 14 technology columns. r = key % 16: r < 14 sets column r; r = 14
    gives a textual ``true`` and a negative flag (no type); r = 15 sets two
    flags (the earlier column wins)."""
    cols = []
    for i, name in enumerate(U1_TECH_COLUMNS):
        extra = ""
        if i == 0:
            extra = f" WHEN {key} % 16 = 14 THEN 'true'"
        elif i == 1:
            extra = f" WHEN {key} % 16 = 14 THEN '-1'"
        elif i == 4:
            extra = f" WHEN {key} % 16 = 15 THEN '2'"
        elif i == 9:
            extra = f" WHEN {key} % 16 = 15 THEN '1.5'"
        cols.append((name, f"CASE WHEN {key} % 16 = {i} THEN '1'{extra} ELSE '0' END"))
    return tuple(cols)


_U2_TYPES = list(U2_TYPE_TO_CANONICAL)  # 12 source codes, incl. ones the dimension lacks


def _u2_type(key: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_U2_TYPES))
    # 12 -> whitespace-only text (trims to '' -> NULL); 13 -> a code no map knows
    return f"CASE {key} % 14 {whens} WHEN 12 THEN '   ' ELSE 'Unknown Tech' END"


_U1_PROJECT_TYPE = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'RESPHOTO' WHEN '2-HIGH' THEN 'PVESS' "
                    "WHEN '3-MEDIUM' THEN 'ComWind' WHEN '4-NOT SPECIFIED' THEN 'OpCo Owned' "
                    "ELSE 'XYZ' END")

_U1_FEEDER_REF = _s("o_custkey % 128")

DERIVATIONS = (
    Derivation(
        "u1_circuits_raw", "utility_1", "lineitem", None, ("supplier", "l_suppkey", "s_suppkey"),
        (
            ("NYHCPV_csv_NSECTION",
             f"CASE WHEN l_orderkey % 997 = 0 THEN 'N/A' "
             f"WHEN l_orderkey % 503 = 1 THEN concat(' ', {_s('l_orderkey * 10 + l_linenumber')}) "
             f"ELSE {_s('l_orderkey * 10 + l_linenumber')} END"),
            ("NYHCPV_csv_NFEEDER",
             f"CASE WHEN l_orderkey % 50 = 7 THEN concat({_s('l_suppkey')}, '.0') "
             f"WHEN l_orderkey % 50 = 8 THEN lpad({_s('l_suppkey')}, 6, '0') "
             f"ELSE {_s('l_suppkey')} END"),
            ("NYHCPV_csv_FFEEDER",
             "CASE WHEN l_linenumber = 3 THEN concat(s_name, chr(9)) ELSE concat('  ', s_name) END"),
            ("NYHCPV_csv_NVOLTAGE",
             f"CASE l_orderkey % 41 WHEN 0 THEN 'abc' WHEN 1 THEN '1e3' WHEN 2 THEN 'NA' "
             f"WHEN 3 THEN '-4.16' WHEN 4 THEN 'na' ELSE {_dec('l_quantity * 0.5', 2)} END"),
            ("NYHCPV_csv_NMAXHC", _dec("l_discount * 10", 2)),
            ("NYHCPV_csv_NMAPCOLOR",
             "CASE l_linenumber % 3 WHEN 0 THEN 'GREEN' WHEN 1 THEN ' yellow ' ELSE 'Red' END"),
            ("NYHCPV_csv_FMAXHC",
             f"CASE WHEN s_suppkey % 10 = 3 THEN 'NULL' WHEN s_suppkey % 10 = 4 THEN '0' "
             f"ELSE {_dec('s_acctbal', 2)} END"),
            ("NYHCPV_csv_FMINHC", _dec("s_acctbal * 0.25", 4)),
            ("NYHCPV_csv_FVOLTAGE", _s("s_nationkey + 4")),
            ("NYHCPV_csv_FHCADATE",
             f"CASE WHEN s_suppkey % 7 = 0 THEN concat(lpad({_s('s_suppkey % 12 + 1')}, 2, '0'), '/01/2023') "
             f"ELSE concat('2023-', lpad({_s('s_suppkey % 12 + 1')}, 2, '0'), '-01') END"),
            ("Circuits_Phase3_NUMPHASES",
             "CASE l_linenumber % 4 WHEN 0 THEN '3' WHEN 1 THEN '1' WHEN 2 THEN '2.0' ELSE ' 3 ' END"),
            ("Circuits_Phase3_CIRCUIT", _s("l_partkey")),
            ("Shape_Length", _dec("l_extendedprice", 2)),
            ("_source_file", f"concat('landing/utility_1/circuits/circuits_', {_s('year(l_shipdate)')}, '.csv')"),
            ("_ingestion_ts", "CAST(l_shipdate AS TIMESTAMP)"),
        ),
    ),
    Derivation(
        "u2_circuits_raw", "utility_2", "part", None, None,
        (
            ("Master_CDF",
             f"CASE WHEN p_partkey % 211 = 5 THEN 'none' "
             f"WHEN p_partkey % 97 = 3 THEN concat(' CDF-', {_s('p_partkey - p_partkey % 2')}) "
             f"ELSE concat('CDF-', {_s('p_partkey - p_partkey % 2')}) END"),
            ("feeder_voltage", f"CASE WHEN p_size % 10 = 0 THEN 'n/a' ELSE {_s('p_size')} END"),
            ("feeder_max_hc", _dec("p_retailprice - 950", 2)),
            ("feeder_min_hc", _dec("p_retailprice * 0.25 - 200", 4)),
            ("feeder_dg_connected_since_refresh",
             f"CASE WHEN p_size % 3 = 0 THEN '' ELSE {_s('p_size * 2')} END"),
            ("hca_refresh_date",
             f"concat('2023-', lpad({_s('p_partkey % 12 + 1')}, 2, '0'), '-15 08:30:00')"),
            ("color", "concat('  ', upper(p_brand), ' ')"),
            ("shape_length", _s("p_size * 10")),
            ("_source_file", f"concat('landing/utility_2/circuits/feeders_', {_s('p_partkey % 4')}, '.csv')"),
            ("_ingestion_ts",
             "CASE WHEN p_partkey % 3 = 0 THEN TIMESTAMP '2024-01-05 00:00:00' "
             "ELSE TIMESTAMP '2024-01-20 00:00:00' END"),
        ),
    ),
    Derivation(
        "u1_install_der_raw", "utility_1", "orders", "o_orderstatus = 'F'", None,
        (
            ("ProjectID",
             f"CASE WHEN o_orderkey % 101 = 0 THEN 'NULL' "
             f"ELSE concat('P', {_s('o_orderkey - o_orderkey % 3')}) END"),
            ("ProjectType", _U1_PROJECT_TYPE),
            ("NamePlateRating",
             f"CASE WHEN o_orderkey % 37 = 0 THEN 'None' ELSE {_dec('o_totalprice', 2)} END"),
            ("ProjectCircuitID",
             f"CASE o_orderkey % 10 WHEN 0 THEN 'N/A' WHEN 5 THEN concat({_U1_FEEDER_REF}, '.0') "
             f"ELSE {_U1_FEEDER_REF} END"),
            ("Hybrid", "CASE o_orderkey % 5 WHEN 0 THEN 'yes' WHEN 1 THEN '1' WHEN 2 THEN '2' "
                       "WHEN 3 THEN 'false' ELSE 'N' END"),
        ) + _flags("o_orderkey") + (
            ("TotalChargesCESIR", _dec("o_totalprice * 0.01", 4)),
            ("TotalChargesConstruction", "''"),
            ("CESIR_EST", _s("o_custkey")),
            ("SystemUpgrade_EST", f"CASE WHEN o_orderkey % 9 = 0 THEN 'abc' ELSE {_s('o_custkey * 3')} END"),
            ("_source_file",
             f"concat('landing/utility_1/installed_der/der_', {_s('year(o_orderdate)')}, '.csv')"),
            ("_ingestion_ts", "CAST(o_orderdate AS TIMESTAMP)"),
        ),
    ),
    Derivation(
        "u1_planned_der_raw", "utility_1", "orders", "o_orderstatus <> 'F'", None,
        (
            ("ProjectID", f"concat('P', {_s('o_orderkey - o_orderkey % 3')})"),
            ("ProjectType", _U1_PROJECT_TYPE),
            ("ProjectStatus", "CASE o_orderstatus WHEN 'O' THEN 'In Queue' ELSE ' Approved ' END"),
            ("NamePlateRating", _dec("o_totalprice", 2)),
            ("ProjectCircuitID",
             f"CASE o_orderkey % 4 WHEN 0 THEN 'NULL' ELSE {_U1_FEEDER_REF} END"),
            ("Hybrid", "CASE o_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN '0' ELSE 'maybe' END"),
            ("InServiceDate", _date("o_orderdate")),
            ("CompletionDate",
             f"CASE WHEN o_orderkey % 4 = 1 THEN {_us_date('o_orderdate')} "
             f"ELSE concat({_date('o_orderdate')}, ' 12:00:00') END"),
        ) + _flags("o_custkey") + (
            ("_source_file",
             f"concat('landing/utility_1/planned_der/queue_', {_s('year(o_orderdate)')}, '.csv')"),
            ("_ingestion_ts", "CAST(o_orderdate AS TIMESTAMP)"),
        ),
    ),
    Derivation(
        "u2_install_der_raw", "utility_2", "events", "event_type = 'purchase'", None,
        (
            ("DER_ID", f"concat('D', {_s('user_id')}, '-', {_s('event_id % 7')})"),
            ("DER_TYPE", _u2_type("event_id")),
            ("DER_NAMEPLATE_RATING",
             f"CASE WHEN event_id % 29 = 0 THEN 'null' ELSE {_dec('value', 2)} END"),
            ("DER_INTERCONNECTION_LOCATION",
             f"CASE WHEN event_id % 50 = 0 THEN 'N/A' "
             f"ELSE concat('CDF-', {_s('(user_id * 2) % 2000')}) END"),
            ("SERVICE_STREET_ADDRESS", f"concat({_s('user_id')}, ' Main St  ')"),
            ("INTERCONNECTION_COST", _dec("value * 100", 2)),
            ("_source_file", f"concat('landing/utility_2/installed_der/der_', {_s('day(ts)')}, '.csv')"),
            ("_ingestion_ts", "CAST(ts AS TIMESTAMP)"),
        ),
    ),
    Derivation(
        "u2_planned_der_raw", "utility_2", "events", "event_type <> 'purchase'", None,
        (
            ("INTERCONNECTION_QUEUE_REQUEST_ID", f"concat('Q', {_s('user_id')}, '-', event_type)"),
            ("INTERCONNECTION_QUEUE_POSITION",
             f"CASE WHEN event_id % 9 = 0 THEN concat({_s('event_id % 500')}, '.7') "
             f"ELSE {_s('event_id % 500')} END"),
            ("DER_TYPE", _u2_type("event_id")),
            ("DER_NAMEPLATE_RATING", _dec("value", 2)),
            ("INVERTER_NAMEPLATE_RATING", _dec("value * 0.9", 3)),
            ("DER_INTERCONNECTION_LOCATION",
             f"CASE WHEN event_id % 50 = 1 THEN 'NA' "
             f"ELSE concat('CDF-', {_s('(user_id * 2) % 2000')}) END"),
            ("PLANNED_INSTALLATION_DATE",
             f"CASE WHEN event_id % 5 = 0 THEN {_us_date('ts')} ELSE {_date('ts')} END"),
            ("DER_STATUS", "CASE WHEN event_id % 4 = 0 THEN 'Active' ELSE 'N/A' END"),
            ("DER_STATUS_RATIONALE",
             "CASE WHEN event_id % 4 = 0 THEN '  pending study ' ELSE '' END"),
            ("TOTAL_MW_FOR_SUBSTATION", _s("user_id % 50")),
            ("_source_file", f"concat('landing/utility_2/planned_der/queue_', {_s('day(ts)')}, '.csv')"),
            ("_ingestion_ts", "CAST(ts AS TIMESTAMP)"),
        ),
    ),
)

RAW_TABLES = tuple(d.name for d in DERIVATIONS)
ENVIRONMENT = "dev"


def derivation(name: str) -> Derivation:
    for d in DERIVATIONS:
        if d.name == name:
            return d
    raise KeyError(name)


def select_list(d: Derivation, environment: str = ENVIRONMENT) -> list[str]:
    """The projection as SQL text: data columns, then the lineage tags."""
    return [f"{expr} AS {name}" for name, expr in d.columns] + [
        f"'{d.utility_id}' AS _utility_id", f"'{environment}' AS _environment"]


def raw_sql(d: Derivation, environment: str = ENVIRONMENT) -> str:
    """The derivation as a SQL query (DuckDB oracle side)."""
    frm = d.source
    if d.join:
        t, lk, rk = d.join
        frm = f"{d.source} JOIN {t} ON {lk} = {rk}"
    where = f" WHERE {d.where}" if d.where else ""
    return f"SELECT {', '.join(select_list(d, environment))} FROM {frm}{where}"


def balanced(df: DataFrame, n_bytes: int = 0, group_bytes: int = 0) -> DataFrame:
    """Spread a scan whose input splits are fewer than the cluster's task
    slots, or larger than ``SCAN_BYTES`` of its ``n_bytes``.

    Parquet splits only at row-group boundaries: one large file with a single
    row group is read by one task, and every narrow operator after it (text
    derivation, null normalisation, the map-side top-1 sort) would run on
    that one core. A layout of many files/row groups — the normal case at
    scale — already has enough splits (``ensure_splits``), and this is a no-op.
    The check uses the planner's own split count and the row groups' average
    ``group_bytes``; nothing is executed."""
    slots = max(df.sparkSession.sparkContext.defaultParallelism, files_for(n_bytes, SCAN_BYTES))
    if group_bytes <= 2 * SCAN_BYTES and df.rdd.getNumPartitions() >= slots:
        return df
    # Hash on the row's scan position: spreads rows evenly like round-robin
    # but needs no pre-shuffle sort (round-robin sorts every map partition to
    # stay deterministic on retry); the position is itself deterministic
    # because a file split is always read in the same order.
    return df.repartition(slots, F.monotonically_increasing_id())


def read_table(spark: SparkSession, sf_dir: str, name: str, where: str | None = None) -> DataFrame:
    """A given table, filtered in the scan and then spread."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    n_bytes = stored_bytes(spark, path)
    # smaller tables have no larger row group
    groups = row_group_bytes(spark, df.inputFiles()) if n_bytes > 2 * SCAN_BYTES else 0
    return balanced(df.filter(where) if where else df, n_bytes, groups)


def _names(expr: str) -> set:
    """The words of an expression, column names among them."""
    return set(re.findall(r"\w+", expr))


def raw_frame(spark: SparkSession, sf_dir: str, name: str,
              environment: str = ENVIRONMENT) -> DataFrame:
    d = derivation(name)
    df = read_table(spark, sf_dir, d.source, d.where)
    columns = select_list(d, environment)
    if d.join:
        t, lk, rk = d.join
        other = read_table(spark, sf_dir, t)
        # what depends on the joined table alone is made once for each of its rows
        own = {name: expr for name, expr in d.columns if _names(expr) & set(other.columns) and not _names(expr) & set(df.columns)}
        other = other.selectExpr("*", *[f"{expr} AS {name}" for name, expr in own.items()])
        df = df.join(other, df[lk] == F.col(rk))
        columns = [name if name in own else column for (name, _), column in zip(d.columns, columns)] + columns[len(d.columns):]
    return df.selectExpr(*columns)
