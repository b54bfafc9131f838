"""End to end on hand-written raw fixtures: every layer, exact expectations,
and invariants (one row per key, counts add up, partitioning-independence,
ANSI-independence)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridlake.plans.medallion import Layers, as_of_literal, materialize
from gridlake.registry import U1_TECH_COLUMNS, SPECS
from gridlake.session import scratch_path

T0, T1 = "2024-01-10 00:00:00", "2024-02-01 00:00:00"
AS_OF = "2024-02-15 00:00:00"


def raw(spark, utility, rows, columns):
    """All-string raw table + lineage columns (file, ingestion ts)."""
    cols = list(columns) + ["_source_file", "_ts"]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))
    return df.select(*[F.col(f"`{c}`") for c in columns], "_source_file",
                     F.col("_ts").cast("timestamp").alias("_ingestion_ts"),
                     F.lit(utility).alias("_utility_id"), F.lit("test").alias("_environment"))


U1C = ["NYHCPV_csv_NSECTION", "NYHCPV_csv_NFEEDER", "NYHCPV_csv_FFEEDER", "NYHCPV_csv_NVOLTAGE",
       "NYHCPV_csv_FMAXHC", "NYHCPV_csv_FMINHC", "NYHCPV_csv_FHCADATE"]
U2C = ["Master_CDF", "feeder_voltage", "feeder_max_hc", "feeder_min_hc", "hca_refresh_date", "color"]
U1D = ["ProjectID", "ProjectType", "ProjectStatus", "NamePlateRating", "ProjectCircuitID", "Hybrid",
       "InServiceDate"] + list(U1_TECH_COLUMNS)
U2I = ["DER_ID", "DER_TYPE", "DER_NAMEPLATE_RATING", "DER_INTERCONNECTION_LOCATION"]
U2P = ["INTERCONNECTION_QUEUE_REQUEST_ID", "DER_TYPE", "DER_NAMEPLATE_RATING",
       "DER_INTERCONNECTION_LOCATION", "DER_STATUS"]


def flags(**on):
    return tuple(on.get(c, "0") for c in U1_TECH_COLUMNS)


@pytest.fixture(scope="module")
def layers(spark):
    u1c = raw(spark, "utility_1", [
        ("10", "1", " Feeder One", "13.2", "5.0", "1.0", "2023-05-01", "a.csv", T0),
        ("10", "1", "Feeder One", "13.2", "5.0", "1.0", "2023-05-01", "b.csv", T1),  # newer dup
        (" 10", "1", "Feeder One", "abc", "5.0", "1.0", "2023-05-01", "a.csv", T0),  # padded key
        ("11", "1.0", "Feeder One", "1e3", "5.0", "1.0", "2023-05-01", "a.csv", T0),
        ("N/A", "1", "Feeder One", "13.2", "5.0", "1.0", "2023-05-01", "a.csv", T0),  # token key
        ("N/A", "1", "Feeder One", "13.2", "5.0", "1.0", "2023-05-01", "a.csv", T0),
        ("20", "2", "Feeder Two", "4.16", "NULL", "", "01/31/2024", "a.csv", T0),  # no HC: dropped
        ("30", "00003", "Feeder\tThree", "12.9", "0", "0", "2023-06-01", "a.csv", T0),
    ], U1C)
    u2c = raw(spark, "utility_2", [
        ("F-1", "12", "2.5", "0.5", "2023-01-15 08:30:00", " RED ", "c.csv", T0),
        ("F-2", "n/a", "0", "0", "2023-01-15", "Blue", "c.csv", T0),
        ("F-3", "4", "None", "", "2023-01-15", "green", "c.csv", T0),
    ], U2C)
    u1i = raw(spark, "utility_1", [
        ("P1", "RESPHOTO", None, "1000", "1", "yes", None) + flags(SolarPV="1") + ("d.csv", T0),
        ("P2", "ESS", None, "2000", "1.0", "1", None) + flags(EnergyStorageSystem="1") + ("d.csv", T0),
        ("P3", "CHP", None, "N/A", "N/A", "2", None) + flags(Wind="1", SolarPV="1") + ("d.csv", T0),
        ("P4", "XYZ", None, "50", "3", "no", None) + flags() + ("d.csv", T0),
        ("P5", "XYZ", None, "70", "3", "no", None) + flags(SolarPV="true", Wind="-1") + ("d.csv", T0),
    ], U1D)
    u1p = raw(spark, "utility_1", [
        ("P10", "PVESS", "In Queue", "300", "1", "Y", "2025-03-01") + flags(Hydro="1") + ("e.csv", T0),
        ("P11", "PVESS", "In Queue", "400", "NULL", "0", "03/01/2025") + flags(Other="1") + ("e.csv", T0),
    ], U1D)
    u2i = raw(spark, "utility_2", [
        ("D1", "Steam", "25.5", "F-1", "f.csv", T0),
        ("D2", "Battery Add-On", "null", "F-9", "f.csv", T0),
        ("D3", "   ", "10", "F-1", "f.csv", T0),
    ], U2I)
    u2p = raw(spark, "utility_2", [
        ("Q1", "Solar", "100", "F-1", "Active", "g.csv", T0),
        ("Q2", "Wind", "5", "NA", "N/A", "g.csv", T0),
    ], U2P)
    frames = {"u1_circuits_raw": u1c, "u2_circuits_raw": u2c, "u1_install_der_raw": u1i,
              "u1_planned_der_raw": u1p, "u2_install_der_raw": u2i, "u2_planned_der_raw": u2p}
    return Layers(spark, frames, as_of_literal(AS_OF))


def rows_by(df, key):
    return {r[key]: r for r in df.collect()}


def test_silver_circuits(layers):
    s = layers.silver["u1_circuits_clean"].collect()
    # 10 (newest), " 10" (padded twin), 11, one NULL-key row, 30; feeder 2 dropped (no HC)
    assert sorted((r.section_id or 0, r.feeder_id) for r in s) == [(0, 1), (10, 1), (10, 1), (11, 1), (30, 3)]
    by_sec = {(r.section_id, r.voltage_kv) for r in s}
    assert (11, 1000.0) in by_sec and (10, None) in by_sec and (10, 13.2) in by_sec
    u2 = rows_by(layers.silver["u2_circuits_clean"], "feeder_id")
    assert u2["F-1"].map_color == "red" and u2["F-2"].voltage_kv is None
    assert u2["F-3"].feeder_max_hc_mw is None and u2["F-1"].hca_date == dt.datetime(2023, 1, 15, 8, 30)


def test_silver_der(layers):
    i = rows_by(layers.silver["u1_install_der_clean"], "project_id")
    assert [i[p].der_type for p in ("P1", "P2", "P3", "P4", "P5")] == [
        "Solar", "Energy Storage", "Solar", None, None]
    assert [i[p].is_hybrid for p in ("P1", "P2", "P3", "P4")] == [True, True, None, False]
    assert i["P3"].feeder_id is None and i["P3"].nameplate_rating_kw is None
    p = rows_by(layers.silver["u1_planned_der_clean"], "project_id")
    assert p["P11"]._feeder_missing and not p["P10"]._feeder_missing
    assert p["P10"].in_service_date == dt.datetime(2025, 3, 1) and p["P11"].in_service_date is None
    u2 = rows_by(layers.silver["u2_install_der_clean"], "der_id")
    assert u2["D1"].der_type == "Steam" and u2["D3"].der_type is None and u2["D2"].is_hybrid is False


def test_dim_feeder(layers):
    d = {(r.utility_id, r.feeder_id): r for r in layers.gold["dim_feeder"].collect()}
    assert set(d) == {("utility_1", "1"), ("utility_1", "3"), ("utility_2", "F-1"),
                      ("utility_2", "F-2"), ("utility_2", "F-3")}
    f1 = d[("utility_1", "1")]
    assert f1.segment_count == 3 and f1.max_hosting_capacity_mw == 5.0 and f1.has_hosting_capacity
    assert f1.global_feeder_id == "utility_1::1" and f1.feeder_name == "Feeder One"
    assert d[("utility_1", "3")].has_hosting_capacity is False
    assert d[("utility_2", "F-3")].has_hosting_capacity is None
    assert d[("utility_2", "F-1")].segment_count == 1
    assert layers.gold["dim_feeder"].schema["segment_count"].dataType.simpleString() == "bigint"


def test_facts(layers):
    inst = rows_by(layers.gold["fact_installed_der"], "der_id")
    assert inst["P3"].global_der_id == "utility_1::P3" and inst["P3"].global_feeder_id is None
    assert inst["P3"]._feeder_missing and inst["D1"].der_status == "installed"
    assert inst["D1"].global_feeder_id == "utility_2::F-1"
    plan = rows_by(layers.gold["fact_planned_der"], "der_id")
    assert plan["Q2"]._feeder_missing and plan["Q1"].queue_status == "Active"
    assert plan["P10"].planned_date == dt.datetime(2025, 3, 1)


def test_map_summary(layers):
    m = {(r.utility_id, r.feeder_id): r for r in layers.platinum["v_feeder_map_summary"].collect()}
    f1 = m[("utility_1", "1")]
    # P1 joins feeder "1"; P2's "1.0" does not (ids kept as text); planned P10
    assert (f1.installed_der_count, f1.planned_der_count, f1.total_der_count) == (1, 1, 2)
    assert f1.installed_capacity_kw == 1000.0 and f1.installed_type_count == 1
    f3 = m[("utility_1", "3")]
    assert (f3.installed_der_count, f3.installed_type_count, f3.installed_capacity_kw) == (2, 0, 120.0)
    u2 = m[("utility_2", "F-1")]
    assert (u2.installed_der_count, u2.installed_type_count, u2.planned_der_count) == (2, 1, 1)
    assert m[("utility_2", "F-2")].total_der_count == 0
    for r in m.values():
        assert r.total_der_count == r.installed_der_count + r.planned_der_count


def test_dq_and_freshness(layers):
    q = rows_by(layers.platinum["v_data_quality_report"], "utility_id")
    assert (q["utility_1"].installed_total_rows, q["utility_1"].installed_null_feeder_count) == (5, 1)
    assert q["utility_1"].installed_null_feeder_pct == 20.0
    assert q["utility_2"].planned_null_feeder_pct == 50.0
    assert q["utility_1"].feeders_with_hc == 1 and q["utility_2"].feeders_with_hc == 1
    assert q["utility_2"].installed_avg_rating_kw == pytest.approx(17.75)
    f = rows_by(layers.platinum["v_ingestion_metadata"], "source_table")
    assert len(f) == 6
    assert f["u1_circuits_raw"].total_rows == 8 and f["u1_circuits_raw"].source_file_count == 2
    assert f["u1_circuits_raw"].days_since_last_load == 14 and f["u1_circuits_raw"].is_stale is False


def test_empty_raw_table_still_reports(spark, layers):
    empty = layers.raw["u2_planned_der_raw"].limit(0)
    frames = dict(layers.raw)
    frames["u2_planned_der_raw"] = empty
    f = rows_by(Layers(spark, frames, as_of_literal(AS_OF)).platinum["v_ingestion_metadata"],
                "source_table")
    e = f["u2_planned_der_raw"]
    assert (e.total_rows, e.last_ingestion_ts, e.is_stale) == (0, None, None)


def test_one_row_per_key_and_partitioning_independence(spark, layers):
    shuffled = {n: df.repartition(3).orderBy(F.rand(11)) for n, df in layers.raw.items()}
    again = Layers(spark, shuffled, as_of_literal(AS_OF))
    for name in ("v_feeder_map_summary", "v_data_quality_report", "v_der_by_feeder"):
        a = sorted(map(tuple, layers.platinum[name].collect()), key=repr)
        b = sorted(map(tuple, again.platinum[name].collect()), key=repr)
        assert a == b, name
    u2 = layers.silver["u2_install_der_clean"]
    assert u2.count() == u2.select("der_id").distinct().count()


def test_ansi_on_and_off_agree(spark, layers):
    res = []
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        res.append(sorted(map(tuple, layers.platinum["v_feeder_map_summary"].collect()), key=repr))
    spark.conf.unset("spark.sql.ansi.enabled")
    assert res[0] == res[1]


def test_materialize_roundtrip(spark, layers):
    stored = materialize(layers, scratch_path(spark, "model"))
    for name in ("v_feeder_map_summary", "dim_feeder"):
        a = sorted(map(tuple, layers.table(name).collect()), key=repr)
        b = sorted(map(tuple, stored.table(name).collect()), key=repr)
        assert a == b
    assert len(SPECS) == len(stored.silver)


def test_intent_options(spark, layers):
    from gridlake.registry import RunOptions
    opts = RunOptions(null_safe_ids=True, convert_units=True, map_types=True, trim_key=True,
                      canonical_feeder_ids=True)
    alt = Layers(spark, dict(layers.raw), as_of_literal(AS_OF), opts)
    i = rows_by(alt.silver["u1_install_der_clean"], "project_id")
    assert i["P1"].nameplate_rating_kw == 1.0                 # watts -> kW
    assert i["P2"].feeder_id == "1"                           # "1.0" now joins feeder 1
    u2 = rows_by(alt.silver["u2_install_der_clean"], "der_id")
    assert u2["D1"].der_type == "Steam Turbine" and u2["D2"].der_type == "Energy Storage"
    # padded " 10" collapses into "10" when keys are trimmed
    assert alt.silver["u1_circuits_clean"].filter("section_id = 10").count() == 1
    m = {(r.utility_id, r.feeder_id): r for r in alt.platinum["v_feeder_map_summary"].collect()}
    assert m[("utility_1", "1")].installed_der_count == 2
    f = rows_by(alt.gold["fact_installed_der"], "der_id")
    assert f["P3"].global_feeder_id is None and f["P1"].global_der_id == "utility_1::P1"
