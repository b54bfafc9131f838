"""Dedup, aggregation and quality operators; plan-shape checks."""

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from gridlake.operators import (
    apply_column_map,
    apply_expectations,
    check_contract,
    exact_sum,
    expectation_metrics,
    feeder_rollup,
    latest_per_key,
)
from gridlake.registry import CONTRACTS, Expectation

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def test_latest_row_of_each_key_against_a_dictionary(spark):
    rows = [(f"k{n * n % 23}", T0 + dt.timedelta(hours=n * 37 % 101), n) for n in range(100)]
    want = {}
    for key, at, n in sorted(rows, key=lambda r: (r[1], r[2])):
        want[key] = n
    df = spark.createDataFrame(rows, "asset string, _ingestion_ts timestamp, reading int")
    for parts in (1, 5):
        got = latest_per_key(df.repartition(parts), "asset").collect()
        assert len(got) == len(want) and {r.asset: r.reading for r in got} == want


def test_ties_are_deterministic(spark):
    rows = [("A", T1, "f1.csv", "x"), ("A", T1, "f2.csv", "y"), ("A", T1, "f2.csv", "z")]
    df = spark.createDataFrame(rows, "key string, _ingestion_ts timestamp, _source_file string, v string")
    winners = {latest_per_key(df.repartition(3), "key").first().v for _ in range(3)}
    winners |= {latest_per_key(df.orderBy(F.rand(7)), "key").first().v}
    assert winners == {"z"}  # latest file, then greatest remaining value


def test_null_keys_collapse_unless_kept(spark):
    df = spark.createDataFrame([(None, T0, "a"), (None, T1, "b"), ("K", T0, "c")],
                               "key string, _ingestion_ts timestamp, v string")
    assert sorted(r.v for r in latest_per_key(df, "key").collect()) == ["b", "c"]
    assert sorted(r.v for r in latest_per_key(df, "key", keep_null_keys=True).collect()) == ["a", "b", "c"]


def test_padded_keys_survive_unless_trimmed(spark):
    df = spark.createDataFrame([("A", T0, "x"), (" A", T1, "y")],
                               "key string, _ingestion_ts timestamp, v string")
    assert latest_per_key(df, "key").count() == 2
    assert [r.v for r in latest_per_key(df, "key", trim_key=True).collect()] == ["y"]


def test_top1_is_partially_applied_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("CAST(id % 10 AS STRING) AS key",
                                      "TIMESTAMP '2024-01-01 00:00:00' AS _ingestion_ts", "id")
    plan = latest_per_key(df, "key")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # partial limit sits below the exchange
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_apply_column_map_fills_missing(spark):
    df = spark.createDataFrame([("1", "Solar")], "DER_ID string, DER_TYPE string")
    out = apply_column_map(df, {"der_id": "DER_ID", "der_type": "DER_TYPE", "cost": "COST"})
    assert out.columns == ["der_id", "der_type", "cost"]
    assert tuple(out.first()) == ("1", "Solar", None)


def test_expectation_metrics_and_drop(spark):
    df = spark.createDataFrame([(1, 10.0), (None, 5.0), (3, None), (4, -1.0)], "id int, v double")
    exps = (Expectation("has_id", "id IS NOT NULL"), Expectation("positive", "v > 0", "drop"))
    m = {r.expectation: (r.total_rows, r.failed_rows)
         for r in expectation_metrics(df, exps, "t").collect()}
    assert m == {"has_id": (4, 1), "positive": (4, 2)}  # NULL predicate counts as failure
    obs = Observation("t")
    kept = apply_expectations(df, exps, obs)
    assert sorted(r.id or 0 for r in kept.collect()) == [0, 1]
    assert obs.get == {"total_rows": 4, "has_id": 1, "positive": 2}


def test_check_contract_reports_schema_and_nulls(spark):
    df = spark.createDataFrame([("g1", None, "u", 1)], "global_feeder_id string, feeder_id string, "
                               "utility_id string, segment_count int")
    out = {(r.column_name, r.violation) for r in
           check_contract(df, CONTRACTS[("gold", "dim_feeder")], "dim_feeder").collect()}
    assert ("feeder_id", "null_in_non_nullable") in out
    assert ("segment_count", "type_mismatch") in out
    assert ("voltage_kv", "missing_column") in out
    assert ("global_feeder_id", "null_in_non_nullable") not in out


def test_feeder_rollup_is_deterministic(spark):
    rows = [(1, 1, 13.2, 5.0, 1.0, T0, " F1", T0), (2, 1, 13.2, 5.0, 1.0, T0, "F1x", T1),
            (3, 2, None, None, None, None, None, T0), (None, 2, 4.0, 1.0, 0.5, T1, "F2", T1)]
    df = spark.createDataFrame(rows, "section_id long, feeder_id long, voltage_kv double, "
                               "feeder_max_hc_mw double, feeder_min_hc_mw double, hca_date timestamp, "
                               "feeder_name string, _ingestion_ts timestamp")
    results = {tuple(sorted(map(tuple, feeder_rollup(df.repartition(n)).collect()))) for n in (1, 2, 3)}
    assert len(results) == 1
    got = {r.feeder_id: r for r in feeder_rollup(df).collect()}
    assert got[1].feeder_name == "F1x" and got[1].segment_count == 2
    # latest ingestion wins even though its section id is NULL (not counted)
    assert got[2].voltage_kv == 4.0 and got[2].segment_count == 1


def test_exact_sum_is_order_independent(spark):
    vals = [0.1, 0.2, 0.3, 1e9, -1e9, 0.7, 12.34] * 50
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    sums = {df.repartition(n).agg(exact_sum("x").alias("s")).first().s for n in (1, 3, 7)}
    assert len(sums) == 1
    assert abs(sums.pop() - sum(vals)) < 1e-6


def test_exact_sums_leave_nothing_out(spark):
    import math

    from gridlake.operators.aggregate import exact_avg

    def run(values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return tuple(df.agg(exact_sum("x"), exact_avg("x")).first())

    assert run([1e33, 2e33, None]) == (3e33, 1.5e33)
    assert run([4e-7, 4e-7]) == (8e-7, 4e-7)
    assert run([0.1] * 10) == (1.0, 0.1)
    assert run([float("inf"), 1.0]) == (math.inf, math.inf)
    assert all(math.isnan(v) for v in run([float("nan"), 1.0, 4e-7, 1e33]))
    assert run([None]) == (None, None)
