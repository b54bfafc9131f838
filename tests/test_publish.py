"""Publication of a run, ownership of catalog tables, sinks sized by what they
store, the space-filling order, and the published column order."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from gridlake.plans import gold as G
from gridlake.plans.medallion import Layers, as_of_literal
from gridlake.plans.refresh import current_run, open_model, publish, refresh, register_tables
from gridlake.registry import DER_TYPES, GOLD_ORDER, SPECS, UTILITIES
from gridlake.session import scratch_path
from gridlake.sources import store
from gridlake.sources.derived import raw_frame
from gridlake.sources.landing import write_landing
from gridlake.streaming.bronze import landing_path
from tests.conftest import SF_SMALL


def parquet_files(path):
    return glob.glob(os.path.join(path.removeprefix("file:"), "*.parquet"))


def test_gold_columns_stand_in_published_order(spark):
    layers = Layers.from_testdata(spark, SF_SMALL, as_of_literal(), stage_raw=False)
    for table, columns in GOLD_ORDER.items():
        assert layers.gold[table].columns == list(columns)
    assert layers.gold["dim_feeder"].columns[:3] == ["global_feeder_id", "feeder_id", "utility_id"]


def test_literal_dimensions(spark):
    ts = as_of_literal()
    u, d = G.dim_utility(spark, ts), G.dim_der_type(spark, ts)
    assert u.dtypes == [("utility_id", "string"), ("utility_name", "string"), ("region", "string"), ("refresh_cadence", "string"),
                        ("is_active", "boolean"), ("_created_ts", "timestamp")]
    assert d.dtypes == [("type_code", "string"), ("type_name", "string"), ("description", "string"), ("category", "string"),
                        ("_created_ts", "timestamp")]
    assert [r.utility_id for r in u.orderBy("utility_id").collect()] == ["utility_1", "utility_2"] and u.count() == len(UTILITIES)
    kinds = {r.category: r["count"] for r in d.groupBy("category").count().collect()}
    assert kinds == {"Renewable": 7, "Conventional": 8, "Storage": 1, "Emerging": 1, "Other": 1}
    assert d.select("type_code").distinct().count() == len(DER_TYPES) == 18


def test_pointer_names_one_run(spark, tmp_dir):
    assert current_run(spark, tmp_dir) is None
    with pytest.raises(FileNotFoundError):
        open_model(spark, tmp_dir)
    for run in ("run-a", "run-b", "run-b"):
        publish(spark, tmp_dir, run)
        assert current_run(spark, tmp_dir) == run
        assert [f for f in os.listdir(os.path.join(tmp_dir, "_current")) if not f.startswith(".")] == [run]


def test_failed_run_publishes_nothing_and_the_next_one_all(spark):
    landing, model = scratch_path(spark, "landing"), scratch_path(spark, "model")
    s = next(x for x in SPECS if x.raw_table == "u2_install_der_raw")
    raw = raw_frame(spark, SF_SMALL, s.raw_table)
    raw = raw.select(*[c for c in raw.columns if not c.startswith("_")])
    place = landing_path(landing, s.utility_id, s.dataset)
    write_landing(raw, place, files=1)
    first = refresh(spark, landing, model, as_of=as_of_literal(), database_prefix="pub_")
    n = spark.table("pub_gold.fact_installed_der").count()
    assert n and current_run(spark, model) == first.run
    write_landing(raw.withColumn(s.key, F.concat(F.lit("b-"), s.key)), place, files=1)

    def stop(name):
        if name == "gold.fact_planned_der":
            raise KeyError(name)
    with pytest.raises(KeyError):
        refresh(spark, landing, model, as_of=as_of_literal(), database_prefix="pub_", on_table=stop)
    assert current_run(spark, model) == first.run
    seen = open_model(spark, model)
    assert spark.table("pub_gold.fact_installed_der").count() == seen["gold.fact_installed_der"].count() == n
    assert seen["platinum.v_der_by_feeder"].count() == spark.table("pub_platinum.v_der_by_feeder").count()
    last = refresh(spark, landing, model, as_of=as_of_literal(), database_prefix="pub_")
    assert current_run(spark, model) == last.run != first.run
    assert spark.table("pub_gold.fact_installed_der").count() == open_model(spark, model)["gold.fact_installed_der"].count() > n
    assert seen["gold.fact_installed_der"].count() == n      # readers of the old run are not disturbed


def test_tables_of_others_are_refused(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS own_gold")
    spark.sql("CREATE TABLE own_gold.dim_feeder (x int) USING parquet")
    spark.sql("INSERT INTO own_gold.dim_feeder VALUES (7)")
    path = os.path.join(tmp_dir, "t")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError, match="not registered by this model"):
        register_tables(spark, {"gold.dim_feeder": path}, tmp_dir, "own_")
    assert [r.x for r in spark.table("own_gold.dim_feeder").collect()] == [7]
    register_tables(spark, {"gold.dim_feeder": path}, tmp_dir, "mine_")
    with pytest.raises(ValueError, match="mine_gold"):
        register_tables(spark, {"gold.dim_feeder": path}, tmp_dir + "-other", "mine_")
    assert spark.table("mine_gold.dim_feeder").count() == 3


def test_catalog_moves_back_when_a_table_cannot_be_moved(spark, tmp_dir):
    old, new = ({q: os.path.join(tmp_dir, v, q) for q in ("gold.a", "gold.b")} for v in ("1", "2"))
    for path in old.values():
        spark.range(2).write.parquet(path)
    register_tables(spark, old, tmp_dir, "back_")
    spark.range(5).write.parquet(new["gold.a"])              # the second table's new folder is missing
    with pytest.raises(Exception):
        register_tables(spark, new, tmp_dir, "back_")
    assert spark.table("back_gold.a").count() == spark.table("back_gold.b").count() == 2


def test_file_counts_follow_from_stored_bytes(spark, tmp_dir):
    layers = Layers.from_testdata(spark, SF_SMALL, as_of_literal(), stage_raw=False)
    path = os.path.join(tmp_dir, "hc")
    store.write_clustered(layers.platinum["v_feeders_by_hc"], path, ["max_hosting_capacity_mw"], tiebreak=["global_feeder_id"])
    assert len(parquet_files(path)) == 1
    df = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
    rows, n = store._staged(df, None)
    assert n == 1 and rows.count() == 40_000
    stored = store.stored_bytes(spark, rows.inputFiles()[0].rsplit("/", 1)[0])
    assert store.files_for(stored, stored // 4 + 1) == 4 and store.files_for(0) == 1
    assert store.text_bytes(spark.createDataFrame([("ab", None), ("c", "dé")], "a string, b string")) == (2 + 5) + (1 + 1 + 3 + 5)


def test_curve_skips_files_for_either_column(spark, tmp_dir):
    df = spark.range(0, 20_000, 1, 4).select(
        F.format_string("u%d", F.col("id") % 40).alias("u"), (F.xxhash64("id") % 500).alias("f"), F.col("id").alias("k"))
    df = df.withColumn("f", F.when(F.col("k") % 97 != 0, F.col("f")))
    path = os.path.join(tmp_dir, "z")
    store.write_zordered(df, path, ["u", "f"], files=32, tiebreak=["k"])
    stored = spark.read.parquet(path)
    assert stored.columns == df.columns and stored.exceptAll(df).count() == 0 and stored.count() == 20_000
    for c in ("u", "f"):
        got = store.files_to_read(stored, c).collect()
        assert {r.files for r in got} == {32}
        assert sum(r.files_to_read for r in got) / len(got) < 12, c
    plain = os.path.join(tmp_dir, "lex")
    store.write_clustered(df, plain, ["u", "f"], files=32, tiebreak=["k"])
    lex = store.files_to_read(spark.read.parquet(plain), "f").collect()
    assert sum(r.files_to_read for r in lex) / len(lex) > 25          # the second column alone skips next to nothing


def test_rows_of_many_values(spark):
    rows = [(f"k{i % 50}", i) for i in range(1000)] + [(None, 5000)] + [("hot", i) for i in range(6000, 6700)]
    df = spark.createDataFrame(rows, "k string, id long")
    path = scratch_path(spark, "hashed")
    store.write_hashed(df, path, "k", folders=8, tiebreak=["id"])
    stored = spark.read.parquet(path)
    assert stored.count() == len(rows)
    for wanted in (["k3"], ["k3", "k3", None, "hot"], ["none"], [None], [], [f"k{i}" for i in range(50)]):
        found = store.rows_of(stored, spark.createDataFrame([(w, 1) for w in wanted], "k string, n int"), "k")
        assert found.columns == ["k", "id"]
        assert sorted((r.k, r.id) for r in found.collect()) == sorted(r for r in rows if r[0] is not None and r[0] in wanted)
    found = store.rows_of(stored, spark.createDataFrame([("k3",)], "k string"), "k")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_hash_of_8" in plan and "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,k3)" in plan
    assert len({r.f.split("/")[-2] for r in stored.filter("k = 'k3'").select(F.col("_metadata.file_path").alias("f")).collect()}) == 1


def test_hashed_folders_follow_stored_bytes(spark, monkeypatch):
    df = spark.range(20000).selectExpr("id", "sha2(cast(id as string), 256) AS k")
    monkeypatch.setattr(store, "TARGET_FILE_BYTES", 100_000)
    monkeypatch.setattr(store.files_for, "__defaults__", (100_000,))
    path = scratch_path(spark, "hashed")
    store.write_hashed(df, path, "k")
    stored = spark.read.parquet(path)
    part = next(c for c in stored.columns if c.startswith(store.HASH_FOLDER))
    assert 5 < int(part.removeprefix(store.HASH_FOLDER)) == stored.select(part).distinct().count() < 40
