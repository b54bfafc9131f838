"""What keeps a step's time and memory in line with its input: compiled
stages, shares of a scan, sorts by their bytes in memory, single passes."""

import os

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from gridlake import session
from gridlake.operators import feeder_rollup
from gridlake.operators.quality import split_by_expectations
from gridlake.registry import Expectation
from gridlake.session import JIT_METHOD_BYTES, ensure_compiled, scratch_path
from gridlake.sources import derived, landing, store
from gridlake.streaming import ledger


def test_entry_keeps_generated_methods_compilable(spark):
    import __spark_entry__ as E
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "65535")
        E._layers(spark, "/root/testdata/sf0.001")
        assert int(spark.conf.get(key)) == JIT_METHOD_BYTES
        spark.conf.set(key, "4000")
        ensure_compiled(spark)
        assert spark.conf.get(key) == "4000"            # a lower limit stays
    finally:
        spark.conf.set(key, before)


def test_large_scan_is_cut_by_bytes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(1000).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert derived.balanced(df, 5 * derived.SCAN_BYTES).rdd.getNumPartitions() == 5
    assert derived.balanced(df, 5 * derived.SCAN_BYTES).agg(F.sum("id")).first()[0] == 999 * 500


def test_scan_of_a_large_file_is_split_without_a_shuffle(spark, tmp_dir, monkeypatch):
    """Row groups far smaller than a share: the file's rows stay where they are read."""
    import __spark_entry__ as E
    key, path = "spark.sql.files.maxPartitionBytes", os.path.join(tmp_dir, "t.parquet")
    before = spark.conf.get(key)
    spark.range(400_000).withColumn("r", F.rand(1)).coalesce(1).write.option("parquet.block.size", 64 << 10).parquet(path)
    monkeypatch.setattr(derived, "SCAN_BYTES", 512 << 10)
    monkeypatch.setattr(session, "SCAN_BYTES", 512 << 10)
    try:
        E._layers(spark, "/root/testdata/sf0.001")
        assert int(spark.conf.get(key).rstrip("b")) == 512 << 10
        df = derived.read_table(spark, tmp_dir, "t")
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.rdd.getNumPartitions() >= store.files_for(store.stored_bytes(spark, path), 512 << 10) > 2
        assert df.count() == 400_000
        spark.conf.set(key, "1024")
        session.ensure_splits(spark)
        assert spark.conf.get(key) == "1024"            # a lower limit stays
    finally:
        spark.conf.set(key, before)


def test_large_row_group_is_spread(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t.parquet")
    spark.range(100_000).withColumn("r", F.rand(1)).coalesce(1).write.parquet(path)
    monkeypatch.setattr(derived, "SCAN_BYTES", 100 << 10)
    assert store.row_group_bytes(spark, spark.read.parquet(path).inputFiles()) > 2 * derived.SCAN_BYTES
    df = derived.read_table(spark, tmp_dir, "t")
    assert df.rdd.getNumPartitions() == store.files_for(store.stored_bytes(spark, path), 100 << 10)
    assert df.agg(F.sum("id")).first()[0] == 99_999 * 50_000


def test_rollup_moves_each_value_once(spark):
    """The values travel in the struct that ranks them, not beside it as well."""
    seg = spark.range(10).selectExpr("id % 2 AS feeder_id", "id AS section_id", "id * 1.5D AS voltage_kv", "1D AS feeder_max_hc_mw", "2D AS feeder_min_hc_mw",
                                     "CAST(NULL AS TIMESTAMP) AS hca_date", "'n' AS feeder_name", "TIMESTAMP'2024-01-01' AS _ingestion_ts")
    out = feeder_rollup(seg)
    assert sorted((r.feeder_id, r.voltage_kv, r.segment_count) for r in out.collect()) == [(0, 12.0, 5), (1, 13.5, 5)]
    assert "max_by" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_sorts_are_cut_by_bytes_in_memory(spark, tmp_dir, monkeypatch):
    """Equal texts are stored in next to no bytes, but are sorted at full length."""
    monkeypatch.setattr(store, "SORT_BYTES", 64 << 10)
    df = spark.range(2000).select(F.lit("x" * 100).alias("k"), F.col("id").cast("string").alias("u"))
    path = os.path.join(tmp_dir, "t")
    store.write_clustered(df, path, ["k"], tiebreak=["u"])
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) >= 4
    assert spark.read.parquet(path).distinct().count() == 2000


def test_empty_table_is_clustered(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    store.write_clustered(spark.range(0).select(F.col("id").cast("string").alias("k")), path, ["k"])
    assert spark.read.parquet(path).count() == 0


def test_rows_are_aligned_by_compiled_lookups(spark):
    headers = spark.createDataFrame([("f1", ["b", "a"]), ("f2", ["a"])], "file_path string, names array<string>")
    data = spark.createDataFrame([("f1", "1", "2"), ("f2", "3", None)], "file_path string, c0 string, c1 string")
    out = landing.align(data, headers, 2, ["a", "b", "z"])
    assert sorted(tuple(r) for r in out.collect()) == [("2", "1", None, "f1"), ("3", None, None, "f2")]
    rows = out._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "lambda" not in rows                         # no interpreted function for each row


def test_ledger_decodes_names_after_counting(spark, tmp_dir, monkeypatch):
    """A decoder that never gives the same name twice tells how often it was asked."""
    table = os.path.join(tmp_dir, "t x")
    monkeypatch.setattr(ledger, "_listed", lambda path: F.concat(path, F.uuid()))
    spark.range(10).selectExpr("cast(id % 2 as string) AS _source_file", "timestamp'2024-01-01' AS _ingestion_ts").coalesce(1).write.parquet(table)
    got = ledger.append_entries(spark, table, os.path.join(tmp_dir, "book"))
    assert sorted((r.source_file, r.n_rows) for r in got.collect()) == [("0", 5), ("1", 5)]


def test_split_is_written_without_a_sort(spark, tmp_dir, monkeypatch):
    key, seen, plain = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(key)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (seen.append(spark.conf.get(key)), plain(self, *a, **b))[1])
    df = spark.range(100).withColumn("v", F.when(F.col("id") % 4 != 0, F.col("id")))
    got = split_by_expectations(df, [Expectation("has_v", "v IS NOT NULL", "drop")], os.path.join(tmp_dir, "s"))
    assert (got.kept.count(), got.quarantined.count(), got.metrics["has_v"]) == (75, 25, 25)
    assert seen == ["2"] and spark.conf.get(key) == before


def test_compaction_makes_its_rows_once(spark, monkeypatch):
    import __spark_entry__ as E
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(x):
        made.add(1)
        return str(x)
    rows = spark.range(60).select(text("id").alias("a"), F.lit("f").alias("_source_file"))
    monkeypatch.setattr(E, "_raw", lambda *a: rows)
    assert sorted(int(r.a) for r in E.q_bronze_compaction(spark, "").collect()) == list(range(60))
    assert made.value == 60


def test_drops_are_landed_in_one_pass(spark, monkeypatch):
    import __spark_entry__ as E
    measured = []
    monkeypatch.setattr(E, "text_bytes", lambda df: measured.append(1) or 1)
    place = scratch_path(spark, "landing")
    E._land_all(spark, "/root/testdata/sf0.001", place)
    assert not measured
    for s in E.SPECS:
        landed = spark.read.option("header", "true").csv(f"{place}/{s.utility_id}/{s.dataset}")
        assert landed.count() == E._raw(spark, "/root/testdata/sf0.001", s.raw_table).count()
