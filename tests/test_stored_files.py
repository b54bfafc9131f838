"""Files of stored tables: footers, contract drift, compaction, the ledger."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridlake.plans import platinum as P
from gridlake.plans.medallion import as_of_literal
from gridlake.sources import compact as C
from gridlake.sources.compact import CompactedTable
from gridlake.sources.footers import contract_drift, footers, listing
from gridlake.streaming.bronze import ingest, read_raw_table
from gridlake.streaming.ledger import append_entries

CONTRACT = (("k", "string", False), ("v", "double", True), ("n", "long", True))


def noise(spark, rows, seed=1, files=1):
    """Rows that no encoding makes shorter."""
    return spark.range(rows).select("id", F.sha2(F.concat(F.lit(str(seed)), F.col("id").cast("string")), 512).alias("text")).repartition(files)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_footers_give_rows_and_spark_types(spark, tmp_dir):
    spark.sql("SELECT 'a' AS k, 1.5D AS v, 2L AS n, TIMESTAMP '2024-01-01 00:00:00' AS t, true AS b, "
              "CAST(1 AS DECIMAL(38,6)) AS d, array(1) AS a").coalesce(1).write.parquet(f"{tmp_dir}/t")
    row = footers(listing(spark, f"{tmp_dir}/t")).first()
    assert row.n_rows == 1 and row.data_bytes > 0 and row.file.endswith(".parquet")
    assert {c.name: c.type for c in row.columns} == {"k": "string", "v": "double", "n": "bigint", "t": "timestamp",
                                                     "b": "boolean", "d": "decimal(38,6)", "a": "array<int>"}


def test_drift_names_the_files_that_depart(spark, tmp_dir):
    path = f"{tmp_dir}/table one"
    for run, sql in (("run=1", "SELECT 'a' AS k, 1.5D AS v, 2L AS n"), ("run=2", "SELECT 'a' AS k, '1.5' AS v, 2L AS n"),
                     ("run=3", "SELECT 'a' AS k, 1.5D AS v, 'x' AS more")):
        spark.sql(sql).coalesce(1).write.parquet(f"{path}/{run}")
    rows = contract_drift(spark, path, CONTRACT, "t").collect()
    assert sorted((r.folder, r.column_name, r.violation, r.expected, r.actual, r.n_rows) for r in rows) == [
        ("run=2", "v", "type_mismatch", "double", "string", 1),
        ("run=3", "more", "unknown_column", None, "string", 1),
        ("run=3", "n", "missing_column", "bigint", None, 1)]
    assert all(r.table_name == "t" and f"/{r.folder}/part-" in r.file for r in rows)


def test_a_table_as_its_contract_has_no_drift(spark, tmp_dir):
    spark.sql("SELECT 'a' AS k, 1.5D AS v, 2L AS n WHERE false").write.parquet(f"{tmp_dir}/t")
    assert contract_drift(spark, f"{tmp_dir}/t", CONTRACT, "t").count() == 0


def test_packed_files_are_of_the_target_size_and_stay(spark, tmp_dir):
    source = f"{tmp_dir}/raw"
    for k in range(3):
        noise(spark, 3000, k, files=7).write.mode("append").parquet(source)
    target = 300_000
    table = CompactedTable(spark, source, f"{tmp_dir}/packed", target)
    before = bag(spark.read.parquet(source))
    assert table.files().count() == 21
    assert bag(table.read()) == before                       # also before anything is packed
    assert table.compact() == 21
    sizes = [r.data_bytes for r in table.files().collect()]
    assert len(sizes) > 2 and all(target / 2 <= s <= 2 * target for s in sizes)
    assert bag(table.read()) == before
    published = os.listdir(f"{tmp_dir}/packed/_current")
    assert table.compact() == 0 and os.listdir(f"{tmp_dir}/packed/_current") == published
    assert len(os.listdir(f"{tmp_dir}/packed/parts")) == 1


def test_later_drops_wider_files_and_large_files(spark, tmp_dir):
    source = f"{tmp_dir}/raw"
    noise(spark, 200, 1, files=4).write.parquet(source)
    table = CompactedTable(spark, source, f"{tmp_dir}/packed", 200_000)
    assert table.compact() == 4 and table.files().count() == 1
    noise(spark, 100, 2, files=2).withColumn("added", F.lit("x")).write.mode("append").parquet(source)
    noise(spark, 4000, 3).write.mode("append").parquet(source)      # one file above the target: left as it is
    wide = spark.read.option("mergeSchema", "true").parquet(source)
    assert bag(table.read().select(wide.columns)) == bag(wide)
    assert table.compact() == 3                                     # the packed file, too small still, and two new ones
    assert table.files().count() == 2
    assert bag(table.read().select(wide.columns)) == bag(wide)
    assert table.compact() == 0


def test_a_compaction_that_fails_changes_nothing(spark, tmp_dir, monkeypatch):
    source = f"{tmp_dir}/raw"
    noise(spark, 300, files=5).write.parquet(source)
    table = CompactedTable(spark, source, f"{tmp_dir}/packed", 1 << 20)

    def fail(*args):
        raise OSError("store is away")
    with monkeypatch.context() as m:
        m.setattr(C, "publish", fail)
        with pytest.raises(OSError):
            table.compact()
    assert table.files().count() == 5 and table.read().count() == 300
    assert table.compact() == 5 and table.files().count() == 1 and table.read().count() == 300


def test_running_sums_over_many_cells(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(C, "CELL_FILES", 3)
    source = f"{tmp_dir}/raw"
    noise(spark, 2000, files=20).write.parquet(source)
    table = CompactedTable(spark, source, f"{tmp_dir}/packed", 100_000)
    assert table.compact() == 20
    assert all(50_000 <= r.data_bytes <= 200_000 for r in table.files().collect())
    assert bag(table.read()) == bag(spark.read.parquet(source))


def test_an_empty_table_has_nothing_to_pack(spark, tmp_dir):
    spark.range(0).write.parquet(f"{tmp_dir}/raw")
    table = CompactedTable(spark, f"{tmp_dir}/raw", f"{tmp_dir}/packed")
    assert table.compact() == 0 and table.read().count() == 0 and table.read().columns == ["id"]


def test_a_stream_and_its_compaction(spark, tmp_dir):
    land, raw, ckpt = (os.path.join(tmp_dir, p) for p in ("land", "raw", "ckpt"))
    os.makedirs(land)
    table = CompactedTable(spark, raw, f"{tmp_dir}/packed")
    for k in range(3):
        with open(f"{land}/{k}.csv", "w") as f:
            f.write(f"k,v{k}\n{k},x\n")
        ingest(spark, land, "utility_1", raw, ckpt)
        table.compact()
        assert sorted(r.k for r in table.read().collect()) == [str(i) for i in range(k + 1)]
    # a file that no committed batch names is no part of the table
    spark.read.parquet(raw).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/stray")
    stray = next(f for f in os.listdir(f"{tmp_dir}/stray") if f.endswith(".parquet"))
    os.link(f"{tmp_dir}/stray/{stray}", f"{raw}/{stray}")
    assert table.read().count() == 3 and table.files().count() == 1


# -- ledger -----------------------------------------------------------------------

RAW = "u1_install_der_raw"


def scanned(spark, raw, as_of=None):
    return P.freshness(read_raw_table(spark, raw), RAW, as_of or as_of_literal()).collect()


def test_ledger_equals_the_scan_after_every_run(spark, tmp_dir):
    land, raw, ckpt, book = (os.path.join(tmp_dir, p) for p in ("land", "raw", "ckpt", "book"))
    os.makedirs(land)
    for k in range(3):
        for name in (f"{k}a", f"{k}b"):
            with open(f"{land}/{name}.csv", "w") as f:
                f.write("ProjectID,x\n" + "".join(f"{name}{i},1\n" for i in range(k + 1)))
        ingest(spark, land, "utility_1", raw, ckpt)
        ledger = append_entries(spark, raw, book)
        assert P.freshness_of_ledger(ledger, RAW, as_of_literal()).collect() == scanned(spark, raw)
        n = ledger.count()
        assert append_entries(spark, raw, book).count() == n       # an entry that is repeated adds none
    # what a failed batch has left is in no log: neither the scan nor the ledger counts it
    spark.read.parquet(raw).coalesce(1).write.parquet(f"{tmp_dir}/stray")
    stray = next(f for f in os.listdir(f"{tmp_dir}/stray") if f.endswith(".parquet"))
    os.link(f"{tmp_dir}/stray/{stray}", f"{raw}/{stray}")
    ledger = append_entries(spark, raw, book)
    assert ledger.count() == n and ledger.agg(F.sum("n_rows")).first()[0] == 12
    plan = P.freshness_of_ledger(ledger, RAW, as_of_literal())._jdf.queryExecution().executedPlan().toString()
    assert "_ingestion_ts" in plan and "_source_file" not in plan and f"{raw}" not in plan


def test_only_new_files_are_scanned(spark, tmp_dir, monkeypatch):
    from gridlake.streaming import ledger as L
    monkeypatch.setattr(L, "SLACK_SECONDS", 0)
    raw, book = f"{tmp_dir}/raw", f"{tmp_dir}/book"
    one = spark.sql("SELECT 'f' AS _source_file, TIMESTAMP '2024-01-01 00:00:00' AS _ingestion_ts")
    one.coalesce(1).write.parquet(raw)
    assert append_entries(spark, raw, book).count() == 1
    old = next(f for f in os.listdir(raw) if f.endswith(".parquet"))
    with open(f"{raw}/{old}", "r+b") as f:                          # whoever opens it fails
        f.write(b"\0" * 200)
    os.utime(f"{raw}/{old}", (1_600_000_000, 1_600_000_000))
    one.selectExpr("'g' AS _source_file", "_ingestion_ts").coalesce(1).write.mode("append").parquet(raw)
    spark.catalog.refreshByPath(raw)
    with pytest.raises(Exception):
        spark.read.schema("_source_file string").parquet(raw).collect()
    ledger = append_entries(spark, raw, book)
    assert sorted(r.source_file for r in ledger.collect()) == ["f", "g"]


def test_ledger_of_an_empty_table(spark, tmp_dir):
    from gridlake.streaming.bronze import empty_raw
    empty_raw(spark, ["ProjectID"]).write.parquet(f"{tmp_dir}/raw")
    ledger = append_entries(spark, f"{tmp_dir}/raw", f"{tmp_dir}/book")
    row = P.freshness_of_ledger(ledger, RAW, as_of_literal()).first()
    assert (row.total_rows, row.source_file_count, row.last_ingestion_ts) == (0, 0, None)
    assert [row] == scanned(spark, f"{tmp_dir}/raw")
