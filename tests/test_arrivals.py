"""Files that land while the stream runs; buckets that spare the shuffle."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from gridlake.plans import platinum as P
from gridlake.sources.store import write_bucketed
from gridlake.streaming import arrivals as A
from gridlake.streaming.arrivals import read_arrivals, start_arrivals


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}.tmp", "w") as f:
        f.write(text)
    os.rename(f"{folder}/.{name}.tmp", f"{folder}/{name}")


def test_files_land_between_micro_batches(spark, tmp_dir):
    land, table = f"{tmp_dir}/land", f"{tmp_dir}/table"
    put(land, "a.csv", 'k,v\n1,"a, quoted"\n2,  b\n')
    q = start_arrivals(spark, land, "utility_2", table, f"{tmp_dir}/ckpt", max_files_per_trigger=1)
    try:
        q.processAllAvailable()
        assert {r.k for r in read_arrivals(spark, table).collect()} == {"1", "2"}
        put(land, "b {1} 50%.csv", "w,v,k\nadded,c,3\n")           # other order, a new column, an odd name
        put(land, "c.csv", "k\n4\n")
        put(land, "empty.csv", "")
        q.processAllAvailable()
    finally:
        q.stop()
    assert q.exception() is None
    rows = {r.k: r for r in read_arrivals(spark, table).collect()}
    assert {k: (r.v, r.w) for k, r in rows.items()} == {
        "1": ("a, quoted", None), "2": ("  b", None), "3": ("c", "added"), "4": (None, None)}
    assert rows["3"]._source_file.endswith("b {1} 50%.csv") and rows["3"]._utility_id == "utility_2"
    assert rows["1"]._ingestion_ts < rows["3"]._ingestion_ts
    put(land, "d.csv", "v,k\nd,5\n")                               # the next run goes on where this one ended
    start_arrivals(spark, land, "utility_2", table, f"{tmp_dir}/ckpt", available_now=True).awaitTermination()
    assert sorted(r.k for r in read_arrivals(spark, table).collect()) == ["1", "2", "3", "4", "5"]


def test_a_batch_that_fails_is_repeated_whole(spark, tmp_dir, monkeypatch):
    land, table = f"{tmp_dir}/land", f"{tmp_dir}/table"
    for k in range(3):
        put(land, f"{k}.csv", f"k,v\n{k},x\n")
    read = A.read_files

    def broken(files, *args):
        rows = read(files, *args)
        rows.limit(1).write.mode("overwrite").parquet(f"{table}/{A.BATCH_FOLDER}=0")   # part of it is left
        raise OSError("an executor is away")
    with monkeypatch.context() as m:
        m.setattr(A, "read_files", broken)
        with pytest.raises(Exception, match="executor is away"):
            start_arrivals(spark, land, "utility_1", table, f"{tmp_dir}/ckpt", available_now=True).awaitTermination()
    put(land, "3.csv", "k,v\n3,x\n")
    start_arrivals(spark, land, "utility_1", table, f"{tmp_dir}/ckpt", available_now=True).awaitTermination()
    assert sorted(r.k for r in read_arrivals(spark, table).collect()) == ["0", "1", "2", "3"]


# -- buckets ------------------------------------------------------------------------

@pytest.fixture
def facts(spark):
    dim = spark.range(40).select(F.format_string("g%d", "id").alias("global_feeder_id"), F.format_string("f%d", "id").alias("feeder_id"),
                                 F.when(F.col("id") % 2 == 0, "u1").otherwise("u2").alias("utility_id"), F.lit(1.0).alias("voltage_kv"),
                                 F.lit(2.0).alias("max_hosting_capacity_mw"), F.lit(1.0).alias("min_hosting_capacity_mw"), F.lit(True).alias("has_hosting_capacity"))

    def fact(seed):
        k = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(60))
        k = F.when(F.col("id") % 3 == 0, 4).otherwise(k)            # one feeder has a third of all rows, some have none
        return spark.range(3000).select(
            F.when(k % 2 == 0, "u1").otherwise("u2").alias("utility_id"), F.when(k < 55, F.format_string("f%d", k)).alias("feeder_id"),
            F.when(F.col("id") % 7 > 0, F.element_at(F.array(F.lit("solar"), F.lit("wind")), (F.col("id") % 2 + 1).cast("int"))).alias("der_type"),
            F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 501 == 0, 1e25).otherwise(F.col("id") / 7).alias("nameplate_rating_kw"))
    return dim, fact(1), fact(2)


def rounded(df):
    return sorted(tuple(x if not isinstance(x, float) else float(f"{x:.12g}") for x in r) for r in df.collect())


def test_map_summary_of_buckets_moves_no_row(spark, tmp_dir, facts):
    dim, installed, planned = facts
    db = f"b{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_dir}/db'")
    stored = write_bucketed(dim, f"{db}.dim_feeder", f"{tmp_dir}/dim", P.FEEDER_KEYS, 4)
    for k in range(3):                                              # rollups of three appends add up
        part = F.col("nameplate_rating_kw").isNull() if k == 2 else F.coalesce(F.floor("nameplate_rating_kw") % 2 == k, F.lit(False))
        rollup = write_bucketed(P.der_rollup(installed.filter(part), planned.filter(part)), f"{db}.der_rollup", f"{tmp_dir}/rollup",
                                P.FEEDER_KEYS, 4, mode="append")
    got = P.v_feeder_map_of_rollup(stored, rollup)
    assert rounded(got) == rounded(P.v_feeder_map_summary(dim, installed, planned))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan, plan
    # a hot feeder is no longer in the rollup than any other
    assert rollup.groupBy("feeder_id").count().agg(F.max("count")).first()[0] <= 3 * 4
