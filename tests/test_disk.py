"""What a refresh holds on disk: drops go when Bronze has their rows, shuffle
and staged files when they have been read, and no row is stored twice over."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from gridlake.plans import medallion
from gridlake.plans.refresh import refresh
from gridlake.registry import SPECS
from gridlake.session import SHUFFLE_CLEANUP, checkpoint_root, scratch, shuffles_dropped
from gridlake.sources import store
from gridlake.sources.landing import read_landing, write_landing
from gridlake.streaming.bronze import landing_path

S = next(x for x in SPECS if x.raw_table == "u2_install_der_raw")


def drop(spark, landing, ids):
    rows = spark.createDataFrame([(i, "Solar", "1.5", "24", "", None) for i in ids],
                                 "DER_ID string, DER_TYPE string, DER_NAMEPLATE_RATING string, DER_INTERCONNECTION_LOCATION string, "
                                 "SERVICE_STREET_ADDRESS string, INTERCONNECTION_COST string")
    write_landing(rows, landing_path(landing, S.utility_id, S.dataset), files=1, quote_all=False)


def landed(landing):
    return sorted(glob.glob(os.path.join(landing_path(landing, S.utility_id, S.dataset), "*.csv")))


def shuffle_files(spark):
    held = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (held.apply(i).getName() for i in range(held.size())) if f.startswith("shuffle_")}


def staged(spark):
    return set(glob.glob(os.path.join(checkpoint_root(spark).removeprefix("file:"), "unclustered-*")))


class Stopped(Exception):
    pass


def ingested(spark, landing, model, then=lambda name: None, **options):
    """A run that ends when Bronze is stored; its rows' keys."""
    names = []

    def on_table(name):
        names.append(name)
        then(name)
        if len(names) == len(SPECS):
            raise Stopped
    with pytest.raises(Stopped):
        refresh(spark, landing, model, register=False, on_table=on_table, **options)
    return sorted(r.DER_ID for r in spark.read.parquet(f"{model}/bronze/{S.raw_table}").collect())


def test_consumed_drops_go_and_later_ones_are_ingested(spark, tmp_dir):
    landing, model = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "model")
    drop(spark, landing, ["a", "b", "c"])
    for name, rows in (("p r%20t.csv", "d,Wind\n"), ("empty.csv", "")):     # any file name; a file without rows
        with open(os.path.join(landing_path(landing, S.utility_id, S.dataset), name), "w") as f:
            f.write("DER_ID,DER_TYPE\n" + rows)
    before = landed(landing)
    assert ingested(spark, landing, model) == ["a", "b", "c", "d"]
    assert landed(landing) == before                          # drops stay unless they are the model's own
    drop(spark, landing, ["e"])
    assert ingested(spark, landing, model, consume=True) == ["a", "b", "c", "d", "e"]
    assert [os.path.basename(f) for f in landed(landing)] == ["empty.csv"]
    assert ingested(spark, landing, model, consume=True) == ["a", "b", "c", "d", "e"]     # nothing has landed since
    drop(spark, landing, ["f"])
    assert ingested(spark, landing, model, consume=True) == ["a", "b", "c", "d", "e", "f"]
    assert len(landed(landing)) == 1


def test_consumption_leaves_what_bronze_does_not_hold(spark, tmp_dir):
    """A file written again since its rows were stored, and one that lands
    when the dataset has been ingested."""
    landing, model = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "model")
    place = landing_path(landing, S.utility_id, S.dataset)
    drop(spark, landing, ["a", "b"])
    again, = landed(landing)
    ingested(spark, landing, model)
    os.utime(again, (time.time() + 3600,) * 2)
    late = os.path.join(place, "late.csv")

    def land(name):
        if name == f"bronze.{S.raw_table}":
            with open(late, "w") as f:
                f.write("DER_ID\nc\n")
    assert ingested(spark, landing, model, land, consume=True) == ["a", "b"]
    assert landed(landing) == sorted([again, late])
    assert ingested(spark, landing, model, consume=True) == ["a", "b", "c"]
    assert landed(landing) == [again]


def test_shuffle_files_go_with_their_query(spark, tmp_dir):
    df = spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).agg(F.count("*").alias("n")).repartitionByRange(3, "k")
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    held = shuffle_files(spark)
    with shuffles_dropped(spark):
        for k in range(3):
            df.write.parquet(os.path.join(tmp_dir, str(k)))
        until = time.time() + 30                              # executors are told in the background
        while shuffle_files(spark) - held and time.time() < until:
            time.sleep(0.2)
        assert not shuffle_files(spark) - held
        assert df.count() == df.count() == 5000               # rows are there for a second action too
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    with pytest.raises(KeyError), shuffles_dropped(spark):
        raise KeyError
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before


def test_staged_rows_go_when_they_are_ordered(spark, tmp_dir):
    df = spark.range(500).select("id", (F.col("id") % 7).cast("string").alias("v"))
    before = staged(spark)
    store.write_clustered(df, os.path.join(tmp_dir, "c"), ["v"], tiebreak=["id"])
    store.write_zordered(df, os.path.join(tmp_dir, "z"), ["v"], files=2, tiebreak=["id"])
    store.write_hashed(df, os.path.join(tmp_dir, "h"), "v", folders=2, tiebreak=["id"])
    assert staged(spark) == before
    for kind in "czh":
        assert spark.read.parquet(os.path.join(tmp_dir, kind)).count() == 500
    with pytest.raises(KeyError), scratch(spark, "unclustered") as path:
        df.write.parquet(path)
        raise KeyError
    assert staged(spark) == before


def test_silver_is_not_shuffled_a_second_time(spark, tmp_dir, monkeypatch):
    balanced = []
    monkeypatch.setattr(medallion, "write_balanced", lambda df, path: balanced.append(path) or df.write.parquet(path))
    df = spark.range(10)
    for name in (S.silver_table, "fact_installed_der"):
        assert medallion.store_table(spark, df, os.path.join(tmp_dir, name), name).count() == 10
    assert [os.path.basename(p) for p in balanced] == ["fact_installed_der"]


def test_drops_are_quoted_where_they_must_be(spark, tmp_dir):
    odd = [None, "", " a ", 'q"x', '"', '""', "a,b", "\ttab", "#c", "'", "\\", "\\\"", "é", "007"]
    rows = [(a, b, "x") for a in odd for b in odd]
    df = spark.createDataFrame(rows, "`a b` string, `c,d` string, e string")
    sizes = []
    for quote_all in (True, False):
        path = os.path.join(tmp_dir, str(quote_all))
        write_landing(df, path, files=2, quote_all=quote_all)
        got = sorted(map(repr, ((r[0], r[1], r[2]) for r in read_landing(spark, path, "utility_1", columns=df.columns).collect())))
        assert got == sorted(repr((a or None, b or None, e)) for a, b, e in rows)
        sizes.append(store.stored_bytes(spark, path))
    assert sizes[1] < sizes[0]
    one = spark.createDataFrame([(None,), ("",), (" ",), ("a",)], "v string")
    write_landing(one, os.path.join(tmp_dir, "one"), quote_all=False)
    assert read_landing(spark, os.path.join(tmp_dir, "one"), "utility_1", columns=["v"]).count() == 4


@pytest.mark.parametrize("name", ["refresh_failed_run", "refresh_tables"])
def test_query_keeps_no_landed_rows(spark, monkeypatch, name):
    import __spark_entry__ as E
    homes, real = [], E.scratch_path
    monkeypatch.setattr(E, "scratch_path", lambda spark, kind: homes.append(real(spark, kind)) or homes[-1])
    got = E.queries()[name](spark, "/root/testdata/sf0.001").collect()
    landing = next(h for h in homes if "/landing-" in h).removeprefix("file:")
    assert sum(r.n_rows for r in got) > 0
    left = glob.glob(os.path.join(landing, "*", "*", "*.csv"))
    assert all(len(open(f).readlines()) == 1 for f in left), left      # nothing but headers
