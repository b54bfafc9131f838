"""Text columns that break ties go through the sorts and the shuffle packed."""

import random
import re

from pyspark.sql import functions as F

from gridlake.operators import latest_per_key
from gridlake.operators.cleanse import _text_runs
from gridlake.sources.derived import raw_frame

from .conftest import SF_SMALL

COLUMNS = [f"c{i:02d}" for i in range(11)]
VALUES = [None, "", " ", "a", "ab", "\x00", "\x01", "\x02", "\x00\x02", "\x01\x03", "\x01\x02", "a\x00", "a\x01b", "é", "x" * 254, "x" * 255, "x" * 300]


def _rank(row) -> tuple:
    return tuple((0,) if v is None else (1, v.encode() if isinstance(v, str) else v) for v in row)


def test_packed_ties_are_those_of_the_columns(spark):
    r = random.Random(5)
    rows = [(r.choice(["k1", "k2", None, *(f"u{i}" for i in range(60))]), r.choice([1, 2, None]),
             *[r.choice(VALUES) if r.random() < .5 else "z" for _ in COLUMNS]) for _ in range(3000)]
    best = {}
    for row in rows:
        if row[0] not in best or _rank(row[1:]) > _rank(best[row[0]][1:]):
            best[row[0]] = row
    df = spark.createDataFrame(rows, "key string, _ingestion_ts int, " + ", ".join(f"{c} string" for c in COLUMNS))
    out = latest_per_key(df, "key")
    assert out.schema == df.schema
    assert sorted(map(tuple, out.collect()), key=_rank) == sorted(best.values(), key=_rank)
    kept = latest_per_key(df, "key", keep_null_keys=True)
    assert kept.schema == df.schema
    assert kept.filter("key is null").count() == sum(row[0] is None for row in rows)


def test_bytes_that_are_no_text_come_back(spark):
    df = spark.range(3).select("id", F.lit(1).alias("_ingestion_ts"), *[F.expr("CAST(X'C30041E2' AS STRING)").alias(c) for c in COLUMNS])
    out = latest_per_key(df, "id").select([F.hex(c).alias(c) for c in COLUMNS]).distinct().collect()
    assert [set(x) for x in out] == [{"C30041E2"}]


def test_only_text_columns_in_a_row_are_packed(spark):
    df = spark.createDataFrame([], "a string, b string, n int, c string, d string COLLATE UNICODE")
    assert _text_runs(df, df.columns) == [["a", "b"], ["n"], ["c"], ["d"]]


def test_a_shuffled_row_holds_little_beside_its_text(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("key"), F.lit(1).alias("_ingestion_ts"),
                                  *[F.concat(F.lit("v"), F.col("id") % 10).alias(c) for c in COLUMNS])
    out = latest_per_key(df, "key")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan()

    def sizes(node):
        kids = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in node.getClass().getSimpleName() else [
            node.children().apply(i) for i in range(node.children().size())]
        own = [int(node.metrics().get("dataSize").get().value())] if node.nodeName() == "Exchange" else []
        return own + [x for k in kids for x in sizes(k)]
    # eleven text columns take 176 bytes and more if each has its own place
    assert 0 < max(sizes(plan)) < 2000 * 150


def test_dimension_columns_are_made_before_the_join(spark):
    plan = raw_frame(spark, SF_SMALL, "u1_circuits_raw")._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join ")
    for name in ("NYHCPV_csv_FMAXHC", "NYHCPV_csv_FMINHC", "NYHCPV_csv_FVOLTAGE", "NYHCPV_csv_FHCADATE"):
        assert not re.search(rf"AS {name}#", plan[:join]) and re.search(rf"AS {name}#", plan[join:]), name
    assert re.search(r"AS NYHCPV_csv_FFEEDER#", plan[:join])       # the line's number is in it
