"""Table sinks: balanced writes, and clustered writes for data skipping.

``write_clustered`` range-partitions on the lookup columns and sorts within
each partition, so every parquet file (and row group) covers a disjoint
min/max range of those columns; a pushed-down predicate on them then skips
whole files and row groups. For a two-column key the lexicographic range
order serves equality on the first column plus range/equality on the
second. ``write_zordered`` orders by a space-filling curve over the columns'
quantile ranks instead, so that a predicate on any one of them skips files.
``write_hashed`` deals rows into folders by hash, so that ``rows_of`` finds the
rows of many values at once and reads only the folders they are in.
``write_balanced`` lets AQE split skewed and merge tiny partitions so output
files come out even-sized.

The number of files follows from measured bytes: a clustered write stores its
rows once as they come, looks up what they take, and orders the stored copy.
The copy also serves the sampling of the range bounds, which would else run
the whole plan a second time; it is removed when the rows have been ordered.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gridlake.session import scratch, scratch_path

TARGET_FILE_BYTES = 128 << 20
#: Rows of one task's sort, in memory.
SORT_BYTES = 256 << 20


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path`` (a listing, no job)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength())


#: Files whose footers tell how large a table's row groups are.
FOOTERS = 16


def row_group_bytes(spark: SparkSession, files: Sequence[str]) -> int:
    """Average bytes of the row groups of some of the parquet files (their
    footers are read, no job): what a scan cannot split."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    size = groups = 0
    for name in sorted(files)[::max(1, -(-len(files) // FOOTERS))]:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
        try:
            groups += reader.getRowGroups().size()
        finally:
            reader.close()
        size += path.getFileSystem(conf).getFileStatus(path).getLen()
    return size // max(1, groups)


def text_bytes(df: DataFrame) -> int:
    """Bytes that the rows of ``df`` take as quoted text (one aggregate)."""
    one = F.octet_length(F.concat_ws(",", *[F.col(f"`{c}`").cast("string") for c in df.columns])) + 2 * len(df.columns) + 1
    return int(df.agg(F.sum(one.cast("long"))).first()[0] or 0)


def files_for(n_bytes: int, target_bytes: int = TARGET_FILE_BYTES) -> int:
    return max(1, math.ceil(n_bytes / target_bytes))


def write_balanced(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.hint("rebalance").write.mode(mode).parquet(path)


def row_bytes(df: DataFrame) -> Column:
    """What a row of ``df`` takes in a sort's memory, about."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields if f.dataType == StringType()]
    return reduce(lambda a, b: a + b, texts, F.lit(16 * (len(df.columns) + 2))).cast("long")


def _staged(df: DataFrame, files: int | None, path: str | None = None) -> tuple[DataFrame, int]:
    """The rows stored at ``path``, and the number of files to order them in: by
    stored bytes, and by their bytes in memory (counted during the write), as
    each file is one task's sort and well-compressed rows are many."""
    path, seen = path or scratch_path(df.sparkSession, "unclustered"), Observation()
    df.observe(seen, F.sum(row_bytes(df)).alias("n")).write.parquet(path)
    files = files or max(files_for(stored_bytes(df.sparkSession, path)), files_for(seen.get["n"] or 0, SORT_BYTES))
    return df.sparkSession.read.schema(df.schema).parquet(path), files


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None,
                    mode: str = "overwrite", tiebreak: Sequence[str] = ()) -> None:
    """Range-cluster on ``columns``. ``tiebreak`` (a unique column) is
    appended to the range key: when one value holds a large share of the
    rows, the sampled range bounds can then cut inside that value, so it is
    spread over several files instead of one oversized task and file."""
    key = [*columns, *tiebreak]
    with scratch(df.sparkSession, "unclustered") as staged:
        rows, n = _staged(df, files, staged)
        rows.repartitionByRange(n, *key).sortWithinPartitions(*key).write.mode(mode).parquet(path)


# -- space-filling curve ------------------------------------------------------

#: Ranks of a column have this many bits.
RANK_BITS = 6
#: Rows whose values bound the ranks of all columns (chosen by hash), at most.
RANK_SAMPLE = 8192


def rank_bounds(sample: DataFrame, column: str) -> list:
    """``2**RANK_BITS - 1`` ascending values that cut the sampled rows into
    parts of equal size; a frequent value is several of them, so that the
    ranks of few values are far apart."""
    got = sorted(r[0] for r in sample.select(column).collect() if r[0] is not None)
    parts = 1 << RANK_BITS
    return [got[k * len(got) // parts] for k in range(1, parts)] if got else []


def curve_key(ranks: Sequence[Column]) -> Column:
    """The ranks' bits interleaved, the highest first."""
    bits = [F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1)), b * len(ranks) + len(ranks) - 1 - i)
            for b in range(RANK_BITS) for i, r in enumerate(ranks)]
    return reduce(lambda x, y: x.bitwiseOR(y), bits)


def write_zordered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None,
                   mode: str = "overwrite", tiebreak: Sequence[str] = ()) -> None:
    """Order by a Z-curve over the columns' quantile ranks: each file covers a
    small box in all of them, whatever the values' distribution. Only the
    bounds come from a sample (``RANK_SAMPLE`` rows by hash); every row is
    ranked. NULL has rank 0. A value with a large share of the rows is one
    rank, inside which ``tiebreak`` spreads rows over files."""
    with scratch(df.sparkSession, "unclustered") as staged:
        rows, n = _staged(df, files, staged)
        sample = rows.select(*columns).orderBy(F.xxhash64(*rows.columns)).limit(RANK_SAMPLE)

        def rank(column: str) -> Column:
            bounds = rank_bounds(sample, column)
            kind = rows.schema[column].dataType
            held = F.array(*[F.lit(x).cast(kind) for x in bounds]) if bounds else F.array().cast(f"array<{kind.simpleString()}>")
            return F.when(F.col(column).isNull(), 0).otherwise(F.size(F.filter(held, lambda x: x <= F.col(column)))).cast("long")

        keyed = rows.withColumn("_curve", curve_key([rank(c) for c in columns]))
        order = ["_curve", *tiebreak]
        keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_curve").write.mode(mode).parquet(path)


# -- lookups by a table of values ----------------------------------------------

#: A table's folders are named by their number: ``_hash_of_<folders>=<folder>``.
HASH_FOLDER = "_hash_of_"
#: Folders at most; a larger table has several files in each.
MOST_FOLDERS = 4096


def _folder(column: str, folders: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(folders)).cast("int")


def write_hashed(df: DataFrame, path: str, column: str, folders: int | None = None, tiebreak: Sequence[str] = ()) -> None:
    """Deals rows into folders by a hash of ``column`` and sorts them by it in
    each, for ``rows_of``. Files are cut by range inside the folders, with
    ``tiebreak`` inside a value, so that a hot value is spread over files. The
    number of folders follows from the stored bytes unless given."""
    with scratch(df.sparkSession, "unclustered") as staged:
        rows, files = _staged(df, None, staged)
        folders = folders or min(files, MOST_FOLDERS)
        part = f"{HASH_FOLDER}{folders}"
        key = [part, column, *tiebreak]
        dealt = rows.withColumn(part, _folder(column, folders)).repartitionByRange(max(files, folders), *key)
        dealt.sortWithinPartitions(*key).write.partitionBy(part).parquet(path)


def rows_of(stored: DataFrame, requested: DataFrame, column: str) -> DataFrame:
    """The rows of a table of ``write_hashed`` whose ``column`` is one of the
    values in ``requested``, each once however often it is requested; NULL is
    no value. Only the folders that the values fall in are read, and in them
    only the row groups between the smallest and largest value; no more than
    the folders' numbers and those two come to the driver."""
    part = next(c for c in stored.columns if c.startswith(HASH_FOLDER))
    path = scratch_path(stored.sparkSession, "requested")
    requested.select(column).filter(F.col(column).isNotNull()).distinct().write.parquet(path)
    wanted = stored.sparkSession.read.parquet(path)
    span = wanted.agg(F.collect_set(_folder(column, int(part.removeprefix(HASH_FOLDER)))).alias("folders"),
                      F.min(column).alias("low"), F.max(column).alias("high")).first()
    near = stored.filter(F.col(part).isin(span.folders) & F.col(column).between(F.lit(span.low), F.lit(span.high)))
    return near.join(wanted, column, "left_semi").select(*[c for c in stored.columns if c != part])


def files_to_read(stored: DataFrame, column: str) -> DataFrame:
    """(value, n_rows, files_to_read, files) for each value of ``column`` of a
    stored table: the files whose smallest and largest value do not rule the
    value out, which is what a reader of the footers has to open."""
    spans = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    spans = [r for r in spans.select("low", "high").collect()]      # one row per file
    kind = stored.schema[column].dataType
    held = F.array(*[F.struct(F.lit(r.low).cast(kind).alias("low"), F.lit(r.high).cast(kind).alias("high")) for r in spans])
    values = stored.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_rows"))
    return values.select("value", "n_rows", F.size(F.filter(held, lambda x: (x["low"] <= F.col("value")) & (F.col("value") <= x["high"]))).alias("files_to_read"),
                         F.lit(len(spans)).alias("files"))


# -- buckets: joins and aggregates by their key without a shuffle ----------------

def write_bucketed(df: DataFrame, table: str, path: str, columns: Sequence[str], buckets: int,
                   mode: str = "errorifexists") -> DataFrame:
    """Store ``df`` at ``path`` in ``buckets`` files by a hash of ``columns``,
    sorted by them, as the catalog's ``table`` (which holds the buckets), and
    return the stored table. Tables of equal buckets are joined, and each is
    grouped, by these columns without a shuffle. The rows meet in one shuffle
    here, so that a task writes its bucket and no other. ``mode="append"`` adds
    files to each bucket. One key's rows are one bucket: reduce them first
    (``platinum.der_rollup``) where a key may hold a large share."""
    spread = df.repartition(buckets, *columns)
    spread.write.format("parquet").bucketBy(buckets, *columns).sortBy(*columns).option("path", path).mode(mode).saveAsTable(table)
    return df.sparkSession.table(table)


# Clustering of the serving tables: (lookup columns, unique tie-break).
CLUSTER_BY = {
    "v_feeders_by_hc": (("max_hosting_capacity_mw",), ("global_feeder_id",)),
    "v_der_by_feeder": (("feeder_id",), ("der_id",)),
}

# Serving tables that are looked up by either of two columns.
ZORDER_BY = {"v_feeder_map_summary": (("utility_id", "feeder_id"), ("global_feeder_id",))}
