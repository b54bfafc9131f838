"""Bronze from files as they arrive: each micro-batch reads its own headers.

The stream is one of file names (content is never loaded by it). A micro-batch
is a set of new files: their first lines are read in tasks, then their rows,
placed by header as in the batch reader, at the width that these files have. So
a file may land at any time, in any layout, while the stream runs; no header
table is made before, and no row waits in any state for its header.

Each micro-batch writes one folder, named by its number. A batch that fails is
repeated by Spark with the same number and files and replaces what it left, so
every row is in the table once.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridlake.session import scratch_path
from gridlake.sources.landing import align, header_summary, headers_of, read_data

BATCH_FOLDER = "_batch"


def _exact(path: str) -> str:
    """A listed path as a pattern that names this file alone."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def read_files(files: DataFrame, utility_id: str, environment: str = "dev",
               columns: Sequence[str] | None = None) -> DataFrame:
    """Raw rows of the CSV files named in ``files (path)``. The names of one
    micro-batch's files come to the driver, as for any scan of named files."""
    spark = files.sparkSession
    staged = scratch_path(spark, "arrived-headers")
    named = files.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"))
    headers_of(named).write.parquet(staged)              # first lines read once
    headers = spark.read.parquet(staged)
    width, names = header_summary(headers)
    paths = [_exact(r.file_path) for r in headers.select("file_path").collect()]
    rows = align(read_data(spark, paths, width), headers, width, list(columns) if columns is not None else names)
    return rows.select("*", F.current_timestamp().alias("_ingestion_ts"), F.lit(utility_id).alias("_utility_id"),
                       F.lit(environment).alias("_environment"))


def start_arrivals(spark: SparkSession, source_path: str, utility_id: str, table_path: str, checkpoint_path: str,
                   environment: str = "dev", columns: Sequence[str] | None = None,
                   max_files_per_trigger: int = 1000, available_now: bool = False) -> StreamingQuery:
    """Append every file under ``source_path``, now and later, to the parquet
    table at ``table_path``; with ``available_now`` those that are there, then
    stop. Files without a header line add no rows."""
    kind = "path string, modificationTime timestamp, length long, content binary"
    files = (spark.readStream.format("binaryFile").schema(kind).option("pathGlobFilter", "*.csv")
             .option("maxFilesPerTrigger", str(max_files_per_trigger)).load(source_path).select("path"))

    def append(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            rows = read_files(batch, utility_id, environment, columns)
            rows.write.mode("overwrite").parquet(f"{table_path.rstrip('/')}/{BATCH_FOLDER}={number}")

    writer = files.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint_path)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_arrivals(spark: SparkSession, table_path: str) -> DataFrame:
    """The rows of all batches, with the columns of any of them."""
    return spark.read.option("mergeSchema", "true").parquet(table_path).drop(BATCH_FOLDER)
