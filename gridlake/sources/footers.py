"""What the footers of a table's parquet files say: one row per file.

The listing is Spark's (it honours a streaming sink's log of committed files),
and no content is loaded by it; each footer is read once, in a task. Contract
drift and compaction work on these rows, however large the files are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.operators.quality import _SPARK_TYPE
from gridlake.sources.landing import located

FOOTER = ("file string, modified timestamp, n_rows long, data_bytes long, "
          "columns array<struct<name: string, type: string>>")


def listing(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, modified) of every parquet file of a stored table."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path if isinstance(path, str) else list(path))
    return files.select(F.regexp_replace("path", "^file:/+", "file:/").alias("file"), F.col("modificationTime").alias("modified"))


def _footer(uri: str) -> tuple[int, int, list[dict]]:
    """(rows, bytes of the column chunks, columns with their Spark types)."""
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type
    fs, path = located(uri)
    with fs.open_input_file(path) as f:
        parquet = pq.ParquetFile(f)
        meta = parquet.metadata
        size = sum(meta.row_group(g).column(c).total_compressed_size
                   for g in range(meta.num_row_groups) for c in range(meta.num_columns))
        columns = [{"name": c.name, "type": from_arrow_type(c.type).simpleString()} for c in parquet.schema_arrow]
        return meta.num_rows, size, columns


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for files in batches:
        rows = [_footer(f) for f in files["file"]]
        yield files.assign(n_rows=[r[0] for r in rows], data_bytes=[r[1] for r in rows], columns=[r[2] for r in rows])


def footers(files: DataFrame) -> DataFrame:
    """The footers of the files of a ``listing``. ``data_bytes`` leaves out the
    footer itself, which outweighs the data of a very small file."""
    import sys

    from pyspark import cloudpickle

    from gridlake.sources import landing
    for module in (sys.modules[__name__], landing):     # workers need not have this package
        cloudpickle.register_pickle_by_value(module)
    return files.select("file", "modified").mapInPandas(_read, FOOTER)


def contract_drift(spark: SparkSession, path: str | Sequence[str], contract: Sequence[tuple], table: str,
                   root: str | None = None) -> DataFrame:
    """Where the stored files of a table depart from its contract, file by
    file: table_name, folder (of the file, below ``root``), file, column_name,
    violation (``missing_column``, ``type_mismatch`` or ``unknown_column``),
    expected, actual, n_rows.

    A reader of the whole table sees one merged schema, in which a column that
    some files lack is there and full of NULL; here each file stands for
    itself. A file without rows is reported as any other."""
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_SPARK_TYPE.get(kind, kind)).alias("type"))
                       for name, kind, _nullable in contract])
    files = footers(listing(spark, path)).withColumns({
        "expected": F.map_from_entries(wanted), "actual": F.map_from_entries("columns")})
    names = F.array_union(F.map_keys("expected"), F.map_keys("actual"))
    each = files.select("file", "n_rows", "expected", "actual", F.explode(names).alias("column_name"))
    each = each.withColumns({"expected": F.col("expected")[F.col("column_name")], "actual": F.col("actual")[F.col("column_name")]})
    violation = (F.when(F.col("actual").isNull(), "missing_column").when(F.col("expected").isNull(), "unknown_column")
                 .when(F.col("actual") != F.col("expected"), "type_mismatch"))
    depth = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root or path).depth()
    # without scheme and authority, the empty part before the first slash and the root's own
    parts = F.split(F.regexp_replace("file", "^[a-z0-9]+:(//[^/]+)?", ""), "/")
    folder = F.array_join(F.slice(parts, depth + 2, F.greatest(F.size(parts) - depth - 2, F.lit(0))), "/")
    return each.withColumn("violation", violation).filter("violation IS NOT NULL").select(
        F.lit(table).alias("table_name"), folder.alias("folder"), "file", "column_name", "violation", "expected", "actual", "n_rows")
