"""Compaction of a raw table that many small appends have filled.

The raw folder itself is never touched (a stream writes to it and its log names
its files). Beside it, under ``root``, stand folders of packed files and a
manifest of the files that are in force: raw files as they are, and packed ones
in place of those that they hold. A compaction packs files of under half the
target by running sums of their sizes, so each packed file has between half and
twice the target (only the last of too little data has less); it writes all of
them in one job, then publishes the new manifest by a rename. One that fails
before changes nothing, and one with nothing to pack writes nothing.

Names of files come to the driver, which holds them for each scan anyway; sizes
and groups are worked out by Spark from the footers, each of which is read once
in the table's life.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlake.session import scratch_path
from gridlake.sources.footers import footers, listing
from gridlake.sources.landing import _listed
from gridlake.sources.pointer import current_run, publish
from gridlake.sources.store import TARGET_FILE_BYTES

MANIFEST = ("file string, modified timestamp, n_rows long, data_bytes long, "
            "own boolean, packed boolean, replaced boolean")

#: Files whose running sums one task works out, about.
CELL_FILES = 2000


class CompactedTable:
    """The rows of the parquet table at ``source`` (one folder, without
    partition folders), in files of about ``target_bytes`` as far as
    ``compact`` has been run since they came."""

    def __init__(self, spark: SparkSession, source: str, root: str, target_bytes: int = TARGET_FILE_BYTES):
        self.spark, self.source, self.root, self.target = spark, source.rstrip("/"), root.rstrip("/"), target_bytes

    def _manifest(self) -> DataFrame:
        """Every raw file seen so far, and the packed files in force."""
        version = current_run(self.spark, self.root)
        if version is None:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/versions/{version}")

    def _known(self) -> DataFrame:
        """The manifest, with raw files that have come since."""
        known = self._manifest()
        new = footers(listing(self.spark, self.source).join(known, "file", "left_anti"))
        flags = {"own": F.lit(False), "packed": F.lit(False), "replaced": F.lit(False)}
        path = scratch_path(self.spark, "manifest")
        known.unionByName(new.drop("columns").withColumns(flags)).write.parquet(path)
        return self.spark.read.schema(MANIFEST).parquet(path)

    def files(self) -> DataFrame:
        """The files in force, those without rows left out."""
        return self._known().filter("NOT replaced AND n_rows > 0")

    def _groups(self, live: DataFrame) -> DataFrame:
        """(file, group) of the files to pack, two or more of each group. They
        keep the order in which they came, so packed files stay apart in time.
        Running sums are over cells first (an hour and a hash of the name),
        then inside each."""
        small = live.filter((F.col("data_bytes") * 2 < self.target) & ~F.col("packed"))
        busiest = small.groupBy(F.date_trunc("hour", "modified").alias("hour")).count().agg(F.max("count")).first()[0] or 0
        cell = F.struct(F.date_trunc("hour", "modified").alias("hour"),
                        F.pmod(F.xxhash64("file"), F.lit(busiest // CELL_FILES + 1)).alias("part"))
        small = small.withColumn("cell", cell)
        cells = small.groupBy("cell").agg(F.sum("data_bytes").alias("size"))
        earlier = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.select("cell", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
        inside = Window.partitionBy("cell").orderBy("modified", "file").rowsBetween(Window.unboundedPreceding, -1)
        start = F.col("before") + F.coalesce(F.sum("data_bytes").over(inside), F.lit(0))
        placed = small.join(cells, "cell").select("file", "data_bytes", F.floor(start / self.target).cast("int").alias("group"))
        total = placed.groupBy("group").agg(F.sum("data_bytes").alias("size"))
        last = total.orderBy(F.desc("group")).limit(1).first()
        if last and last.group > 0 and 2 * last["size"] < self.target:      # too little for a file of its own
            placed = placed.withColumn("group", F.least("group", F.lit(last.group - 1)))
        several = placed.groupBy("group").count().filter("count > 1").select("group")
        return placed.join(several, "group").select("file", "group")

    def _rows(self, files: Sequence[str]) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(*files)

    def compact(self) -> int:
        """Pack what is worth packing; returns the number of files replaced."""
        known = self._known()
        path = scratch_path(self.spark, "groups")
        self._groups(known.filter("NOT replaced AND n_rows > 0")).write.parquet(path)
        groups = self.spark.read.parquet(path)
        names = [r.file for r in groups.select("file").collect()]
        if not names:
            return 0
        n = groups.agg(F.max("group")).first()[0] + 1
        part = f"{self.root}/parts/{uuid.uuid4().hex}"
        rows = self._rows(names).withColumn("_packed_from", _listed(F.col("_metadata.file_path")))
        grouped = rows.join(groups.select(F.col("file").alias("_packed_from"), F.col("group").alias("_pack")), "_packed_from")
        grouped.drop("_packed_from").repartitionById(n, F.col("_pack")).drop("_pack").write.parquet(part)
        made = footers(listing(self.spark, part)).filter("n_rows > 0").drop("columns")
        # a packed file counts as done by the bytes that went into it: merging makes dictionaries better, not rows fewer
        enough = known.join(groups, "file").agg(F.sum("data_bytes")).first()[0] * 2 >= self.target
        made = made.withColumns({"own": F.lit(True), "packed": F.lit(bool(enough)), "replaced": F.lit(False)})
        gone = known.join(groups.select("file", F.lit(True).alias("_gone")), "file", "left")
        kept = gone.withColumn("replaced", F.col("replaced") | F.coalesce("_gone", F.lit(False))).drop("_gone").filter("NOT (own AND replaced)")
        version = uuid.uuid4().hex
        kept.unionByName(made).write.parquet(f"{self.root}/versions/{version}")
        publish(self.spark, self.root, version)
        return len(names)

    def read(self) -> DataFrame:
        """All rows of the table, from the files in force, with the columns of
        any of them."""
        names = [r.file for r in self.files().select("file").collect()]
        if not names:
            return self._rows([self.source])
        return self._rows(names)

