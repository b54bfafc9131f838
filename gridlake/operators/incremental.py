"""Latest row per key, kept up to date drop by drop.

The state is a set of stored runs, each with one row per key it holds. A drop
becomes a run of level 0: only the drop is read for it. As soon as ``fanout``
runs have one level, they are merged into one of the next level, so a row is
read again only as often as the state's size has multiplied by ``fanout``, and
a drop costs its own rows times the number of levels on average, however large
the state is. Picking the latest row is associative (ties are broken by all
columns), so the runs together give what one pass over all drops gives.

What the runs are is one small table per version, published by a rename: a
merge that fails leaves the state as it was.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridlake.operators.cleanse import latest_per_key
from gridlake.sources.pointer import current_run, publish

MANIFEST = "run string, level int, n_rows long"


@dataclass(frozen=True)
class Run:
    run: str
    level: int
    n_rows: int


class LatestState:
    """The latest row of each key of all drops merged so far, under ``root``."""

    def __init__(self, spark: SparkSession, root: str, key: str | Sequence[str], order: str = "_ingestion_ts",
                 keep_null_keys: bool = False, fanout: int = 4):
        if fanout < 2:
            raise ValueError("runs cannot be merged one by one")
        self.spark, self.root, self.fanout = spark, root.rstrip("/"), fanout
        self.rule = {"key": key, "order": order, "keep_null_keys": keep_null_keys}

    def runs(self) -> list[Run]:
        """The runs of the published version (some ``fanout`` per level)."""
        version = current_run(self.spark, self.root)
        if version is None:
            return []
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/versions/{version}").collect()
        return sorted((Run(*r) for r in rows), key=lambda r: (r.level, r.run))

    def _rows(self, runs: Sequence[Run]) -> DataFrame:
        frames = [self.spark.read.parquet(f"{self.root}/runs/{r.run}") for r in runs]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def _write(self, rows: DataFrame, level: int) -> tuple[Run, int]:
        """A new run with the latest of the rows, and the number of rows read,
        as the tasks have counted them."""
        read, kept, name = Observation(), Observation(), uuid.uuid4().hex
        out = latest_per_key(rows.observe(read, F.count(F.lit(1)).alias("n")), **self.rule)
        out.observe(kept, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.root}/runs/{name}")
        return Run(name, level, kept.get["n"]), read.get["n"]

    def merge(self, drop: DataFrame) -> int:
        """Take in the rows of a drop; returns how many rows were read for it,
        the drop's own included. A drop that is merged again changes nothing
        (but for rows without a key, if these are all kept)."""
        first, read = self._write(drop, 0)
        levels = defaultdict(list)
        for r in [*self.runs(), first]:
            levels[r.level].append(r)
        level = 0
        while len(levels[level]) >= self.fanout:
            merged, n = self._write(self._rows(levels.pop(level)), level + 1)
            levels[level + 1].append(merged)
            level, read = level + 1, read + n
        version = uuid.uuid4().hex
        now = [(r.run, r.level, r.n_rows) for runs in levels.values() for r in runs]
        self.spark.createDataFrame(now, MANIFEST).coalesce(1).write.parquet(f"{self.root}/versions/{version}")
        publish(self.spark, self.root, version)
        return read

    def latest(self) -> DataFrame:
        """One row per key, as ``latest_per_key`` over all drops at once."""
        runs = self.runs()
        if not runs:
            raise FileNotFoundError(f"no drop has been merged under {self.root}")
        return latest_per_key(self._rows(runs), **self.rule) if len(runs) > 1 else self._rows(runs)
