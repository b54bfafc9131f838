"""Session helpers: a local session for tests/bench, and the shared scratch
folder (``spark.checkpoint.dir``) for materialised intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "gridlake") -> SparkSession:
    """A local[N] session configured the way the library expects: AQE on,
    UTC session clock, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", str(JIT_METHOD_BYTES))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("GRIDLAKE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Text dates are parsed in the session time zone; the library's
    contract is UTC wall-clock."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


#: Bytecodes of a method above which the JVM's compiler leaves it to the interpreter.
JIT_METHOD_BYTES = 8000


def ensure_compiled(spark: SparkSession) -> None:
    """Spark generates one method for a stage's projections, up to 64 KB of
    bytecode, but HotSpot compiles none above 8000 bytes: the cleansing of a
    wide table then runs interpreted, at several times the CPU time. Above this
    limit Spark uses its operators' own, shorter methods instead."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > JIT_METHOD_BYTES:
        spark.conf.set(key, str(JIT_METHOD_BYTES))


#: Stored bytes of one task's share of a scan, about. As text the rows take some
#: thirty times as much, and the map-side sort of a share then stays in memory.
SCAN_BYTES = 16 << 20


def ensure_splits(spark: SparkSession) -> None:
    """Scans are cut into shares of ``SCAN_BYTES`` where they are read, so that
    no shuffle has to deal the rows of a large file out again."""
    key = "spark.sql.files.maxPartitionBytes"
    if int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()) > SCAN_BYTES:
        spark.conf.set(key, str(SCAN_BYTES))


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``). Only
    a local session that names none (tests) gets a private temporary folder:
    on a cluster the machines would not see each other's files."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="gridlake-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder of ``scratch_path`` that is removed at the end."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Spark's own switch for ``shuffles_dropped``.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of each query are removed when it has ended.
    Else they stay until the driver happens to collect its garbage, and a run
    of many queries holds the shuffles of several at once. For queries that are
    run once: a second action on the same DataFrame would shuffle anew."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Settings for a cluster run sized from the expected input volume.

    Shuffle partitions start high enough that each holds about
    ``target_partition_bytes`` of the largest shuffle (the raw-table dedup,
    roughly the input size) and at least 3 waves of tasks; AQE then
    coalesces small ones and splits skewed ones, so a hot key or file never
    becomes one oversized task. Scan splits of 256 MB keep task counts
    manageable on very large inputs without making tasks spill.
    """
    partitions = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.codegen.hugeMethodLimit": str(JIT_METHOD_BYTES),
    }
