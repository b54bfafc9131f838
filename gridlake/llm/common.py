"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Texts are worked on in slices of about this many bytes, so a task's memory
#: does not grow with the batch (one longer text makes a slice of its own).
SLICE_BYTES, SLICE_ROWS = 1 << 20, 1 << 12

_P = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1
_IP = pow(_P, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str, rows: int | None = None, per_file: int = 100_000) -> DataFrame:
    """Write to the cluster's shared folder and read back: cuts lineage, and
    survives lost executors. ``rows``, a bound on the result's rows, keeps the
    small tables of an iteration in few files: ``per_file`` rows in each."""
    if rows is not None:
        df = df.coalesce(rows // per_file + 1)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of the map that ``maybe_in`` broadcasts, at most (32 MB).
MOST_BITS = 28


def maybe_in(rows: DataFrame, key: str, wanted: DataFrame, n: int, flag: str = "_maybe") -> DataFrame:
    """rows with a boolean ``flag``: true for every row whose ``key``, a 64-bit
    hash, is one of the ``n`` keys in the column of that name of ``wanted``,
    and seldom for others. What is broadcast is one bit for each place of a
    map of bounded size; a full map lets more rows through and loses none."""
    bits = 1 << min(max((16 * n).bit_length(), 15), MOST_BITS)
    place, part, held, at = (free_name(c, rows) for c in ("_place", "_part", "_bits", "_at"))
    own = wanted.select(F.pmod(F.col(key), F.lit(bits)).alias(place))
    maps = own.groupBy(F.shiftright(place, 15).alias(part)).agg(
        F.bitmap_construct_agg(F.col(place).bitwiseAND(F.lit((1 << 15) - 1))).alias(held))
    maps = store(maps, "bitmap", bits >> 15, 512)
    both = rows.withColumn(place, F.pmod(F.col(key), F.lit(bits))).withColumn(at, F.shiftright(place, 15)).join(
        F.broadcast(maps), F.col(at) == F.col(part), "left")
    inside = F.col(place).bitwiseAND(F.lit((1 << 15) - 1))
    byte = F.conv(F.hex(F.substring(held, F.shiftright(inside, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return both.withColumn(flag, F.coalesce(F.getbit(byte, inside.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))).select(*rows.columns, flag)


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, or a longer one if a column of the frames is called so."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name in taken:
        name += "_"
    return name


def held_out(doc_id: str = "doc_id"):
    """Rows kept out of training: crc32 of the id's text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_P))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
#: bytes 9-13 and 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[str, np.ndarray] = {}


def _pow(base: int, n: int) -> np.ndarray:
    key = str(base)
    if key not in _powers or len(_powers[key]) < n:
        a = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        a[0] = 1
        _powers[key] = np.multiply.accumulate(a)
    return _powers[key][:n]


class Texts:
    """The words (runs of bytes other than 9-13 and 32) of a slice of texts.

    ``buf`` all bytes, ``bounds`` byte bounds of each text, ``start``/``end``
    byte positions of each word, ``first`` index of each text's first word
    (one more entry than texts).
    """

    def __init__(self, buf: np.ndarray, bounds: np.ndarray):
        self.buf, self.bounds = buf, bounds
        n = len(buf)
        word = ~IS_SPACE[buf]
        cut = np.zeros(n + 1, dtype=bool)
        cut[bounds] = True
        before = np.empty(n, dtype=bool)
        after = np.empty(n, dtype=bool)
        if n:
            before[0], before[1:] = False, word[:-1]
            after[-1], after[:-1] = False, word[1:]
        self.start = np.flatnonzero(word & (~before | cut[:n]))
        self.end = np.flatnonzero(word & (~after | cut[1:])) + 1
        self.first = np.searchsorted(self.start, bounds)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.bounds[i]:self.bounds[i + 1]].tobytes()

    def doc(self) -> np.ndarray:
        """The text's index, for each word."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64-bit hash of each word (A-Z taken as a-z if ``lower``)."""
        n = len(self.buf)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((_BYTE_LOWER if lower else _BYTE)[self.buf] * _pow(_P, n), out=sums[1:])
        value = (sums[self.end] - sums[self.start]) * _pow(_IP, n + 1)[self.start]
        return mix(value + (self.end - self.start).astype(np.uint64))

    def span_hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of each run of bytes."""
        n = len(self.buf)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.buf] * _pow(_P, n), out=sums[1:])
        return mix((sums[end] - sums[start]) * _pow(_IP, n + 1)[start] + (end - start).astype(np.uint64))


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, last row + 1, words) of consecutive rows of a string
    column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, at, data = column.buffers()
    at = np.frombuffer(at, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if at is not None else np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(at, at[row] + size, side="right")) - 1
        last = min(max(last, row + 1), row + SLICE_ROWS, len(column))
        yield row, last, Texts(data[at[row]:at[last]], (at[row:last + 1] - at[row]).astype(np.int64))
        row = last


#: Rows of documents that Spark and a Python task pass each other at once.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Batches of whole texts stay small: Spark's 10000 rows are tens of MB,
    which the executor and its Python task hold several times over each."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def give_back() -> None:
    """What this process has freed goes back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
    if trim:
        trim(0)


def released(run: Callable) -> Callable:
    """``run`` for a Python task, after which what it has freed goes back to
    the machine: an idle worker is kept for the tasks to come, and would hold
    the peak of every task it has run beside the executor's own memory."""
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return whole


def map_texts(df: DataFrame, make: Callable, schema: str, text: str = "text") -> DataFrame:
    """``make(rows, texts) -> dict of columns`` for each slice of rows, run in
    the tasks over Arrow batches; ``rows`` holds the other columns as Arrow."""
    def run(batches):
        for batch in batches:
            for a, b, texts in slices(batch.column(text)):
                yield pa.RecordBatch.from_pydict(make(batch.slice(a, b - a), texts))
    return df.mapInArrow(released(run), schema)


def longs(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64) if a.dtype == np.uint64 else a.astype(np.int64))


def lists(flat: pa.Array, counts: np.ndarray) -> pa.Array:
    """A list column from its flat values and the count of each row."""
    at = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), flat)


def components(edges: DataFrame, rows: int, name: str = "components") -> DataFrame:
    """Connected components of ``edges (a long, b long)``, at most ``rows``:
    each node with the smallest node of its component, as (node, comp).

    Alternates the two star steps: every node's larger neighbours, then its
    smaller ones, are hung on its smallest neighbour. A node's minimum is
    pre-aggregated in the map tasks, each round's links are a stored table,
    and a hub's links meet its minimum in a join that can be split.
    """
    def hang(links: DataFrame, smaller: bool) -> DataFrame:
        low = store(links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-low", 2 * rows)
        near = links.join(low, "u")
        if smaller:
            near = near.filter("v < u").select(F.col("v").alias("x"), "m").union(
                low.select(F.col("u").alias("x"), "m"))
        else:
            near = near.filter("v > u").select(F.col("v").alias("x"), "m")
        return near.filter("x <> m").select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct()

    def both(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = store(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name, rows)
    seen = mark(now)
    while seen[0]:
        now = store(hang(both(now), False), name, 2 * rows)
        now = store(hang(now.select(F.col("a").alias("u"), F.col("b").alias("v")), True), name, 2 * rows)
        last, seen = seen, mark(now)
        if seen == last:
            break
    # every node but the roots now has one link, to its root
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
