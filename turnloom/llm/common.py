"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import struct
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.sources.scratch import scratch_path

# Just below a power of two, which sizes the tables of the rolling hash.
CHUNK_BYTES = 1_000_000
# Rows go to Python in batches of about this size; Spark's own 64 MB are held several times per task.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
# Rows that a scan decodes at a time; Spark's own 4096 texts are arrays of many MB in each task.
SCAN_ROWS, SCAN_SETTING = 512, "spark.sql.parquet.columnarReaderBatchSize"
# Written tables are gathered in memory by row groups of this size; Parquet's own is 128 MB.
ROW_GROUP_BYTES = 16 << 20
# Lets an execution's shuffle files go when it ends; else they wait for the driver's garbage collection.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# What clears the tables that a task keeps between batches.
CLEARED_AFTER_TASKS: list[Callable[[], None]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def small_batches(spark: SparkSession) -> None:
    """Let the session read rows and hand them to Python in small batches; results stay the same.

    A size that the session has chosen itself stays.
    """
    if spark.conf.get(SCAN_SETTING) == "4096":  # Spark's default
        spark.conf.set(SCAN_SETTING, str(SCAN_ROWS))
    if spark.conf.get(BATCH_SETTING) == f"{64 << 20}b":  # Spark's default
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


@contextmanager
def shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind; the session's setting stays."""
    before = spark.conf.get(CLEANUP_SETTING, "false")
    if before == "true":
        yield
        return
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_SETTING, before)


class Work:
    """Tables written to the shared folder, so that lost executors cannot change them.

    Every step that a later one reads twice, or whose rows depend on sampled ranges, is written
    here and read again. A written table needs its shuffle files no more, so they go with the
    write. `clear` deletes what no returned frame needs any more, `passing` what only the steps
    inside it read.
    """

    def __init__(self, spark: SparkSession) -> None:
        small_batches(spark)
        self.spark = spark
        self.paths: list[str] = []

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        with shuffles_cleaned(self.spark):
            df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self, keep: int = 0) -> None:
        """Delete all tables but the last `keep`."""
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        gone = self.paths[: len(self.paths) - keep]
        for name in gone:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
        self.paths = self.paths[len(gone) :]

    @contextmanager
    def passing(self) -> Iterator[Work]:
        """Tables that are deleted at the end; frames that read them must be written before."""
        steps = Work(self.spark)
        try:
            yield steps
        finally:
            steps.clear()


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def slices(sizes: Iterable[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges (first, end) of rows whose sizes add up to the limit at most, or of one larger row."""
    first = total = at = 0
    for at, size in enumerate(sizes):
        if at > first and total + size > limit:
            yield first, at
            first, total = at, 0
        total += size
    if total or at + 1 > first:
        yield first, at + 1


def give_back() -> None:
    """Return what a task no longer uses: workers live on and their next task starts lean."""
    for clear in CLEARED_AFTER_TASKS:
        clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def lean(body: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The body of a mapInArrow that gives memory back when its task ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from body(batches)
        finally:
            give_back()

    return run


def text_chunks(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts as UTF-8, NULL as empty, of bounded size."""
    try:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(batch.schema.get_field_index(text))
            sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
            for first, end in slices(sizes, limit):
                some = column.slice(first, end - first).cast(pa.large_binary()).to_pylist()
                yield batch.slice(first, end - first), [t or b"" for t in some]
    finally:
        give_back()


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as one compressed value."""
    parts = [struct.pack("<I", len(arrays))]
    for array in arrays:
        kind = array.dtype.str.encode().ljust(4)
        parts += [kind, struct.pack("<q", array.size), np.ascontiguousarray(array).tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack_arrays(value: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    (count,), at, arrays = struct.unpack_from("<I", raw), 4, []
    for _ in range(count):
        kind = np.dtype(raw[at : at + 4].decode().strip())
        (size,) = struct.unpack_from("<q", raw, at + 4)
        arrays.append(np.frombuffer(raw, kind, size, at + 12))
        at += 12 + size * kind.itemsize
    return arrays


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def group_starts(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if not len(ordered):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges starts[i] .. starts[i] + lengths[i] - 1."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
