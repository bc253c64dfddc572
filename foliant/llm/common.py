"""Small helpers of the operators: tables, scratch Parquet, per-process caches of Python workers."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.scale import global_index, scratch_path

#: Rows of an Arrow batch of texts: with the default of 10,000, a batch and its copies take a good part of a small
#: executor's memory.
ARROW_ROWS = 1_000
#: Bytes of text handled at once inside a Python task, so that numpy's temporaries stay small.
SLICE_BYTES = 1_000_000

#: Tables made by the innermost ``passing``.
_MADE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("_MADE", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The rows written as Parquet to the shared folder and read back, until the end of the innermost ``passing``.

    Cuts the lineage like a reliable checkpoint: a lost executor never makes an earlier stage run again, and Spark
    knows the size of what it reads.
    """
    path = scratch_path(df.sparkSession, label)
    if (made := _MADE.get()) is not None:
        made.append(path)
    return _stored(df, path, **options)


def plain(df: DataFrame, label: str) -> DataFrame:
    """As ``written``, uncompressed: for narrow tables of keys and digests, which do not shrink and need no native buffers."""
    return written(df, label, compression="uncompressed")


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """As ``written``, but for whoever called ``passing``."""
    return _stored(df, scratch_path(df.sparkSession, label))


def _stored(df: DataFrame, path: str, **options: str) -> DataFrame:
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that ``written`` makes inside are deleted at the end: nothing that lives on may still read them."""
    made: list[str] = []
    outer = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(outer)
        discard(spark, *made)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables in the shared folder, through Spark's own access to it."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def small_batches(df: DataFrame) -> DataFrame:
    """The rows; from now on the session sends Python at most ``ARROW_ROWS`` of them at once (fewer, if it does so already)."""
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= ARROW_ROWS:
        conf.set(key, ARROW_ROWS)
    return df


def positions(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows with ``_pos``, their place among the rows of their ``key`` (not null) in ``order``, and ``_n``, its rows.

    Rows are range partitioned, numbered over the whole table and shifted by the first number of their key. The first
    numbers meet the rows by key and stretch of numbers, so neither step puts a large key, nor a large tie, into one
    task. Equal rows come in any order.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    numbered = global_index(tied, [key, *order, "_tie"], "_row").drop("_tie").withColumn("_stretch", F.shiftright("_row", 16))
    keys = numbered.groupBy(key).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    stretches = F.sequence(F.shiftright("_first", 16), F.shiftright(F.col("_first") + F.col("_n") - 1, 16))
    placed = numbered.join(keys.withColumn("_stretch", F.explode(stretches)), [key, "_stretch"])
    return placed.withColumn("_pos", F.col("_row") - F.col("_first")).select(*rows.columns, "_pos", "_n")


def per_process(key: object, make: Callable[[], object]) -> object:
    """An object made once in each Python worker and kept for its later tasks (tokenizers, caches)."""
    held = sys.modules.setdefault("_foliant_worker", types.ModuleType("_foliant_worker")).__dict__.setdefault("held", {})
    if key not in held:
        held[key] = make()
    return held[key]


def release_memory() -> None:
    """Give freed memory back to the system: workers stay alive between tasks, several in one executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive pieces of a batch with about ``limit`` bytes of text each, one row at least."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < len(sizes):
        yield batch.slice(start)
    release_memory()
