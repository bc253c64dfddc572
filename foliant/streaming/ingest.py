"""Incremental ingest: resume where the last run stopped, and log outcomes as work proceeds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LOG_COLUMNS = ["SPECIES_ID", "FILENAME", "STATUS", "LOGGED_AT"]


def pending_rows(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch form: rows whose key is not among the outputs already written."""
    return df.join(done.select(*keys).distinct(), list(keys), "left_anti")


def ingest_incremental(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_batch: int = 1000,
    log: str | None = None,
) -> None:
    """Stream form: process every file not processed before, then stop.

    The checkpoint folder is the progress file: a rerun starts after the last finished batch
    and a lost executor repeats its batch only. Each batch is written to its own folder,
    replaced when it runs again, so output stays exactly-once.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)

    def write(batch: DataFrame, number: int) -> None:
        write_batch(transform(batch), number, target, log)

    query = (
        reader.load(source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def write_batch(out: DataFrame, number: int, target: str, log: str | None = None) -> None:
    """Rows of one batch in a folder of its own, which a repeated batch replaces, then the log of what was written.

    The log reads the written rows, so ``out`` is computed once, and a batch is never logged before its rows are there.
    """
    part = f"{target.rstrip('/')}/batch={number}"
    out.write.mode("overwrite").parquet(part)
    if log:
        append_log(out.sparkSession.read.schema(out.schema).parquet(part), log, number)


def append_log(df: DataFrame, path: str, number: int) -> None:
    """Outcome log of batch ``number``, with one spelling of each key, next to the other batches' parts of the log below
    ``path``; a repeated batch replaces its own part and no other."""
    log_rows(df).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole log, with the number of the batch that wrote each row."""
    kinds = ", ".join(f"{c} string" for c in LOG_COLUMNS[:-1])
    return spark.read.schema(f"{kinds}, {LOG_COLUMNS[-1]} timestamp, batch long").parquet(path)


def log_rows(df: DataFrame) -> DataFrame:
    names = {c.upper(): c for c in df.columns}
    pick = lambda c: F.col(names[c]).cast("string") if c in names else F.lit("")
    return df.select(*[pick(c).alias(c) for c in LOG_COLUMNS[:-1]], F.current_timestamp().alias("LOGGED_AT"))


def archive_log(manifest: DataFrame) -> DataFrame:
    """Log rows of an archive manifest."""
    return manifest.select(
        F.col("SPECIES_ID").cast("string").alias("SPECIES_ID"), "FILENAME", F.upper("STATUS").alias("STATUS"), "COMPRESSED_FILENAME"
    )
