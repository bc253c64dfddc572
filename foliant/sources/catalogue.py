"""Catalogue scans, table discovery and the exchange-file sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from foliant.sources.schemas import CATALOGUE

ILLEGAL_FILE_CHARS = r'[\\/:*?"<>|]'


def trim_strings(df: DataFrame) -> DataFrame:
    """Right-trim every string column: fixed-width catalogue columns arrive blank-padded."""
    return df.select(
        *[F.rtrim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name) for f in df.schema]
    )


def load_table(
    spark: SparkSession, root: str, name: str, cols: Sequence[str] | None = None, suffix: str = ".parquet"
) -> DataFrame:
    """Parquet scan of one table with its fixed schema; only ``cols`` reach the scan."""
    reader = spark.read
    schema = CATALOGUE.get(name.upper())
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(f"{root.rstrip('/')}/{name}{suffix}")
    return trim_strings(df.select(*cols) if cols else df)


def load_jdbc(
    spark: SparkSession,
    url: str,
    name: str,
    cols: Sequence[str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The same scan on a live database; give a key and its bounds to read in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, fetchsize="10000", **(options or {}))
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    df = reader.load()
    df = df.drop(*[c for c in df.columns if c.upper() == "PASSWORD"])
    return trim_strings(df.select(*cols) if cols else df)


def first_existing(spark: SparkSession, names: Sequence[str]) -> str | None:
    """First of several candidate table names that exists."""
    return next((n for n in names if spark.catalog.tableExists(n)), None)


def require_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Raise with the full list of missing tables."""
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise ValueError(f"missing tables: {', '.join(missing)}")


def describe_table(df: DataFrame, table: str) -> DataFrame:
    """One row per column: name, type, nullable, ordinal. Reads no data."""
    rows = [(table, f.name, f.dataType.simpleString(), f.nullable, i + 1) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(
        rows, "table_name string, column_name string, data_type string, nullable boolean, ordinal int"
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, all counted in one job."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def read_csv_checked(
    spark: SparkSession, path: str, required: Sequence[str], schema: StructType | None = None
) -> DataFrame:
    """Header CSV with a check of its columns; names compare case-insensitively.

    Without a schema every column is a string, as in the exchange files; there is no
    inference pass over the data.
    """
    reader = spark.read.options(header=True, quote='"', escape='"', multiLine=False)
    header = [c.strip() for c in reader.csv(path).columns]
    missing = sorted({r.lower() for r in required} - {c.lower() for c in header})
    if missing:
        raise ValueError(f"{path}: missing columns {', '.join(missing)}")
    if schema is None:
        schema = StructType([StructField(c, StringType()) for c in header])
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def write_csv(df: DataFrame, path: str, cols: Sequence[str] | None = None, order: Sequence[str] | None = None) -> None:
    """Header CSV with a fixed column order and standard quoting; range-sorted when ``order`` is given."""
    out = df.select(*cols) if cols else df
    if order:
        out = order_output(out, order)
    out.write.options(header=True, quote='"', escape='"', emptyValue="", nullValue="").mode("overwrite").csv(path)


def order_output(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Total order, meant for the sink only."""
    return df.orderBy(*keys)


def safe_file_name(col: Column) -> Column:
    """Replace characters that file systems refuse."""
    return F.regexp_replace(col, ILLEGAL_FILE_CHARS, "_")


def species_file(name: Column, start: int, end: int | None = None) -> Column:
    """``<species>_<start>[_<end>]`` with illegal characters replaced."""
    tail = f"_{start}" if end is None else f"_{start}_{end}"
    return F.concat(safe_file_name(name), F.lit(tail))


def write_per_species(
    df: DataFrame,
    path: str,
    name: str = "REPORT_SPECIES_NAME",
    start: int = 2000,
    end: int | None = None,
    max_rows_per_file: int = 0,
) -> None:
    """One folder per report species, with as many files as its tasks wrote; ``max_rows_per_file`` (0: none) cuts them further.

    The rebalance hint lets adaptive execution cut a species with a third of all rows into
    many tasks and pack small species together, by the sizes it sees at run time.
    """
    out = df.withColumn("species_file", species_file(F.col(name), start, end))
    (
        out.hint("rebalance", "species_file")
        .write.partitionBy("species_file")
        .options(header=True, quote='"', escape='"', maxRecordsPerFile=max_rows_per_file)
        .mode("overwrite")
        .csv(path)
    )


def export_clean(df: DataFrame) -> DataFrame:
    """Strings trimmed on both sides, NULL strings become ''."""
    return df.select(
        *[
            F.coalesce(F.btrim(F.col(f.name)), F.lit("")).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def sample_export(df: DataFrame, keys: Sequence[str | Column], n: int) -> DataFrame:
    """Preview: first ``n`` rows in key order (top-n per task, then a merge)."""
    return df.orderBy(*keys).limit(n)
