"""Registered queries: each one a Spark callable and, where SQL can say it, the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from foliant.plans.views import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread an input with fewer partitions than cores; one that has enough is left alone.

    The given files are single small row groups; an archive of many files never needs this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 2 * cores else df.repartition(2 * cores, *keys)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A catalogue-shaped view of the given tables, see ``views``."""
    sql, bases = VIEWS[name]
    return spark.sql(sql, **{b: table(spark, sf_dir, b) for b in bases})


def oracle(sql: str, views: Sequence[str] = ()) -> str:
    """The comparison SQL with the views it uses in front of it."""
    if not views:
        return sql
    parts = []
    for name in views:
        text, bases = VIEWS[name]
        for b in bases:
            text = text.replace("{" + b + "}", b)
        parts.append(f"{name} AS ({text})")
    return f"WITH {', '.join(parts)} SELECT * FROM ({sql}) AS answer"


def query(name: str, sql: str | None = None, views: Sequence[str] = ()) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = oracle(sql, views)
        return fn

    return register
