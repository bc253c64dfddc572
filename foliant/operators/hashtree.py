"""Comparison of two outputs by trees of hash sums: only buckets that differ are compared row by row.

Rows fall into buckets by their keys. A bucket's node is its number of rows and two sums of row digests, which do not
depend on the rows' order; a node above is the sum of sixteen below. Equal outputs are found equal by two map-side sums,
without a join and without a shuffle of rows; one changed row leaves one bucket to compare.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from foliant.operators.sets import compare_outputs

FANOUT_BITS = 4
LEVELS = 4
BUCKETS = 1 << FANOUT_BITS * LEVELS
#: Nodes or buckets named one by one in a filter; more of them are met by a join with at most ``BUCKETS`` numbers.
NAMED = 256
SUMS = ["rows", "digest_1", "digest_2"]


def _hash(df: DataFrame, cols: Sequence[str], seed: int) -> Column:
    """64 bits over columns. A NULL counts by its place, which the hash function alone would pass over."""
    parts = []
    for c in cols:
        kind = df.schema[c].dataType
        nested = isinstance(kind, (ArrayType, MapType, StructType, VariantType))
        parts += [F.to_json(F.struct(c), {"ignoreNullFields": "false"}) if nested else F.col(c), F.col(c).isNull()]
    return F.xxhash64(F.lit(seed), *parts)


def with_bucket(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows with the number of their bucket, by ``keys`` or by the whole row; equal keys share a bucket."""
    return df.withColumn("_bucket", F.pmod(_hash(df, keys or df.columns, 0), F.lit(BUCKETS)).cast("int"))


def hash_tree(bucketed: DataFrame) -> DataFrame:
    """(level, node, rows, digest_1, digest_2) of rows from ``with_bucket``: level 0 is the root, the last one the buckets.

    Rows are summed map-side; at most ``BUCKETS`` leaves a task travel. A hot key stays one row of sums in each task.
    """
    cols = [c for c in bucketed.columns if c != "_bucket"]
    number = lambda seed: F.sum(_hash(bucketed, cols, seed).cast("decimal(20,0)")).cast("decimal(38,0)")
    leaves = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("rows"), number(1).alias("digest_1"), number(2).alias("digest_2"))
    placed = leaves.withColumn("level", F.explode(F.array(*[F.lit(i) for i in range(LEVELS + 1)])))
    node = F.expr(f"shiftright(_bucket, {FANOUT_BITS} * ({LEVELS} - level))")
    sums = [F.sum(c).cast("long" if c == "rows" else "decimal(38,0)").alias(c) for c in SUMS]
    return placed.groupBy("level", node.alias("node")).agg(*sums)


def differing_buckets(a: DataFrame, b: DataFrame) -> list[int]:
    """Buckets whose nodes differ in two trees, found from the root down; below equal nodes nothing is read.

    At most ``BUCKETS`` numbers reach the driver.
    """
    negated = b.select("level", "node", *[(-F.col(c)).alias(c) for c in SUMS])
    both = a.select("level", "node", *SUMS).unionByName(negated)
    open_nodes = [0]
    for level in range(LEVELS + 1):
        rows = both.where(F.col("level") == level)
        if level and len(open_nodes) <= NAMED:
            rows = rows.where(F.shiftright("node", FANOUT_BITS).isin(open_nodes))
        sums = rows.groupBy("node").agg(*[F.sum(c).alias(c) for c in SUMS])
        open_nodes = [r[0] for r in sums.where("rows <> 0 OR digest_1 <> 0 OR digest_2 <> 0").select("node").collect()]
        if not open_nodes:
            return []
    return sorted(open_nodes)


def _only(df: DataFrame, buckets: list[int]) -> DataFrame:
    if len(buckets) <= NAMED:
        return df.where(F.col("_bucket").isin(buckets))
    numbers = df.sparkSession.createDataFrame([(b,) for b in buckets], "_bucket int")
    # at most BUCKETS numbers of four bytes
    return df.join(F.broadcast(numbers), "_bucket", "left_semi")


def _compared(a: DataFrame, b: DataFrame, buckets: list[int], keys: Sequence[str] | None) -> DataFrame:
    return compare_outputs(_only(a, buckets).drop("_bucket"), _only(b, buckets).drop("_bucket"), keys)


def compare_by_tree(a: DataFrame, b: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """``compare_outputs`` of the buckets that differ; ``a`` and ``b`` must give equal rows each time they are read.

    Columns are matched by name and must have the same types, else equal values would have different digests.
    """
    if {f.name: f.dataType for f in a.schema} != {f.name: f.dataType for f in b.schema}:
        raise ValueError("the outputs have different columns")
    a, b = with_bucket(a, keys), with_bucket(b.select(*a.columns), keys)
    return _compared(a, b, differing_buckets(hash_tree(a), hash_tree(b)), keys)


def store_with_tree(df: DataFrame, path: str, keys: Sequence[str] | None = None) -> None:
    """Write an output with its tree: rows range-sorted by bucket, so a later comparison skips what is equal."""
    rows, tree = f"{path.rstrip('/')}/rows", f"{path.rstrip('/')}/tree"
    # rows of one bucket may share a key; the row's own hash lets a hot bucket span several files
    bucketed = with_bucket(df, keys).withColumn("_row", _hash(df, df.columns, 3))
    bucketed.repartitionByRange("_bucket", "_row").sortWithinPartitions("_bucket").drop("_row").write.mode("overwrite").parquet(rows)
    stored = df.sparkSession.read.parquet(rows)
    hash_tree(stored).repartition(1).sortWithinPartitions("level", "node").write.mode("overwrite").parquet(tree)


def compare_stored(spark: SparkSession, path_a: str, path_b: str, keys: Sequence[str] | None = None) -> DataFrame:
    """``compare_outputs`` of two outputs from ``store_with_tree`` with the same ``keys``.

    Trees are read level by level; rows of equal buckets are not read.
    """
    rows = lambda path: spark.read.parquet(f"{path.rstrip('/')}/rows")
    tree = lambda path: spark.read.parquet(f"{path.rstrip('/')}/tree")
    a, b = rows(path_a), rows(path_b)
    if {f.name: f.dataType for f in a.schema} != {f.name: f.dataType for f in b.schema}:
        raise ValueError("the outputs have different columns")
    return _compared(a, b.select(*a.columns), differing_buckets(tree(path_a), tree(path_b)), keys)
