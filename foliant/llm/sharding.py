"""Shards by extendible hashing: only buckets above the limit look at one more bit of their rows' hashes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import written
from foliant.scale import cut_lineage

#: Bits of a hash, and bits beyond the expected depth that the first count of buckets goes down at once.
BITS, AHEAD = 60, 6


def _prefix(hashed: Column, depth: Column) -> Column:
    return F.call_function("shiftright", hashed, (F.lit(BITS) - depth).cast("int"))


def _hash(key: Column) -> Column:
    """The first BITS bits of SHA-256."""
    return F.conv(F.substring(F.sha2(key, 256), 1, BITS // 4), 16, 10).cast("long")


def shards(docs: DataFrame, limit_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes``, ``shard``, ``depth``, ``shard_bytes`` and ``shard_rows`` of every row.

    A shard is named by the hash bits its rows share (``depth`` of them, the empty string is the only shard of a small
    table). It is the shortest prefix whose rows have at most ``limit_bytes`` of text, or are one row, which no bit
    can split; so no shard is above the limit but for a single text that is. Rows that share an id are hashed with a
    number of their own and spread like any others. Null and empty texts have no bytes; null ids count as one id.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"))
    # written, so that the numbers stay what they are
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "sizes")
    key = F.coalesce(F.col("_id").cast("string"), F.lit(""))
    repeated = cut_lineage(rows.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_key", F.lit(True).alias("_many")))
    hashed = rows.withColumn("_key", key).join(repeated, "_key", "left")
    hashed = hashed.select("_id", "n_bytes", _hash(F.when(F.col("_many"), F.concat("_key", F.lit("#"), F.col("_row").cast("string"))).otherwise(F.col("_key"))).alias("_hash"))
    total = hashed.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n")).first()["n"]
    step = min(BITS, AHEAD + max(0, math.ceil(math.log2(max(total, 1) / limit_bytes))))

    # fine buckets: all of one depth, but those that are still too large, which go on
    fine = written(hashed.withColumn("_fine", F.lit(step)), "hashes")
    while step < BITS:
        bucket = _prefix(F.col("_hash"), F.col("_fine")).alias("_prefix")
        large = fine.where(F.col("_fine") == step).groupBy(bucket).agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("r"))
        large = cut_lineage(large.where((F.col("b") > limit_bytes) & (F.col("r") > 1)).select("_prefix"))
        if large.isEmpty():
            break
        deeper = min(BITS, step + AHEAD)
        marked = fine.withColumn("_prefix", F.when(F.col("_fine") == step, _prefix(F.col("_hash"), F.lit(step)))).join(large.withColumn("_go", F.lit(deeper)), "_prefix", "left")
        fine = written(marked.select("_id", "n_bytes", "_hash", F.coalesce("_go", "_fine").alias("_fine")), "hashes")
        step = deeper

    # the directory: totals of all prefixes of the fine buckets; a row's shard is its shortest prefix that fits
    placed = fine.withColumn("_prefix", _prefix(F.col("_hash"), F.col("_fine")))
    buckets = cut_lineage(placed.groupBy("_fine", "_prefix").agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("r")))
    paths = buckets.select("_fine", "_prefix", "b", "r", F.explode(F.sequence(F.lit(0), F.col("_fine"))).alias("depth"))
    paths = paths.withColumn("node", F.call_function("shiftright", F.col("_prefix"), F.col("_fine") - F.col("depth")))
    nodes = paths.groupBy("depth", "node").agg(F.sum("b").alias("shard_bytes"), F.sum("r").alias("shard_rows"))
    nodes = cut_lineage(nodes.where((F.col("shard_bytes") <= limit_bytes) | (F.col("shard_rows") == 1) | (F.col("depth") == BITS)))
    own = paths.select("_fine", "_prefix", "depth", "node").join(nodes, ["depth", "node"])
    found = own.groupBy("_fine", "_prefix").agg(F.min(F.struct("depth", "node", "shard_bytes", "shard_rows")).alias("s"))
    bits = F.lpad(F.conv(F.col("s.node").cast("string"), 10, 2), F.col("s.depth"), F.lit("0"))
    name = F.when(F.col("s.depth") == 0, F.lit("")).otherwise(bits)
    out = placed.join(cut_lineage(found), ["_fine", "_prefix"])
    return out.select(F.col("_id").alias(id_col), "n_bytes", name.alias("shard"), F.col("s.depth").alias("depth"), "s.shard_bytes", "s.shard_rows")


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the rows of ``docs`` to one folder for each shard; ids must be unique."""
    rows = docs.join(assigned.select(id_col, F.concat(F.lit("b"), "shard").alias("shard")), id_col)
    rows.repartition("shard").write.partitionBy("shard").parquet(path)
