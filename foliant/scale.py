"""Shared building blocks that keep one hot key from landing in one task.

Spark's plain window functions put a whole partition key into one task. The helpers
here cut a key into blocks that follow the sort order, work inside the blocks, and
carry one small row per block across, so a key that holds a third of all rows is
spread over as many tasks as it has blocks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LINES_PER_BLOCK = 65_536


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session that does not name one (a test) gets a temporary folder; on a cluster each executor would
    write to a folder of its own, so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    fallback = tempfile.mkdtemp(prefix="foliant-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/foliant-{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike a local one."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


#: Bytes (as JSON text) up to which a counted side is sent to all tasks.
MAX_SENT_BYTES = 256 << 20


def small_side(df: DataFrame, max_rows: int = 200_000, weight: Column | None = None) -> DataFrame:
    """Mark a join side for broadcast if, and only if, it was counted and is small.

    For sides that decide which large binary rows survive a join: Spark cannot know their size
    before it plans, and would shuffle the content of every file to find out. The side is
    checkpointed, its rows (or the sum of ``weight``) and its bytes are counted, and beyond ``max_rows``
    or ``MAX_SENT_BYTES`` it stays an ordinary shuffle join.
    """
    side = cut_lineage(df)
    load = F.coalesce(F.sum(F.lit(1) if weight is None else weight), F.lit(0))
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long")), F.lit(0))
    found = side.agg(load.alias("load"), size.alias("size")).first()
    return F.broadcast(side) if found["load"] <= max_rows and found["size"] <= MAX_SENT_BYTES else side


def _sort(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def global_index(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """0-based position of every row in the total order of ``order``.

    A window without keys would sort everything in one task. Here the rows are range
    partitioned, numbered inside their partition, and shifted by the row counts of the
    partitions before; only one count per partition travels. The checkpoint pins the
    range boundaries, so a lost executor cannot renumber half of the rows.
    ``order`` must be a unique key.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = cut_lineage(ranged.withColumn("_id", F.monotonically_increasing_id()))
    # monotonically_increasing_id = partition number in the upper 31 bits, row in the lower 33
    numbered = numbered.withColumn("_part", F.shiftright("_id", 33))
    counts = numbered.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    row_in_part = F.col("_id") - F.shiftleft(F.col("_part"), 33)
    # at most one row per shuffle partition, so the broadcast is bounded by the partition count
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_off") + row_in_part).cast("long"))
        .drop("_part", "_id", "_off")
    )


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, tuple[str, Column]], block: Column
) -> DataFrame:
    """Running ``sum`` or ``max`` of several values per key in ``order``, cut into ``block``s.

    ``values``: output name to (function, value); ``sum_before`` and ``max_before`` leave the row itself out. ``block`` must not decrease along ``order``.
    The blocks' totals and the rows inside the blocks share one partitioning.
    """
    fn = {"sum": F.sum, "max": F.max, "sum_before": F.sum, "max_before": F.max}
    blocks = df.withColumn("_blk", block).withColumns({f"_v_{n}": v for n, (_, v) in values.items()})
    totals = blocks.groupBy(*keys, "_blk").agg(*[fn[how](f"_v_{n}").alias(f"_t_{n}") for n, (how, _) in values.items()])
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, "_blk", *[fn[how](f"_t_{n}").over(before).alias(f"_c_{n}") for n, (how, _) in values.items()])
    inside = Window.partitionBy(*keys, "_blk").orderBy(*order)

    def merged(name: str, how: str) -> Column:
        frame = inside.rowsBetween(Window.unboundedPreceding, -1 if how.endswith("_before") else 0)
        here, carry = fn[how](f"_v_{name}").over(frame), F.col(f"_c_{name}")
        return F.coalesce(here, F.lit(0)) + F.coalesce(carry, F.lit(0)) if how.startswith("sum") else F.greatest(here, carry)

    out = blocks.join(carried, [*keys, "_blk"])
    return out.withColumns({n: merged(n, how) for n, (how, _) in values.items()}).select(*df.columns, *values)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, block: Column
) -> DataFrame:
    """Running sum of one value, see ``running``."""
    return running(df, keys, order, {name: ("sum", value)}, block)


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    block: Column,
    descending: bool = False,
    among: Column | None = None,
) -> DataFrame:
    """``struct(v)`` of the last row before (of those that satisfy ``among``), NULL when there is
    none; a NULL value of an existing row stays visible.

    ``block`` must follow ``order`` (ascending, whatever ``descending`` says).
    """
    held = F.struct(value.alias("v"))
    blocks = df.withColumn("_blk", block).withColumn("_v", held if among is None else F.when(among, held))
    pick = F.min_by if descending else F.max_by
    last = blocks.groupBy(*keys, "_blk").agg(
        pick(F.col("_v"), F.when(F.col("_v").isNotNull(), F.struct(*order))).alias("_last")
    )
    across = Window.partitionBy(*keys).orderBy(*_sort(["_blk"], descending)).rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*keys, "_blk", F.last("_last", ignorenulls=True).over(across).alias("_carry"))
    inside = (
        Window.partitionBy(*keys, "_blk").orderBy(*_sort(order, descending)).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        blocks.join(carried, [*keys, "_blk"])
        .withColumn(name, F.coalesce(F.last("_v", ignorenulls=True).over(inside), F.col("_carry")))
        .drop("_blk", "_v", "_carry")
    )


def ordered_concat(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    text: Column,
    sep: str,
    name: str,
    block: Column,
) -> DataFrame:
    """One string per key: ``text`` joined by ``sep`` in ``order``.

    Blocks are sorted and joined in separate tasks first; the last step only joins the
    block strings, so no task ever sorts the rows of a whole key.
    """
    parts = (
        df.select(*keys, block.alias("_blk"), F.struct(*order, text.alias("_t")).alias("_r"))
        .groupBy(*keys, "_blk")
        .agg(F.sort_array(F.collect_list("_r")).alias("_rows"))
        .select(*keys, "_blk", F.array_join(F.transform("_rows", lambda r: r["_t"]), sep).alias("_t"))
    )
    return (
        parts.groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("_blk", "_t"))).alias("_parts"))
        .select(*keys, F.array_join(F.transform("_parts", lambda r: r["_t"]), sep).alias(name))
    )
