"""The block helpers against plain Python, with one key that holds most rows; plan checks."""

import random

import pytest
from pyspark.sql import functions as F

from foliant import scale
from foliant.operators import filters as fl
from foliant.operators import windows as wi
from foliant.plans.registry import view


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    keys = ["hot"] * 500 + ["a"] * 40 + ["b"]
    out = [(k, i, rnd.choice([None, 1, 2, 2, 3])) for i, k in enumerate(keys)]
    rnd.shuffle(out)
    return out


def by_key(rows):
    groups = {}
    for k, i, v in sorted(rows, key=lambda r: r[1]):
        groups.setdefault(k, []).append((i, v))
    return groups


def test_global_index_numbers_all_rows_in_order(spark, rows):
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(7)
    got = {r["i"]: r["n"] for r in scale.global_index(df, ["i"], "n").collect()}
    assert got == {i: i for i in range(len(rows))}


def test_running_sum_over_blocks(spark, rows):
    df = spark.createDataFrame(rows, "k string, i int, v int")
    out = scale.running_sum(df, ["k"], ["i"], F.coalesce("v", F.lit(0)), "s", F.floor(F.col("i") / 16))
    got = {(r["k"], r["i"]): r["s"] for r in out.collect()}
    want = {}
    for k, items in by_key(rows).items():
        total = 0
        for i, v in items:
            total += v or 0
            want[k, i] = total
    assert got == want


@pytest.mark.parametrize("descending", [False, True])
def test_previous_row_over_blocks(spark, rows, descending):
    df = spark.createDataFrame(rows, "k string, i int, v int")
    out = scale.previous_row(df, ["k"], ["i"], F.col("v"), "p", F.floor(F.col("i") / 16), descending)
    got = {(r["k"], r["i"]): None if r["p"] is None else ("row", r["p"]["v"]) for r in out.collect()}
    want = {}
    for k, items in by_key(rows).items():
        ordered = items[::-1] if descending else items
        for n, (i, _) in enumerate(ordered):
            want[k, i] = ("row", ordered[n - 1][1]) if n else None
    assert got == want


def test_ordered_concat_over_blocks(spark, rows):
    df = spark.createDataFrame(rows, "k string, i int, v int")
    out = scale.ordered_concat(df, ["k"], ["i"], F.col("i").cast("string"), ",", "t", F.floor(F.col("i") / 16))
    assert {r["k"]: r["t"] for r in out.collect()} == {k: ",".join(str(i) for i, _ in v) for k, v in by_key(rows).items()}


def test_small_side_broadcasts_only_below_the_limit(spark):
    big = spark.range(1000).withColumnRenamed("id", "k").repartition(4)
    side = spark.range(50).withColumnRenamed("id", "k")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(big.join(scale.small_side(side, 100), "k"))
        assert "BroadcastHashJoin" not in plan(big.join(scale.small_side(side, 10), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def explained(df):
    return df._jdf.queryExecution().toString()


def test_time_windows_and_columns_reach_the_scan(spark, sf_dir):
    ri = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = explained(fl.year_window(ri, "o_orderdate", 1996, 1997).select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_latest_per_key_limits_groups_before_the_shuffle(spark, sf_dir):
    ri = view(spark, sf_dir, "report_instance")
    plan = explained(wi.latest_per_key(ri, ["REPORT_SPECIES_ID"], ["AS_OF_TIMESTAMP"]))
    assert plan.count("WindowGroupLimit") >= 2


def test_no_pairwise_joins_in_any_query(spark, sf_dir):
    from __spark_entry__ import queries

    for name in ("pages_with_section", "pages_in_named_ranges", "stale_versions", "classify_lines", "running_country"):
        plan = explained(queries()[name](spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
