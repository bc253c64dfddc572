"""Comparison by hash trees against the plain comparison."""

import pytest
from pyspark.sql import functions as F

from foliant.operators import hashtree as ht
from foliant.operators import sets as st


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def base(spark):
    cols = ["id AS k", "id % 7 AS n", "concat('t', id % 100) AS t", "array(id, null) AS l", "CASE WHEN id % 9 > 0 THEN id END AS e"]
    return spark.range(5000).selectExpr(*cols)


def test_equal_outputs_need_no_row(spark, base):
    again = base.repartition(5).select(*reversed(base.columns))
    a, b = ht.with_bucket(base, ["k"]), ht.with_bucket(again.select(*base.columns), ["k"])
    assert ht.differing_buckets(ht.hash_tree(a), ht.hash_tree(b)) == []
    same = ht.compare_by_tree(base, again, ["k"])
    assert same.count() == 0
    assert "Exchange" not in same._jdf.queryExecution().optimizedPlan().toString()


def test_one_change_reads_one_bucket(spark, base, tmp_path):
    changed = base.withColumn("t", F.when(F.col("k") == 77, "other").otherwise(F.col("t")))
    ht.store_with_tree(base, str(tmp_path / "a"), ["k"])
    ht.store_with_tree(changed, str(tmp_path / "b"), ["k"])
    trees = [spark.read.parquet(str(tmp_path / p / "tree")) for p in "ab"]
    assert len(ht.differing_buckets(*trees)) == 1
    got = ht.compare_stored(spark, str(tmp_path / "a"), str(tmp_path / "b"), ["k"])
    assert rows(got) == rows(st.compare_outputs(base, changed, ["k"]))
    assert got.count() == 1
    assert "PushedFilters: [IsNotNull(_bucket), EqualTo(_bucket" in got._jdf.queryExecution().toString()


@pytest.mark.parametrize("keys", [None, ["k"]])
def test_many_changes_equal_the_plain_comparison(spark, base, keys):
    a = base.where("k % 11 <> 3")
    b = base.where("k % 13 <> 5").withColumn("e", F.when(F.col("k") % 17 == 1, None).otherwise(F.col("e")))
    if keys is None:
        a, b = a.drop("k", "l", "e").unionByName(a.drop("k", "l", "e").limit(10)), b.drop("k", "l", "e")
    assert rows(ht.compare_by_tree(a, b, keys)) == rows(st.compare_outputs(a, b, keys))


def test_nulls_count_by_their_place_and_copies_by_their_number(spark):
    kind = "a int, b int, c array<int>"
    one = spark.createDataFrame([(None, 1, [None, 1]), (2, 2, [3])], kind)
    for other in ([(1, None, [None, 1]), (2, 2, [3])], [(None, 1, [1, None]), (2, 2, [3])], [(None, 1, [None, 1]), (2, 2, [3]), (2, 2, [3])]):
        b = spark.createDataFrame(other, kind)
        assert rows(ht.compare_by_tree(one, b)) == rows(st.compare_outputs(one, b)) != []


def test_empty_and_unlike_outputs(spark, base):
    assert ht.compare_by_tree(base.limit(0), base.limit(0), ["k"]).count() == 0
    assert ht.compare_by_tree(base, base.limit(0), ["k"]).count() == 5000
    with pytest.raises(ValueError, match="different columns"):
        ht.compare_by_tree(base, base.drop("t"))
