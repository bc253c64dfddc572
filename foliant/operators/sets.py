"""Unions, differences, comparisons and reconciliations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import strip
from foliant.scale import global_index


def split_ids(col: Column) -> Column:
    """Non-empty members of a pipe list."""
    return F.filter(F.transform(F.split(F.coalesce(col, F.lit("")), r"\|"), strip), lambda p: p != "")


def unique_rids(tables: Sequence[DataFrame], col: str = "RID") -> DataFrame:
    """Distinct ids of several grant tables (pipe lists), with a sort key that puts numbers first."""
    parts = [t.select(F.explode(split_ids(F.col(col))).alias("rid")) for t in tables]
    return (
        reduce(DataFrame.unionByName, parts).distinct().withColumn("rid_number", F.col("rid").try_cast("long"))
    )


def by_number(col: str = "rid_number", text: str = "rid") -> list[Column]:
    """Sort order: numbers ascending, non-numeric ids last."""
    return [F.col(col).asc_nulls_last(), F.col(text).asc()]


def append_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Existing plus new rows; columns missing on one side are filled with ''."""
    out = old.unionByName(new, allowMissingColumns=True)
    strings = {c for c, t in out.dtypes if t == "string"}
    gaps = (set(old.columns) ^ set(new.columns)) & strings
    return out.fillna("", subset=sorted(gaps)) if gaps else out


def new_group_ids(unmapped: DataFrame, groups: DataFrame, rid: str = "rid", group: str = "GROUP_ID") -> DataFrame:
    """Unmapped ids that are not groups yet."""
    known = groups.select(F.col(group).cast("long").alias(rid)).distinct()
    return unmapped.select(F.col(rid).cast("long").alias(rid)).distinct().join(known, rid, "left_anti")


def pick_users(
    users: DataFrame, admins: Sequence[str], n: int | None, name: str = "USERNAME", order: Sequence[str] = ("USER_ID",)
) -> DataFrame:
    """Administrators first, then the first ``n`` others in order (all of them without ``n``)."""
    is_admin = strip(F.col(name)).isin(list(admins))
    rest = users.filter(~is_admin)
    if n is not None:
        rest = rest.orderBy(*order).limit(n)
    return users.filter(is_admin).withColumn("rank_group", F.lit(0)).unionByName(rest.withColumn("rank_group", F.lit(1)))


def filter_assignments(assign: DataFrame, users: DataFrame, key: str = "USER_ID") -> DataFrame:
    """Assignments of the selected users."""
    return assign.join(users.select(key).distinct(), key, "left_semi")


def compare_outputs(a: DataFrame, b: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Difference of two outputs with the same columns.

    Without keys: each distinct row with its number of copies on both sides, kept when
    these differ. One shuffle with partial sums, so many equal copies cost one row per task.
    With keys: one row per key that differs, with status ``mismatch``, ``only_a`` or ``only_b``.
    """
    cols = a.columns
    if keys is None:
        tagged = a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
            b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
        )
        return (
            tagged.groupBy(*cols)
            .agg(F.sum("_a").alias("copies_a"), F.sum("_b").alias("copies_b"))
            .filter(F.col("copies_a") != F.col("copies_b"))
        )
    rest = [c for c in cols if c not in keys]
    left = a.select(*keys, F.struct(*rest).alias("row_a"))
    right = b.select(*keys, F.struct(*rest).alias("row_b"))
    status = (
        F.when(F.col("row_b").isNull(), "only_a")
        .when(F.col("row_a").isNull(), "only_b")
        .when(~F.col("row_a").eqNullSafe(F.col("row_b")), "mismatch")
    )
    return left.join(right, list(keys), "full_outer").withColumn("status", status).filter(F.col("status").isNotNull())


def compare_by_position(a: DataFrame, b: DataFrame, order: Sequence[str]) -> DataFrame:
    """Row-by-row comparison of two outputs in ``order`` (a unique key), as a file diff would show it."""
    left = global_index(a, order, "position")
    right = global_index(b, order, "position")
    return compare_outputs(left, right.select(*left.columns), keys=["position"])


def verdict(differences: DataFrame) -> DataFrame:
    """One row: number of differences and PASS or FAIL."""
    n = F.count("*")
    return differences.agg(n.alias("differences"), F.when(n == 0, "PASS").otherwise("FAIL").alias("verdict"))


def reconcile(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Every expected name with ``found`` or ``missing``."""
    present = actual.select(F.col(key), F.lit(True).alias("_hit")).distinct()
    status = F.when(F.col("_hit"), "found").otherwise("missing")
    return expected.join(present, key, "left").withColumn("status", status).drop("_hit")


def intersect_pages(search: DataFrame, sections: DataFrame, keys: Sequence[str] = ("file", "page")) -> DataFrame:
    """Pages found by the index search that also lie in the requested sections."""
    return search.select(*keys).distinct().join(sections.select(*keys).distinct(), list(keys), "left_semi")


def next_ids(df: DataFrame, col: str, n: int, offset: int = 1000) -> DataFrame:
    """``n`` new ids after the largest one: max + offset + 1..n."""
    top = df.agg(F.coalesce(F.max(F.col(col).cast("long")), F.lit(0))).scalar()
    return df.sparkSession.range(1, n + 1).select((top + offset + F.col("id")).alias(col), F.col("id").alias("position"))


def top_n(df: DataFrame, keys: Sequence[str | Column], n: int, cols: Sequence[str] | None = None) -> DataFrame:
    """``TOP n ... ORDER BY``; with ``cols`` the distinct values of these columns."""
    out = df.select(*cols).distinct() if cols else df
    return out.orderBy(*keys).limit(n)


def outcome_counts(df: DataFrame, col: str = "action") -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("outcomes"))
