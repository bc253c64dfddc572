"""Latest and first rows, running codes, version histories, page numbers, round-robin classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.text import DEFAULT_COUNTRY
from foliant.scale import global_index, previous_row


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    Spark turns ``row_number() = 1`` into a group limit before the shuffle, so a task
    sends at most one row per key, however many rows the key has.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key; the caller's order must break ties."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def _first_code(df: DataFrame, key: str, order: Sequence[str], code: str, default: str) -> DataFrame:
    """Per key the earliest code that is not the default, with its position."""
    return (
        df.filter(F.col(code) != default)
        .groupBy(key)
        .agg(F.min(F.struct(*order, F.col(code).alias("_code"))).alias("_first"))
        .select(F.col(key), F.struct(*[F.col(f"_first.{c}") for c in order]).alias("_at"), F.col("_first._code").alias("_code"))
    )


def running_country(
    mappings: DataFrame,
    key: str = "REPORT_SPECIES_ID",
    order: Sequence[str] = ("ITEM_ID",),
    code: str = "COUNTRY_CODE",
    default: str = DEFAULT_COUNTRY,
    name: str = "RUNNING_CODE",
) -> DataFrame:
    """First non-default code of the key seen so far, else the default.

    Once a key has left the default it never changes, so one small aggregate per key (the
    position of its first non-default row) replaces a window over all of its rows.
    """
    first = _first_code(mappings, key, order, code, default)
    seen = F.struct(*order) >= F.col("_at")
    return (
        mappings.join(first, key, "left")
        .withColumn(name, F.when(seen, F.col("_code")).otherwise(default))
        .drop("_at", "_code")
    )


def final_country(
    mappings: DataFrame,
    key: str = "REPORT_SPECIES_ID",
    order: Sequence[str] = ("ITEM_ID",),
    code: str = "COUNTRY_CODE",
    default: str = DEFAULT_COUNTRY,
    name: str = "FINAL_CODE",
) -> DataFrame:
    """State of each key after its last row."""
    state = F.min(F.when(F.col(code) != default, F.struct(*order, F.col(code).alias("_code"))))
    return mappings.groupBy(key).agg(F.coalesce(state["_code"], F.lit(default)).alias(name))


def country_conflicts(
    mappings: DataFrame,
    key: str = "REPORT_SPECIES_ID",
    order: Sequence[str] = ("ITEM_ID",),
    code: str = "COUNTRY_CODE",
    default: str = DEFAULT_COUNTRY,
) -> DataFrame:
    """Rows whose code differs from a non-default state reached before them (a default code too)."""
    first = _first_code(mappings, key, order, code, default)
    return (
        mappings.join(first, key)
        .filter((F.struct(*order) > F.col("_at")) & (F.col(code) != F.col("_code")))
        .withColumnRenamed("_code", "EXISTING_CODE")
        .drop("_at")
    )


def version_month(version: str = "version") -> Column:
    """``[NS\\]YYYY_MM`` of a version name: blocks of one month follow the version order."""
    return F.regexp_extract(F.col(version), r"^(.*\d{4}_\d{2})_\d{2}_\d{2}$", 1)


def dedupe_versions(
    df: DataFrame,
    keys: Sequence[str] = ("namespace", "filename"),
    version: str = "version",
    crc: str = "crc",
    block: Column | None = None,
) -> DataFrame:
    """Newest first: keep the newest version, and older ones whose content differs from the
    last kept and from the newest. Missing CRCs count as equal.

    Rows equal to the newest never count as "last kept", so after dropping them the last
    kept content is simply the content of the row before.
    """
    top = df.groupBy(*keys).agg(
        F.max(version).alias("_v1"), F.max_by(F.struct(F.col(crc).alias("c")), F.col(version)).alias("_c1")
    )
    newest = F.col(version) == F.col("_v1")
    other = ~newest & ~F.col(crc).eqNullSafe(F.col("_c1.c"))
    flagged = df.join(top, list(keys)).withColumn("_newest", newest).withColumn("_other", other)
    blocks = version_month(version) if block is None else block
    rows = previous_row(flagged, keys, [version], F.col(crc), "_before", blocks, descending=True, among=F.col("_other"))
    changed = F.col("_before").isNull() | ~F.col(crc).eqNullSafe(F.col("_before.v"))
    return rows.filter(F.col("_newest") | (F.col("_other") & changed)).select(*df.columns)


def order_versions(df: DataFrame, merged: bool = False, namespace: str = "namespace", version: str = "version") -> DataFrame:
    """Newest first. Merged mode sorts by ``NS\\version``, so the last namespace dominates."""
    if merged:
        df = df.withColumn(version, F.concat_ws("\\", namespace, version)).withColumn(namespace, F.lit("ALL_NAMESPACES"))
    return df.orderBy(F.asc(namespace), F.asc("filename"), F.desc(version))


def version_matrix(
    df: DataFrame,
    keys: Sequence[str] = ("namespace", "filename", "resource_type"),
    version: str = "version",
    wide: bool = False,
    columns: int | None = None,
) -> DataFrame:
    """One row per resource: number of versions and the versions newest first.

    ``wide`` adds columns V1..Vn; n is the largest version count *before* deduplication,
    which the caller passes (one number, from ``resource_stats``).
    """
    out = df.groupBy(*keys).agg(F.sort_array(F.collect_list(version), asc=False).alias("versions"))
    out = out.withColumn("version_count", F.size("versions"))
    if not wide:
        return out
    if columns is None:
        raise ValueError("wide output needs the number of version columns")
    cols = [F.coalesce(F.get("versions", F.lit(i)), F.lit("")).alias(f"V{i + 1}") for i in range(columns)]
    return out.select(*keys, "version_count", *cols)


def assign_class(df: DataFrame, order: Sequence[str], classes: int = 10, name: str = "class") -> DataFrame:
    """Round-robin class over all rows in ``order``, without one task sorting them all."""
    return global_index(df, order, "_idx").withColumn(name, (F.col("_idx") % classes).cast("int")).drop("_idx")


def stale_versions(df: DataFrame, keys: Sequence[str], version: str = "MINOR_VERSION") -> DataFrame:
    """Rows for which a row with the same keys and a greater version exists.

    "Some greater one exists" is "the maximum is greater": one partial aggregate per key and
    an equi-join instead of comparing all pairs of a key.
    """
    top = df.groupBy(*keys).agg(F.max(version).alias("_top"))
    return df.join(top, list(keys)).filter(F.col(version) < F.col("_top")).drop("_top")


def latest_versions(df: DataFrame, keys: Sequence[str], version: str = "MINOR_VERSION") -> DataFrame:
    """The rows ``stale_versions`` leaves: all rows at the greatest version of their key."""
    top = df.groupBy(*keys).agg(F.max(version).alias("_top"))
    return df.join(top, list(keys)).filter(F.col(version) == F.col("_top")).drop("_top")
