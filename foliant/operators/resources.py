"""Print resources: inventory over version folders, namespace merge; archive manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import base_name, clean_year, strip, strip_ext
from foliant.operators.windows import dedupe_versions, version_matrix


def merge_namespaces(df: DataFrame) -> DataFrame:
    """All namespaces under one label; versions carry their namespace, so equal folder names stay apart."""
    return df.withColumn("version", F.concat_ws("\\", "namespace", "version")).withColumn("namespace", F.lit("ALL_NAMESPACES"))


def resource_inventory(versions: DataFrame, compare_content: bool = True, merged: bool = False) -> tuple[DataFrame, DataFrame]:
    """(inventory, kept versions). Inventory: one row per resource with its versions newest first."""
    rows = merge_namespaces(versions) if merged else versions
    kept = dedupe_versions(rows) if compare_content else rows
    return version_matrix(kept), kept


def archive_manifest(
    instances: DataFrame, listing: DataFrame, existing: DataFrame, simulate: bool = False, path: str = "path"
) -> DataFrame:
    """Archive path and status per instance: SKIPPED (archive exists), NO_FILES_FOUND or PLANNED.

    ``instances``: (SPECIES_ID, SPECIES_NAME, FILENAME, YEAR, ...). Rows without a file name are
    left out. ``existing`` lists archives as ``<year>/<name>.zip``.
    """
    base = strip_ext(F.col("FILENAME"))
    rows = (
        instances.filter(strip(F.coalesce("FILENAME", F.lit(""))) != "")
        .withColumn("_base", base)
        .withColumn("_year", clean_year(F.coalesce(F.col("YEAR").cast("string"), F.lit(""))))
        .withColumn("_archive", F.concat("_year", F.lit("/"), "_base", F.lit(".zip")))
    )
    prefix = "\\SIMULATE\\" if simulate else "\\"
    target = F.concat(F.lit(prefix), F.col("_year"), F.lit("\\"), F.col("_base"), F.lit(".zip"))
    if simulate:
        return rows.withColumn("STATUS", F.lit("PLANNED")).withColumn("COMPRESSED_FILENAME", target).select(
            *instances.columns, "STATUS", "COMPRESSED_FILENAME"
        )
    stem = F.regexp_replace(base_name(F.col(path)), r"\.[^.]*$", "")
    files = listing.groupBy(stem.alias("_base")).agg(F.count("*").alias("_files"))
    done = existing.select(F.col(path).alias("_archive"), F.lit(True).alias("_done")).distinct()
    status = (
        F.when(F.col("_done"), "SKIPPED").when(F.coalesce("_files", F.lit(0)) == 0, "NO_FILES_FOUND").otherwise("PLANNED")
    )
    return (
        rows.join(done, "_archive", "left")
        .join(files, "_base", "left")
        .withColumn("STATUS", status)
        .withColumn("COMPRESSED_FILENAME", F.when(F.col("STATUS") == "NO_FILES_FOUND", "").otherwise(target))
        .withColumn("FILE_COUNT", F.coalesce("_files", F.lit(0)).cast("long"))
        .select(*instances.columns, "STATUS", "COMPRESSED_FILENAME", "FILE_COUNT")
    )


def missing_files(manifest: DataFrame) -> DataFrame:
    return manifest.filter(F.col("STATUS") == "NO_FILES_FOUND").select("SPECIES_NAME", "FILENAME", "YEAR")


def missing_species(species: DataFrame, instances: DataFrame, key: str = "SPECIES_ID") -> DataFrame:
    """Species without any instance list."""
    return species.join(instances.select(key).distinct(), key, "left_anti")
