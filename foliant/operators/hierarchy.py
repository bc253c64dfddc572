"""Folder forest: validity, inherited country codes and the folder exchange tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import DEFAULT_COUNTRY, country_of_name
from foliant.operators.instances import species_names, unknown_species
from foliant.operators.windows import country_conflicts, final_country, first_per_key, running_country
from foliant.scale import cut_lineage


def resolve_forest(folder: DataFrame) -> DataFrame:
    """Every folder with ``valid`` (reaches a root through existing folders that are not type 3)
    and ``COUNTRY_CODE`` (own code, else the nearest ancestor's, else the default).

    Pointer doubling: each round a folder's pointer jumps to where its target points, so the
    distance covered doubles and a tree of depth d needs about log2(d) equi-joins instead of d.
    Folders on a cycle never reach a root; the rounds end when no folder changes state. A
    parent with very many children is a hot join key on the pointer side only; the other
    side has one row per folder, so adaptive execution can split it.
    """
    # target 0 = a root has been passed, NULL = dead end
    usable = F.col("ITEM_TYPE") != 3
    state = folder.select(
        F.col("ITEM_ID").cast("long").alias("ITEM_ID"), "NAME", F.col("PARENT_ID").cast("long").alias("PARENT_ID"), "ITEM_TYPE"
    ).select("*", F.when(usable, F.col("PARENT_ID")).alias("_to"), country_of_name(F.col("NAME")).alias("_code"))
    state = cut_lineage(state)
    open_before = -1
    while True:  # the distance doubles, so this ends after the logarithm of the depth, on cycles too
        unresolved = state.filter(F.col("_to").isNotNull() & (F.col("_to") != 0))
        still_open = unresolved.count()
        if still_open in (0, open_before):
            break
        open_before = still_open
        targets = state.select(F.col("ITEM_ID").alias("_to"), F.col("_to").alias("_next"), F.col("_code").alias("_up"))
        hopped = unresolved.join(targets, "_to", "left").select(
            "ITEM_ID", "NAME", "PARENT_ID", "ITEM_TYPE", F.col("_next").alias("_to"), F.coalesce("_code", "_up").alias("_code")
        )
        done = state.filter(F.col("_to").isNull() | (F.col("_to") == 0))
        state = cut_lineage(done.unionByName(hopped))
    valid = F.coalesce(F.col("_to") == 0, F.lit(False))
    return state.select(
        "ITEM_ID", "NAME", "PARENT_ID", "ITEM_TYPE", valid.alias("valid"),
        F.coalesce("_code", F.lit(DEFAULT_COUNTRY)).alias("COUNTRY_CODE"),
    )


def valid_folders(folder: DataFrame) -> DataFrame:
    """Folders reachable from a root; orphans, type 3, their descendants and cycles are out."""
    return resolve_forest(folder).filter("valid").select("ITEM_ID", "NAME", "PARENT_ID", "ITEM_TYPE")


def excluded_folders(folder: DataFrame, valid: DataFrame) -> DataFrame:
    """Counts of the folders left out: all, type 3, other."""
    out = folder.select(F.col("ITEM_ID").cast("long").alias("ITEM_ID"), "ITEM_TYPE").join(
        valid.select("ITEM_ID"), "ITEM_ID", "left_anti"
    )
    return out.agg(
        F.count("*").alias("excluded"),
        F.count_if(F.col("ITEM_TYPE") == 3).alias("type_3"),
        F.count_if(F.col("ITEM_TYPE") != 3).alias("other"),
    )


def inherit_country(folder: DataFrame, mode: str = "0") -> DataFrame:
    """Valid folders with their country code: inherited (mode ``0``), or one fixed code for all."""
    out = resolve_forest(folder).filter("valid").drop("valid")
    return out if mode == "0" else out.withColumn("COUNTRY_CODE", F.lit(mode))


def folder_hierarchy(coded: DataFrame) -> DataFrame:
    return coded.select("ITEM_ID", "NAME", "PARENT_ID", "ITEM_TYPE", "COUNTRY_CODE")


def _mappings(coded: DataFrame, folder_species: DataFrame) -> DataFrame:
    links = folder_species.select(F.col("ITEM_ID").cast("long").alias("ITEM_ID"), "DOMAIN_ID", "REPORT_SPECIES_ID")
    return links.filter(F.col("REPORT_SPECIES_ID") != 0).join(
        coded.select("ITEM_ID", F.col("NAME").alias("ITEM_NAME"), "COUNTRY_CODE"), "ITEM_ID"
    )


def _named(df: DataFrame, rsn: DataFrame) -> DataFrame:
    unknown = unknown_species(F.col("REPORT_SPECIES_ID"))
    return (
        df.join(species_names(rsn), ["DOMAIN_ID", "REPORT_SPECIES_ID"], "left")
        .withColumn("REPORT_SPECIES_NAME", F.coalesce("REPORT_SPECIES_NAME", unknown))
        .withColumn("REPORT_SPECIES_DISPLAYNAME", F.coalesce("REPORT_SPECIES_DISPLAYNAME", unknown))
    )


def folder_report(coded: DataFrame, folder_species: DataFrame, rsn: DataFrame) -> DataFrame:
    """Folder to species mapping; the country is the species' *running* code at that folder."""
    rows = running_country(_mappings(coded, folder_species))
    return _named(rows, rsn).select(
        "ITEM_ID", "ITEM_NAME", "REPORT_SPECIES_ID", "REPORT_SPECIES_NAME", "REPORT_SPECIES_DISPLAYNAME",
        F.col("RUNNING_CODE").alias("COUNTRY_CODE"),
    )


def report_species(coded: DataFrame, folder_species: DataFrame, rsn: DataFrame) -> DataFrame:
    """Distinct species with the domain of their first folder; the country is the *final* code."""
    rows = _mappings(coded, folder_species).filter(F.col("REPORT_SPECIES_ID") > 0)
    first = first_per_key(rows.select("REPORT_SPECIES_ID", "ITEM_ID", "DOMAIN_ID"), ["REPORT_SPECIES_ID"], ["ITEM_ID", "DOMAIN_ID"])
    return _named(first.join(final_country(rows), "REPORT_SPECIES_ID"), rsn).select(
        "REPORT_SPECIES_ID", "REPORT_SPECIES_NAME", "REPORT_SPECIES_DISPLAYNAME",
        F.col("FINAL_CODE").alias("COUNTRY_CODE"), F.lit(1).alias("IN_USE"),
    )


def conflicts(coded: DataFrame, folder_species: DataFrame) -> DataFrame:
    """Folders whose country contradicts the code their species already had."""
    return country_conflicts(_mappings(coded, folder_species)).select(
        "REPORT_SPECIES_ID", "ITEM_ID", "EXISTING_CODE", F.col("COUNTRY_CODE").alias("FOLDER_CODE")
    )


def mark_in_use(species: DataFrame, instances: DataFrame) -> DataFrame:
    """``IN_USE`` becomes 0 for species without instances; others keep their value."""
    seen = instances.select("REPORT_SPECIES_ID").distinct().withColumn("_seen", F.lit(True))
    return (
        species.join(seen, "REPORT_SPECIES_ID", "left")
        .withColumn("IN_USE", F.when(F.col("_seen"), F.col("IN_USE")).otherwise(0))
        .select(*species.columns)
    )
