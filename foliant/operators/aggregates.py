"""Counts, distributions, profiles and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import base_name
from foliant.sources.schemas import INSTANCE_KEY


def map_stats(correlated: DataFrame) -> DataFrame:
    """Totals over correlated index files."""
    return correlated.agg(
        F.count("*").alias("total_files"),
        F.count_if(F.col("header_valid")).alias("valid_headers"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
        F.count_if(F.col("has_db_entry")).alias("with_db_entry"),
        F.count_if(F.col("segments_match")).alias("segment_matches"),
        F.coalesce(F.sum("binary_segment_count"), F.lit(0)).alias("binary_segments"),
        F.coalesce(F.sum("db_segment_count"), F.lit(0)).alias("db_segments"),
    )


def map_distributions(correlated: DataFrame, filename: str = "filename") -> DataFrame:
    """Counts by two-digit year, by domain and by segment count, in one pass.

    The three groupings come from one scan: every row is expanded to three labelled values
    and partially aggregated before the shuffle.
    """
    labelled = F.array(
        F.struct(F.lit("year").alias("kind"), F.substring(F.col(filename), 1, 2).alias("value")),
        F.struct(F.lit("domain").alias("kind"), F.col("DOMAIN_ID").cast("string").alias("value")),
        F.struct(F.lit("segments").alias("kind"), F.col("binary_segment_count").cast("string").alias("value")),
    )
    return correlated.select(F.explode(labelled).alias("g")).groupBy("g.kind", "g.value").agg(F.count("*").alias("files"))


def column_profile(df: DataFrame, col: str) -> DataFrame:
    c = F.col(col)
    return df.agg(
        F.min(c).alias("min_value"), F.max(c).alias("max_value"), F.count(c).alias("value_count"),
        F.count_distinct(c).alias("distinct_count"),
    )


def segment_profile(ris: DataFrame, k: int, keys: Sequence[str] = tuple(INSTANCE_KEY[:3]), number: str = "SEGMENT_NUMBER") -> DataFrame:
    """Count, least and greatest segment per key; the ``k`` keys with most segments."""
    return (
        ris.groupBy(*keys)
        .agg(F.count("*").alias("segments"), F.min(number).alias("first_segment"), F.max(number).alias("last_segment"))
        .orderBy(F.desc("segments"), *keys)
        .limit(k)
    )


def maps_with_sections(catalogue: DataFrame, section: DataFrame, k: int) -> DataFrame:
    """The ``k`` index files whose species has most sections."""
    key = ["DOMAIN_ID", "REPORT_SPECIES_ID"]
    per_species = section.groupBy(*key).agg(F.count("*").alias("section_count"))
    return (
        catalogue.groupBy("MAP_FILE_ID", "FILENAME", *key)
        .agg(F.count("*").alias("_copies"))
        .join(per_species, key)
        .select("MAP_FILE_ID", "FILENAME", *key, (F.col("section_count") * F.col("_copies")).alias("section_count"))
        .filter(F.col("section_count") > 0)
        .orderBy(F.desc("section_count"), "MAP_FILE_ID", *key)
        .limit(k)
    )


def value_counts(
    entries: DataFrame, cap: int = 0, keys: Sequence[str] = (), value: str = "value", entry_no: str = "entry_no"
) -> DataFrame:
    """Index values with their number of occurrences.

    A cap (0 = none) applies to the entries as they are read from each segment, blank ones
    included, before counting: a filter on the entry's own position.
    """
    rows = entries.filter(F.col(entry_no) < cap) if cap > 0 else entries
    return rows.groupBy(*keys, value).agg(F.count("*").alias("occurrences"))


def page_volume(pages: DataFrame, keys: Sequence[str] = (), packed: str = "compressed_size", raw: str = "uncompressed_size") -> DataFrame:
    """Sum of packed and raw sizes and their ratio (0 when nothing is packed)."""
    return pages.groupBy(*keys).agg(
        F.sum(packed).cast("long").alias("compressed"),
        F.sum(raw).cast("long").alias("uncompressed"),
        F.when(F.sum(packed) > 0, F.sum(raw) / F.sum(packed)).otherwise(0.0).alias("ratio"),
    )


def species_summary(species: DataFrame, instances: DataFrame) -> DataFrame:
    """Per species: instances, distinct report files that exist and that have sections, most
    sections in one file, distinct index files present; species without instances stay.

    Instances are first reduced to one row per file, so distinct counts become plain counts
    and a species with very many instances is aggregated before it is grouped.
    """
    key = "REPORT_SPECIES_ID"
    per_rpt = (
        instances.groupBy(key, F.upper(base_name(F.coalesce("FILENAME", F.lit("")))).alias("_f"))
        .agg(
            F.count("*").alias("_n"),
            F.max((F.col("RPT_FILE_EXISTS") == "Y").cast("int")).alias("_exists"),
            F.max(F.when(F.col("SEGMENTS") != "", F.size(F.split("SEGMENTS", r"\|"))).otherwise(0)).alias("_sections"),
        )
        .groupBy(key)
        .agg(
            F.sum("_n").alias("INSTANCE_COUNT"),
            F.sum("_exists").cast("long").alias("RPT_FILES_EXIST"),
            F.count_if(F.col("_sections") > 0).alias("RPT_FILES_FOUND"),
            F.max("_sections").alias("MAX_SECTIONS"),
        )
    )
    per_map = (
        instances.filter((F.coalesce("MAP_FILENAME", F.lit("")) != "") & (F.col("MAP_FILE_EXISTS") == "Y"))
        .select(key, F.upper("MAP_FILENAME").alias("_m"))
        .distinct()
        .groupBy(key)
        .agg(F.count("*").alias("MAP_FILES_FOUND"))
    )
    out = species.join(per_rpt, key, "left").join(per_map, key, "left")
    counts = ["INSTANCE_COUNT", "RPT_FILES_EXIST", "RPT_FILES_FOUND", "MAX_SECTIONS", "MAP_FILES_FOUND"]
    return out.select(*species.columns, *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts])


def exclusive_files(refs: DataFrame, delete_keys: DataFrame, file_id: str, keys: Sequence[str] = tuple(INSTANCE_KEY[:3])) -> DataFrame:
    """Files all of whose references lie in the delete set; nothing else may still need them."""
    gone = delete_keys.select(*keys).distinct().withColumn("_gone", F.lit(True))
    return (
        refs.select(*keys, file_id)
        .join(gone, list(keys), "left")
        .groupBy(file_id)
        .agg(F.bool_and(F.coalesce("_gone", F.lit(False))).alias("_all"))
        .filter("_all")
        .select(file_id)
    )


def signature_stats(sig: DataFrame, domain: int | None = None, keys: Sequence[str] = ("DOMAIN_ID", "REPORT_SPECIES_ID", "SIGN_ID")) -> DataFrame:
    """Total rows, distinct keys, stale rows, latest rows and percent stale, from one aggregate per key."""
    rows = sig if domain is None else sig.filter(F.col("DOMAIN_ID") == domain)
    # per key and version first: a hot key arrives as one row per version
    per_version = rows.groupBy(*keys, "MINOR_VERSION").agg(F.count("*").alias("_n"))
    top = per_version.groupBy(*keys).agg(
        F.sum("_n").alias("_n"), F.max(F.struct("MINOR_VERSION", "_n"))["_n"].alias("_latest")
    )
    total, latest = F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum("_latest"), F.lit(0))
    return top.agg(
        total.alias("total_rows"),
        F.count("*").alias("distinct_keys"),
        (total - latest).alias("old_rows"),
        latest.alias("latest_rows"),
        F.when(total > 0, F.round((total - latest) * 100.0 / total, 1)).otherwise(0.0).cast("double").alias("old_percent"),
    )


def plan_counts(plan: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table of a deletion plan, all tables in one job (the dry run)."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(i).alias("step"), F.lit(name).alias("table_name"), "rows")
        for i, (name, df) in enumerate(plan.items(), 1)
    ]
    return reduce(DataFrame.unionByName, parts)


def country_counts(folders: DataFrame, code: str = "COUNTRY_CODE") -> DataFrame:
    return folders.groupBy(code).agg(F.count("*").alias("folders"))


def file_stats(plan: DataFrame) -> DataFrame:
    """Planned files per year and per type."""
    labelled = F.array(
        F.struct(F.lit("year").alias("kind"), F.col("YEAR").cast("string").alias("value")),
        F.struct(F.lit("type").alias("kind"), F.col("file_type").alias("value")),
    )
    return plan.select(F.explode(labelled).alias("g")).groupBy("g.kind", "g.value").agg(F.count("*").alias("files"))


def resource_stats(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("namespace", "filename")) -> DataFrame:
    """Unique resources, most versions of one resource, versions before and after, removed."""
    count = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    both = count(before, "_b").join(count(after, "_a"), list(keys), "left")
    b, a = F.coalesce(F.sum("_b"), F.lit(0)), F.coalesce(F.sum("_a"), F.lit(0))
    return both.agg(
        F.count("*").alias("unique_resources"),
        F.coalesce(F.max("_b"), F.lit(0)).alias("max_versions"),
        b.alias("versions_before"),
        a.alias("versions_after"),
        (b - a).alias("removed"),
    )


def verify_maps(map_header: DataFrame) -> DataFrame:
    """Scan summary over index files: readable, empty, broken, segments in total and on average."""
    ok = F.col("header_valid") & (F.col("marker_count") > 0)
    return map_header.agg(
        F.count("*").alias("files"),
        F.count_if(ok).alias("ok"),
        F.count_if(F.col("header_valid") & (F.col("marker_count") == 0)).alias("empty"),
        F.count_if(~F.col("header_valid")).alias("errors"),
        F.coalesce(F.sum(F.when(ok, F.col("marker_count"))), F.lit(0)).cast("long").alias("total_segments"),
        F.coalesce(F.avg(F.when(ok, F.col("marker_count"))), F.lit(0.0)).alias("average_segments"),
    )


def segment_value_distribution(df: DataFrame, cols: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Count, distinct count and range of header numbers, one row per column."""
    stacked = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("long").alias("v")) for c in cols])
    per_value = (
        df.select(*group, F.explode(stacked).alias("s")).groupBy(*group, "s.name", "s.v").agg(F.count("*").alias("_n"))
    )
    return per_value.groupBy(*group, "name").agg(
        F.sum("_n").alias("value_count"), F.count("v").alias("distinct_values"), F.min("v").alias("min_value"),
        F.max("v").alias("max_value"),
    )
