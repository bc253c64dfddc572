"""Scans of report containers, index files, spool text, version folders and field metadata;
section exchange files; match sinks; copy plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions.text import base_name, content_crc, resource_type, strip
from foliant.operators.filters import versions_from_year
from foliant.operators.windows import first_per_key
from foliant.scale import small_side
from foliant.sources.catalogue import read_csv_checked, write_csv
from foliant.sources.listing import listing
from foliant.sources.ranges import file_content

SECTION_COLUMNS = ["Report_Species_Id", "Section_Id", "Start_Page", "Pages"]
VERSION_FOLDER = r"\d{4}_\d{2}_\d{2}_\d{2}"


def _binary(spark: SparkSession, path: str, glob: str, recursive: bool, limit: int | None = None) -> DataFrame:
    """Files listed by tasks, see ``listing``; their contents are read where they are used."""
    files = listing(spark, path, glob, recursive)
    if files is None:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(path)
    if limit is not None:
        files = files.join(files.select("path").orderBy("path").limit(limit), "path", "left_semi")
    if "content" not in files.columns:
        files = files.withColumn("content", file_content("path"))
    return files.withColumn("file", base_name(F.col("path")))


def scan_rpt(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Report containers (any case of the extension) as (path, modificationTime, length, content, file)."""
    return _binary(spark, path, "*.[Rr][Pp][Tt]", recursive)


def scan_map(spark: SparkSession, path: str, limit: int | None = None, recursive: bool = False) -> DataFrame:
    """Index files; with a limit the first ones by path, chosen before any content is read."""
    return _binary(spark, path, "*.[Mm][Aa][Pp]", recursive, limit)


def scan_spool(spark: SparkSession, path: str, recursive: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """Spool text as (file, line_no, text) with 1-based line numbers; CRLF or LF.

    The text source splits a large file over many tasks. Inside one split the generated ids
    are consecutive, so line numbers need only the line count of the splits before: one
    small row per split, and no sort over the lines of a file.
    """
    raw = (
        spark.read.option("recursiveFileLookup", recursive)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_id"),
            F.col("value"),
        )
    )
    splits = raw.groupBy("path", "_start").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("path", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    text = F.col("value") if encoding == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    # one row per split: counted, and broadcast when small, so that the text itself is not shuffled
    return raw.join(small_side(offsets), ["path", "_start"]).select(
        base_name(F.col("path")).alias("file"),
        "path",
        (F.col("_off") + F.col("_id") - F.col("_first") + 1).cast("long").alias("line_no"),
        text.alias("text"),
    )


def lines_of_text(df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Lines of texts already held in rows, numbered from 1 per row."""
    return df.select(*keys, F.posexplode(F.split(F.col(text), r"\r?\n")).alias("_pos", "text")).select(
        *keys, (F.col("_pos") + 1).cast("long").alias("line_no"), "text"
    )


def versioned_files(files: DataFrame, root: str, default_ns: str = "DEFAULT", from_year: int | None = None) -> DataFrame:
    """Version folder layout of a listing: ``YYYY_MM_DD_HH/file`` or ``NS/YYYY_MM_DD_HH/file``.

    One version folder at the root makes the whole tree flat. Input needs ``path``; other
    columns are kept.
    """
    below = F.regexp_replace(F.regexp_replace("path", r"^file:/*", "/"), "^" + _quote(root.rstrip("/")) + "/", "")
    parts = F.split(below, "/")
    version = f"^{VERSION_FOLDER}$"
    rows = files.withColumn("_p", parts).withColumn("_flat", F.get("_p", F.lit(0)).rlike(version) & (F.size("_p") == 2))
    any_flat = rows.agg(F.coalesce(F.bool_or("_flat"), F.lit(False))).scalar()
    nested = (F.size("_p") == 3) & F.get("_p", F.lit(1)).rlike(version)
    rows = rows.filter(F.when(any_flat, F.col("_flat")).otherwise(nested))
    out = rows.select(
        *files.columns,
        F.when(F.col("_flat"), F.lit(default_ns)).otherwise(F.get("_p", F.lit(0))).alias("namespace"),
        F.element_at("_p", -2).alias("version"),
        F.element_at("_p", -1).alias("filename"),
    )
    return versions_from_year(out, from_year)


def _quote(text: str) -> str:
    return "\\Q" + text + "\\E"


def scan_versions(
    spark: SparkSession, root: str, default_ns: str = "DEFAULT", from_year: int | None = None, with_crc: bool = False
) -> DataFrame:
    """Resources of a version tree: namespace, version, filename, resource_type[, crc].

    Without CRCs no file content is read; unknown types are dropped before any CRC is computed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    files = files.select("path", "length", *(["content"] if with_crc else []))
    rows = versioned_files(files, root, default_ns, from_year).withColumn("resource_type", resource_type(F.col("filename")))
    rows = rows.filter(F.col("resource_type") != "Unknown")
    crc = content_crc(F.col("content")) if with_crc else F.lit(None).cast("long")
    return rows.select("path", "namespace", "version", "filename", "resource_type", crc.alias("crc"))


def read_field_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Field metadata JSON (one object per file) as rows keyed by ``field_key`` (trimmed, upper case)."""
    schema = (
        "species struct<name:string>, indexed_fields array<struct<name:string,line_id:long,field_id:long,"
        "start_column:long,end_column:long>>"
    )
    raw = spark.read.schema(schema).json(path, multiLine=True)
    return fields_of_metadata(raw)


def fields_of_metadata(raw: DataFrame) -> DataFrame:
    """Rows of parsed metadata; a repeated name keeps its last definition."""
    rows = raw.select(F.col("species.name").alias("species"), F.posexplode("indexed_fields").alias("_pos", "f"))
    rows = rows.select(
        "species", F.upper(strip(F.col("f.name"))).alias("field_key"), F.col("f.name").alias("field_name"), "f.line_id",
        "f.field_id", "f.start_column", "f.end_column", (-F.col("_pos")).alias("_last"),
    )
    return first_per_key(rows, ["species", "field_key"], ["_last"]).drop("_last")


def write_matches(df: DataFrame, fmt: str, path: str, part_rows: int) -> None:
    """Search results: CSV rows, or JSON lines of up to ``part_rows`` entries of one (file, field, segment), numbered
    by ``part``, so no task holds an unbounded list."""
    if fmt == "csv":
        write_csv(df, path)
    elif fmt == "json":
        match_documents(df, part_rows).write.mode("overwrite").json(path)
    else:
        raise ValueError(f"unknown format: {fmt}")


def match_documents(df: DataFrame, part_rows: int) -> DataFrame:
    """(file, field, segment, format, part, match_count, matches) documents; ``match_count`` counts all parts."""
    keys = ["file", "field", "segment_no", "format"]
    part = F.floor(F.col("entry_no") / part_rows).alias("part")
    docs = df.groupBy(*keys, part).agg(
        F.count("*").alias("_n"), F.sort_array(F.collect_list(F.struct("entry_no", "value", "page", "u32_key"))).alias("_m")
    )
    everything = Window.partitionBy(*keys)
    return docs.select(
        *keys,
        "part",
        F.sum("_n").over(everything).alias("match_count"),
        F.transform("_m", lambda m: F.struct(m["value"].alias("value"), m["page"].alias("page"), m["u32_key"].alias("u32_index"))).alias("matches"),
    )


def export_sections(df: DataFrame) -> DataFrame:
    """Section exchange columns from ``rpt_section`` rows."""
    return df.select(
        F.col("species_id").alias("Report_Species_Id"), F.col("section_id").alias("Section_Id"),
        F.col("start_page").alias("Start_Page"), F.col("page_count").alias("Pages"),
    )


def import_sections(spark: SparkSession, path: str) -> DataFrame:
    """Section exchange file, columns checked, numbers typed."""
    rows = read_csv_checked(spark, path, SECTION_COLUMNS)
    return rows.select(*[F.col(c).cast("long").alias(c) for c in SECTION_COLUMNS])


def resource_copy_plan(inventory: DataFrame, listing: DataFrame | None, folder: str = "", path: str = "path") -> DataFrame:
    """Where each version of a resource goes: the newest to ``ns/file``, older ones to
    ``ns/version/file``; ``source_exists`` comes from a listing of paths."""
    rows = inventory.select("namespace", "filename", F.posexplode("versions").alias("_pos", "version"))
    rows = rows.filter(F.coalesce("version", F.lit("")) != "")
    source = F.concat_ws("/", *([F.lit(folder.rstrip("/"))] if folder else []), F.regexp_replace("version", r"\\", "/"), "filename")
    target = F.when(F.col("_pos") == 0, F.concat_ws("/", "namespace", "filename")).otherwise(
        F.concat_ws("/", "namespace", F.regexp_replace("version", r"\\", "/"), "filename")
    )
    plan = rows.select(
        "namespace", "filename", "version", (F.col("_pos") + 1).alias("version_rank"), source.alias("source"), target.alias("target")
    )
    if listing is None:
        return plan.withColumn("source_exists", F.lit(None).cast("boolean"))
    have = listing.select(F.col(path).alias("source"), F.lit(True).alias("_have")).distinct()
    return plan.join(have, "source", "left").withColumn("source_exists", F.coalesce("_have", F.lit(False))).drop("_have")


def directory_listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Paths and sizes under a folder; no content is read."""
    return _binary(spark, path, glob, True).select("path", "length", "file")


