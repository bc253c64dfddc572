"""Indexed search to field records: the composition over catalogue, index files and report files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import base_name, strip
from foliant.operators.containers import page_text, rpt_section
from foliant.operators.filters import filter_records, on_day, pages_in_sections
from foliant.operators.mapindex import found_pages, map_entry
from foliant.operators.sets import intersect_pages
from foliant.operators.spool import classify_lines, extract_fields
from foliant.operators.windows import first_per_key, latest_per_key
from foliant.scale import cut_lineage, small_side
from foliant.sources.schemas import INSTANCE_KEY


def find_instances(tables: Mapping[str, DataFrame], report: str, day: str | None = None) -> DataFrame:
    """Latest instance (of one day) per species whose name contains ``report``, with its file names."""
    species = ["DOMAIN_ID", "REPORT_SPECIES_ID"]
    named = tables["REPORT_SPECIES_NAME"].filter(F.col("NAME").contains(report)).select(*species).distinct()
    rows = tables["REPORT_INSTANCE"].select(*INSTANCE_KEY, "STRUCTURE_DEF_ID")
    if day is not None:
        rows = on_day(rows, "AS_OF_TIMESTAMP", day)
    latest = latest_per_key(rows.join(named, species, "left_semi"), species, ["AS_OF_TIMESTAMP", "STRUCTURE_DEF_ID"])
    index = tables["SST_STORAGE"].join(tables["MAPFILE"], "MAP_FILE_ID").select(
        *INSTANCE_KEY, base_name(F.rtrim("FILENAME")).alias("map_file")
    )
    report_files = tables["RPTFILE_INSTANCE"].join(tables["RPTFILE"], "RPT_FILE_ID").select(
        *INSTANCE_KEY, base_name(F.rtrim("FILENAME")).alias("rpt_file")
    )
    return cut_lineage(latest.join(index, INSTANCE_KEY).join(report_files, INSTANCE_KEY))


def search_and_extract(
    tables: Mapping[str, DataFrame],
    rpt_files: DataFrame,
    map_files: DataFrame,
    report: str,
    field: str,
    value: str,
    day: str | None = None,
    prefix: bool = True,
    sections: Sequence[int] | None = None,
    detail_only: bool = False,
    lines: Sequence[int] | None = None,
) -> DataFrame:
    """Field records of the pages on which ``field`` has ``value``.

    Instance, field and index entries are narrowed down first; a report file is joined only
    when one of its pages was found, and only found pages are inflated. Report files may be a
    listing (``sources.ranges.list_files``), of which only tables and found pages are read.
    """
    found = find_instances(tables, report, day)
    named = tables["FIELD"].filter(F.upper(strip(F.col("NAME"))) == field.strip().upper())
    target = first_per_key(named.select("STRUCTURE_DEF_ID", "LINE_ID", "FIELD_ID"), ["STRUCTURE_DEF_ID"], ["LINE_ID", "FIELD_ID"])
    goal = (
        found.join(target, "STRUCTURE_DEF_ID")
        .select(F.col("map_file").alias("file"), F.col("LINE_ID").alias("line_id"), F.col("FIELD_ID").alias("field_id"))
        .distinct()
        .groupBy("file")
        .agg(F.collect_list(F.struct("line_id", "field_id")).alias("want"))
    )
    wanted_maps = map_files.select("file", "content").join(small_side(goal), "file")
    pages = found_pages(map_entry(wanted_maps, value=value, prefix=prefix, resolve=True))
    owner = found.select(F.col("map_file").alias("_map"), F.col("rpt_file").alias("file"), "STRUCTURE_DEF_ID").distinct()
    pages = pages.withColumnRenamed("file", "_map").join(owner, "_map").select("file", "page", "STRUCTURE_DEF_ID").distinct()
    # the pages are used three times below; kept, so that the index files are read once
    pages = cut_lineage(pages)
    if sections is not None:
        wanted_files = rpt_files.join(small_side(pages.select("file").distinct()), "file", "left_semi")
        chosen, _ = pages_in_sections(pages, rpt_section(wanted_files), sections)
        pages = pages.join(intersect_pages(pages, chosen), ["file", "page"], "left_semi")
    texts = page_text(rpt_files, pages).filter(F.col("status") == "ok").join(pages, ["file", "page"])
    records = extract_fields(classify_lines(texts, tables["LINE"]), tables["FIELD"], tables["LINE"])
    if detail_only:
        detail = target.select("STRUCTURE_DEF_ID", "LINE_ID")
        return records.join(detail, ["STRUCTURE_DEF_ID", "LINE_ID"], "left_semi")
    return filter_records(records, lines=lines)
