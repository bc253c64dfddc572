"""Report containers: header, sections, page and object tables, page text, inventory.

Tables are decoded JVM-side from byte offsets. Python is used for one thing, zlib, which
Spark has no function for; only the compressed slices of the wanted pages go there.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from foliant.functions.binary import byte_find, latin1, u16, u32
from foliant.functions.text import object_format, object_header, strip_ext
from foliant.functions.udf import once
from foliant.operators.sets import compare_outputs
from foliant.scale import cut_lineage, ordered_concat, running_sum, small_side
from foliant.sources.listing import task_readable
from foliant.sources.ranges import read_heads, read_lines, read_parts, read_slices, read_tables, write_lines

# Layout of the container.
BASE_OFFSET = 0xF0
PAGE_COUNT_AT, SECTION_COUNT_AT, PACKED_END_AT, OBJECT_COUNT_AT = 0x1D4, 0x1E4, 0x1E8, 0x1F4
PAGE_ROW, OBJECT_ROW, SECTION_ROW = 24, 16, 12
MARKER_BYTES = 13
NEAR_BYTES = 4096
SLACK = 64
PAGES_PER_BLOCK = 512
PAGES_TO_BROADCAST = 1_000_000
PART_BYTES = 64 << 20


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _slice(content: Column, offset: Column, size: Column) -> Column:
    """Bytes at a 0-based offset; empty when the offset lies outside."""
    inside = (offset >= 0) & (offset < F.octet_length(content)) & (size > 0)
    bounded = F.least(size, F.octet_length(content).cast("long"))
    return F.when(inside, F.substring(content, (offset + 1).cast("int"), bounded.cast("int")))


def _rows(table: Column, width: int, count: Column, make: Callable[[Column, Column], Column]) -> Column:
    """Array of structs from fixed-width rows: as many as ``count`` says and the bytes allow."""

    def build(t: Column) -> Column:
        n = F.least(count, F.floor(F.octet_length(t) / width)).cast("int")
        rows = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: make(t, i))
        return F.slice(rows, F.lit(1), F.greatest(n, F.lit(0)))

    return _let(F.coalesce(table, F.lit(b"")), build)


def rpt_header(files: DataFrame) -> DataFrame:
    """One row per file; an invalid file is flagged, not dropped. Of files listed without ``content`` only 512 bytes are read."""
    files = files if "content" in files.columns else read_heads(files)
    head = F.substring("content", 1, 512)
    text = latin1(F.col("_head"))
    line = (
        F.when(F.locate("\x1a", text) > 0, F.substring_index(text, "\x1a", 1))
        .when(F.locate("\x00", text) > 0, F.substring_index(text, "\x00", 1))
        .otherwise(F.substring(text, 1, 192))
    )
    rows = files.select("file", "length", head.alias("_head")).withColumn("_parts", F.split(line, "\t"))
    ids = F.split(F.get("_parts", F.lit(1)), ":", 2)
    both = F.get(ids, F.lit(0)).try_cast("long").isNotNull() & F.get(ids, F.lit(1)).try_cast("long").isNotNull()
    ident = lambda i: F.when(both, F.get(ids, F.lit(i)).try_cast("long")).otherwise(0)
    size = F.octet_length("_head")
    number = lambda at, need: F.when(size >= need, u32(F.col("_head"), at)).otherwise(0)
    return rows.select(
        "file",
        "length",
        F.coalesce(F.substring("_head", 1, 10) == F.lit(b"RPTFILEHDR"), F.lit(False)).alias("valid"),
        ident(0).alias("domain_id"),
        ident(1).alias("species_id"),
        F.coalesce(F.btrim(F.get("_parts", F.lit(2))), F.lit("")).alias("timestamp"),
        number(PAGE_COUNT_AT, 0x1F0).alias("page_count"),
        number(SECTION_COUNT_AT, 0x1F0).alias("section_count"),
        number(PACKED_END_AT, 0x1F0).alias("packed_end"),
        number(OBJECT_COUNT_AT, 0x200).alias("object_count"),
    )


def _with_tables(files: DataFrame) -> DataFrame:
    return files if "content" in files.columns else read_tables(files)


def _valid(files: DataFrame) -> DataFrame:
    return files.filter(F.substring("content", 1, 10) == F.lit(b"RPTFILEHDR"))


def _header_number(at: int, need: int) -> Column:
    return F.when(F.col("length") >= need, u32(F.col("content"), at)).otherwise(0)


def _triplet(t: Column, i: Column) -> Column:
    at = i * SECTION_ROW
    return F.struct(
        (i + 1).alias("position"),
        u32(t, at).alias("section_id"),
        u32(t, at + 4).alias("start_page"),
        u32(t, at + 8).alias("page_count"),
    )


def _kept(rows: Column) -> Column:
    return F.filter(rows, lambda r: (r["start_page"] >= 1) & (r["page_count"] >= 1))


def section_array() -> Column:
    """Sections of a file: near the end of the packed data first, else the whole file is searched."""
    packed_end = _header_number(PACKED_END_AT, 0x1F0)
    declared = _header_number(SECTION_COUNT_AT, 0x1F0)
    # without a declared count, the rows go on to an empty one, the end mark or the end of the file
    count = F.when(declared > 0, declared).otherwise(F.floor(F.col("length") / SECTION_ROW))
    start = F.greatest(packed_end - 16, F.lit(0))
    near_table = _let(
        byte_find(_slice(F.col("content"), start, F.lit(NEAR_BYTES).cast("long")), "SECTIONHDR"),
        lambda found: F.when(
            (packed_end > 0) & (found >= 0), _slice(F.col("content"), start + found + MARKER_BYTES, count * SECTION_ROW)
        ),
    )
    near_table = _let(
        near_table,
        lambda t: F.when((declared > 0) | (byte_find(t, "ENDDATA") < 0), t).otherwise(_slice(t, F.lit(0).cast("long"), byte_find(t, "ENDDATA").cast("long"))),
    )
    near = _let(
        _rows(near_table, SECTION_ROW, count, _triplet),
        lambda rows: _let(
            F.array_position(F.transform(rows, lambda r: (r["section_id"] + r["start_page"] + r["page_count"]) == 0), True),
            lambda stop: _kept(F.when(stop > 0, F.filter(rows, lambda r: r["position"] < stop)).otherwise(rows)),
        ),
    )

    def whole_file(text: Column) -> Column:
        at = F.locate("SECTIONHDR", text) - 1 + MARKER_BYTES
        after = F.locate("ENDDATA", F.substring(text, at + 1, F.length(text))) - 1
        stop = F.when(after >= 0, at + after).otherwise(F.length(text))
        table = F.when(at >= MARKER_BYTES, _slice(F.col("content"), at.cast("long"), (stop - at).cast("long")))
        return _kept(_rows(table, SECTION_ROW, F.lit(2**31 - 1), _triplet))

    return _let(near, lambda n: F.when(F.size(n) > 0, n).otherwise(_let(latin1(F.col("content")), whole_file)))


def rpt_section(files: DataFrame) -> DataFrame:
    """(file, species_id, position, section_id, start_page, page_count) of every section.

    Files listed without ``content`` are read by ranges here and below, see ``sources.ranges``.
    """
    rows = _valid(_with_tables(files)).select("file", section_array().alias("s"), _species(F.col("content")).alias("species_id"))
    return rows.select("file", "species_id", F.explode("s").alias("s")).select("file", "species_id", "s.*")


def _species(content: Column) -> Column:
    text = latin1(F.substring(content, 1, 192))
    found = F.regexp_extract(text, r"^RPTFILEHDR\t\d+:(\d+)", 1)
    return F.coalesce(F.when(found != "", found).try_cast("long"), F.lit(0))


def _table(marker: str, count: Column, width: int) -> Column:
    """Bytes of the rows behind a marker.

    Tables follow the packed data, so the bytes behind its declared end are searched first; the
    whole file only when the marker is not there, and nothing at all when no rows are declared.
    """
    content = F.col("content")
    start = F.greatest(_header_number(PACKED_END_AT, 0x1F0) - 16, F.lit(0))
    rows = lambda at: F.when(at >= 0, _slice(content, (at + MARKER_BYTES).cast("long"), count * width))
    found = _let(
        byte_find(_slice(content, start, F.col("length").cast("long")), marker),
        lambda near: F.when(near >= 0, rows(start + near)).otherwise(_let(byte_find(content, marker), rows)),
    )
    return F.when(count > 0, found)


def _page_table() -> Column:
    return _table("PAGETBLHDR", _header_number(PAGE_COUNT_AT, 0x1F0), PAGE_ROW)


def _page(t: Column, i: Column) -> Column:
    at = i * PAGE_ROW
    return F.struct(
        (i + 1).cast("long").alias("page"),
        (u32(t, at) + BASE_OFFSET).alias("offset"),
        u16(t, at + 8).alias("line_width"),
        u16(t, at + 10).alias("lines_per_page"),
        u32(t, at + 12).alias("uncompressed_size"),
        u32(t, at + 16).alias("compressed_size"),
    )


def rpt_page(files: DataFrame) -> DataFrame:
    """Page table rows, pages numbered from 1."""
    pages = _rows(_page_table(), PAGE_ROW, _header_number(PAGE_COUNT_AT, 0x1F0), _page)
    return _valid(_with_tables(files)).select("file", F.explode(pages).alias("p")).select("file", "p.*")


def _object_table() -> Column:
    return _table("BPAGETBLHDR", _header_number(OBJECT_COUNT_AT, 0x200), OBJECT_ROW)


def _object(t: Column, i: Column) -> Column:
    at = i * OBJECT_ROW
    return F.struct(
        (i + 1).cast("long").alias("object_no"),
        (u32(t, at) + BASE_OFFSET).alias("offset"),
        u32(t, at + 8).alias("uncompressed_size"),
        u32(t, at + 12).alias("compressed_size"),
    )


def _objects() -> Column:
    return _rows(_object_table(), OBJECT_ROW, _header_number(OBJECT_COUNT_AT, 0x200), _object)


def rpt_object(files: DataFrame) -> DataFrame:
    """Embedded object table rows."""
    return _valid(_with_tables(files)).select("file", F.explode(_objects()).alias("o")).select("file", "o.*")


def unpack(packed: bytes | None, size: int) -> bytes | None:
    if packed is None or size is None or len(packed) < size:
        return None
    for candidate in (packed[: int(size)], packed):
        try:
            return zlib.decompress(candidate)
        except zlib.error:
            continue
    return None


@F.pandas_udf(BinaryType())
def inflate(packed: pd.Series, size: pd.Series) -> pd.Series:
    """Inflate one zlib stream per row; a stream that fails is retried with the slack bytes, then NULL."""
    return pd.Series([unpack(p, s) for p, s in zip(packed, size)], dtype=object)


inflate = once(inflate)


@F.pandas_udf(BinaryType())
def inflate_all(packed: pd.Series) -> pd.Series:
    """Inflate and join the streams of one document in order; broken streams are left out."""
    def document(streams):
        parts = [unpack(s["packed"], s["size"]) for s in streams] if streams is not None else []
        return b"".join(p for p in parts if p is not None)

    return packed.map(document)


inflate_all = once(inflate_all)


def page_text(files: DataFrame, pages: DataFrame | None = None, encoding: str = "UTF-8") -> DataFrame:
    """(file, page, status, text) of the wanted pages; all pages without ``pages`` (file, page).

    The wanted pages of a file meet the file as one list, so files nobody wants are dropped by
    the join and their content is never inflated, and a wanted page is cut out of the file
    by its row in the page table without touching the others. Up to a million wanted pages
    (8 MB) are broadcast, so file contents do not move; beyond that both sides shuffle. ``status``: ``ok``,
    ``out_of_range`` (no such page, or its bytes end beyond the file) or ``inflate_error``.
    """
    lists = None
    if pages is not None:
        # distinct page numbers of one file: never more than the file has pages
        lists = pages.select("file", F.col("page").cast("long").alias("page")).distinct().groupBy("file").agg(
            F.collect_list("page").alias("_want")
        )
        lists = small_side(lists, PAGES_TO_BROADCAST, F.size("_want"))
    ranged = "content" not in files.columns
    if ranged:
        # the listing is pruned before any file is opened
        files = read_tables(files if lists is None else files.join(lists.select("file"), "file", "left_semi"))
    table = _valid(files).select("file", "content", "length", *(["path"] if ranged else []), _page_table().alias("_t"))
    if lists is None:
        count = F.floor(F.octet_length(F.coalesce("_t", F.lit(b""))) / PAGE_ROW).cast("int")
        wanted = table.withColumn("_want", F.when(count > 0, F.sequence(F.lit(1), count)).cast("array<long>"))
    else:
        wanted = table.join(lists, "file")

    def cut(page: Column) -> Column:
        row = (page - 1) * PAGE_ROW
        known = (page >= 1) & (page * PAGE_ROW <= F.octet_length(F.coalesce(F.col("_t"), F.lit(b""))))
        offset = F.when(known, u32(F.col("_t"), row) + BASE_OFFSET)
        size = F.when(known, u32(F.col("_t"), row + 16))
        fits = known & (offset + size <= F.col("length"))
        if ranged:
            where = [F.when(fits, offset).alias("offset"), F.when(fits, F.least(size + SLACK, F.col("length") - offset)).alias("span")]
        else:
            where = [F.when(fits, _slice(F.col("content"), offset, size + SLACK)).alias("packed")]
        return F.struct(page.alias("page"), size.alias("size"), *where)

    slices = wanted.select("file", *(["path"] if ranged else []), F.explode(F.transform("_want", cut)).alias("s")).select("file", *(["path"] if ranged else []), "s.*")
    slices = read_slices(slices) if ranged else slices
    raw = slices.withColumn("_raw", inflate(F.col("packed"), F.col("size")))
    status = F.when(F.col("packed").isNull(), "out_of_range").when(F.col("_raw").isNull(), "inflate_error").otherwise("ok")
    return raw.select("file", "page", status.alias("status"), F.decode(F.col("_raw"), encoding).alias("text"))


def _first_place(table: Column, width: int, size_at: int) -> Column:
    """(offset, size) of a table's first row, NULL without one."""
    return _let(
        table,
        lambda t: F.when(
            F.octet_length(t) >= width, F.struct((u32(t, F.lit(0)) + BASE_OFFSET).alias("offset"), u32(t, F.lit(size_at)).alias("size"))
        ),
    )


def _cut_parts(rows: DataFrame) -> DataFrame:
    """Rows whose ``_parts``, places (offset, size) in their file, became (packed, size).

    With ``content`` the bytes are cut out of it; of a listed file only these places are read.
    """
    if "path" not in rows.columns:
        cut = lambda p: F.struct(_slice(F.col("content"), p["offset"], p["size"]).alias("packed"), p["size"].alias("size"))
        return rows.withColumn("_parts", F.transform("_parts", cut)).drop("content", "length")

    def place(p: Column) -> Column:
        inside = (p["offset"] >= 0) & (p["offset"] < F.col("length")) & (p["size"] > 0)
        span = F.least(p["size"], F.col("length") - p["offset"])
        return F.struct(F.when(inside, p["offset"]).alias("offset"), F.when(inside, span).alias("span"), p["size"].alias("size"))

    return read_parts(rows.withColumn("_parts", F.transform("_parts", place)).drop("content", "length"), "_parts").drop("path", "bytes_read")


def _listed(files: DataFrame) -> list[str]:
    return [] if "content" in files.columns else ["path"]


def rpt_document(files: DataFrame) -> DataFrame:
    """Embedded objects of a file joined in order to one document with name and format.

    The slices stay in the file's own row, so there is no shuffle. Of listed files the header and the tables are read
    first, then all objects and the first page, and nothing of files without objects.
    """
    places = F.transform(_objects(), lambda o: F.struct(o["offset"].alias("offset"), o["compressed_size"].alias("size")))
    rows = _valid(_with_tables(files)).select("file", "content", "length", *_listed(files), places.alias("_o"))
    first = _first_place(_page_table(), PAGE_ROW, 16)
    rows = _cut_parts(rows.filter(F.size("_o") > 0).withColumn("_parts", F.concat(F.array(first), "_o")).drop("_o"))
    page = F.element_at("_parts", 1)
    rows = rows.select("file", inflate_all(F.slice("_parts", F.lit(2), F.size("_parts"))).alias("document"), inflate(page["packed"], page["size"]).alias("_page"))
    rows = rows.withColumn("_hdr", object_header(latin1(F.col("_page"))))
    rows = rows.withColumn("extension", object_format(F.col("document"), F.col("_hdr")))
    named = F.try_element_at(F.col("_hdr"), F.lit("Object File Name"))
    stem = strip_ext(F.col("file"))
    name = F.when(F.coalesce(named, F.lit("")) != "", named).otherwise(F.concat(stem, F.lit("_binary"), F.col("extension")))
    label = F.when(F.col("extension") == ".pdf", "PDF").when(F.col("extension") == ".afp", "AFP").otherwise("Binary")
    return rows.select("file", name.alias("document_name"), label.alias("format"), "document")


def rpt_inventory(files: DataFrame) -> DataFrame:
    """RPT_FILE, REPORT_SPECIES_ID, SECTION_COUNT, PAGES, BINARY (PDF, AFP or '') of the valid files.

    Of listed files the header, the tables and the first object are read.
    """
    rows = _valid(_with_tables(files)).filter(F.col("length") >= 0x200).select(
        F.col("file").alias("RPT_FILE"),
        _species(F.col("content")).alias("REPORT_SPECIES_ID"),
        _header_number(SECTION_COUNT_AT, 0x1F0).alias("SECTION_COUNT"),
        _header_number(PAGE_COUNT_AT, 0x1F0).alias("PAGES"),
        "content",
        "length",
        *_listed(files),
        F.array(_first_place(_object_table(), OBJECT_ROW, 12)).alias("_parts"),
    )
    rows = _cut_parts(rows)
    first = F.element_at("_parts", 1)
    rows = rows.withColumn("_raw", inflate(first["packed"], first["size"]))
    length = F.octet_length("_raw")
    field = F.conv(F.hex(F.substring("_raw", 2, 2)), 16, 10).cast("long")
    magic = F.hex(F.substring("_raw", 1, 4))
    binary = (
        F.when(F.coalesce(length, F.lit(0)) < 8, "")
        .when(magic == "25504446", "PDF")
        .when((F.substring(magic, 1, 2) == "5A") & field.between(8, length), "AFP")
        .otherwise("")
    )
    return rows.select("RPT_FILE", "REPORT_SPECIES_ID", "SECTION_COUNT", "PAGES", binary.alias("BINARY"))


def report_text(pages: DataFrame, mode: str = "page", objects: DataFrame | None = None, marker: str = "Object Header Page:") -> DataFrame:
    """Page texts one by one, or one row per report joined by form feed and newline.

    Per page, an object header on page 1 is left out when the file has embedded objects
    (``objects``: rows with ``file``); the joined form keeps it.
    """
    good = pages.filter(F.col("status") == "ok")
    if mode == "concat":
        return ordered_concat(good, ["file"], ["page"], F.col("text"), "\f\n", "text", F.floor(F.col("page") / PAGES_PER_BLOCK))
    if mode != "page":
        raise ValueError(f"unknown mode: {mode}")
    if objects is None:
        return good.select("file", "page", "text")
    has = objects.select("file").distinct().withColumn("_has", F.lit(True))
    header = (F.col("page") == 1) & F.coalesce("_has", F.lit(False)) & F.col("text").contains(marker)
    return good.join(has, "file", "left").filter(~header).select("file", "page", "text")


def report_parts(pages: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(file, part, page, byte_offset, is_last, text): where each page stands in its report's text file and in which part of it.

    Offsets come from the running sum over blocks of pages, made over sizes alone, which are kept as a checkpoint; texts meet them once. A part begins with the first page that starts in its
    ``part_bytes``, so it holds that many bytes and the rest of one page, however long the report is; a part in which
    no page starts does not exist.
    """
    good = pages.filter(F.col("status") == "ok").select("file", "page", "text")
    sizes = cut_lineage(good.select("file", "page", (F.octet_length("text") + len("\f\n")).cast("long").alias("_size")))
    placed = running_sum(sizes, ["file"], ["page"], F.col("_size"), "_end", F.floor(F.col("page") / PAGES_PER_BLOCK))
    last = sizes.groupBy("file").agg(F.max("page").alias("_last"))
    offset = F.col("_end") - F.col("_size")
    where = placed.join(last, "file").select("file", F.floor(offset / part_bytes).alias("part"), "page", offset.alias("byte_offset"), (F.col("page") == F.col("_last")).alias("is_last"))
    return good.join(where, ["file", "page"]).select("file", "part", "page", "byte_offset", "is_last", "text")


def write_report_text(pages: DataFrame, path: str, part_bytes: int = PART_BYTES) -> None:
    """Every report as text below ``path``: pages joined by form feed and newline, one newline at the end.

    ``file=<name>/part=<number>`` holds one text file; the text files of a report in the order of their part numbers,
    one after another, are its text, of any size. Each part is sorted and written by one task, which no other part
    waits for, so neither a cell nor a task ever holds a whole report; nor does the driver commit or list the files.
    """
    mark = F.when(F.col("is_last"), "").otherwise("\f")
    rows = report_parts(pages, part_bytes).select("file", "part", "page", F.concat("text", mark).alias("value"))
    dealt = rows.repartition("file", "part").sortWithinPartitions("file", "part", "page")
    if task_readable(pages.sparkSession, path):
        write_lines(dealt, path, ["file", "part"])
    else:
        dealt.select("value", "file", "part").write.mode("overwrite").partitionBy("file", "part").text(path)


def read_report_parts(spark: SparkSession, path: str) -> DataFrame:
    """(file, part, text) of written reports, one row for each part."""
    rows = read_lines(spark, path, ["file", "part"])
    if rows is None:
        rows = spark.read.schema("value string, file string, part long").text(path, wholetext=True)
    return rows.select("file", F.col("part").cast("long").alias("part"), F.col("value").alias("text"))


def page_metrics(pages: DataFrame, text: str = "text") -> DataFrame:
    """Line width (longest line), line count and byte size of a page."""
    lines = F.split(F.col(text), r"\r?\n")
    rest = [c for c in pages.columns if c != text]
    return pages.select(
        *rest,
        F.array_max(F.transform(lines, F.length)).alias("line_width"),
        F.size(lines).alias("line_count"),
        F.octet_length(text).alias("size"),
    )


def readback(parsed: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that differ between what was written and what is read back."""
    return compare_outputs(expected.select(*parsed.columns), parsed, keys)
