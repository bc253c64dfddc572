"""Scalar functions on names, dates, years and spool text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\r\n\x0b\x0c"

# Country codes recognised as folder names.
COUNTRY_CODES = ["SG", "AU", "BN", "CN", "HK", "ID", "JP", "MY", "PH", "KR", "TH", "TW", "UK", "US", "VN"]
DEFAULT_COUNTRY = "SG"

# Print resource type by the first two characters of the file name ...
RESOURCE_PREFIX = {
    "T1": "Codepage",
    "C0": "CharSet_Raster",
    "C1": "CharSet_Outline",
    "CZ": "CharSet_Outline",
    "X0": "Font_Raster",
    "XZ": "Font_Outline",
    "F1": "Formdef",
    "P1": "PageDef",
    "S1": "PageSegment",
}
# ... and, when the prefix is unknown, by its extension.
RESOURCE_EXTENSION = {
    ".RCP": "Codepage",
    ".RCS": "CharSet",
    ".RFD": "Formdef",
    ".RPD": "PageDef",
    ".RPS": "PageSegment",
}


def strip(col: Column) -> Column:
    """Strip all white space, tabs included (``trim`` only knows blanks)."""
    return F.btrim(col, F.lit(WHITESPACE))


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def base_name(path: Column) -> Column:
    """Last path component; both separators count."""
    return F.regexp_extract(path, r"([^\\/]*)$", 1)


def strip_ext(name: Column, ext: str = "RPT") -> Column:
    """Drop one known extension, whatever its case."""
    return F.regexp_replace(name, rf"(?i)\.{ext}$", "")


def report_year(ts: Column, path: Column | None = None, from_filename: bool = False) -> Column:
    """Year as text: of the timestamp, or ``20`` + the first two characters of the base name."""
    if not from_filename:
        return F.coalesce(F.year(ts).cast("string"), F.lit(""))
    name = base_name(path)
    return F.when(F.length(name) >= 2, F.concat(F.lit("20"), F.substring(name, 1, 2))).otherwise("")


def julian_date(name: Column) -> Column:
    """``YYDDD...`` to ``yyyy-MM-dd``; days beyond the year roll over; bad text gives ''."""
    digits = F.regexp_extract(name, r"^(\d{5})", 1)
    year = F.expr("2000") + F.try_to_number(F.substring(digits, 1, 2), F.lit("99")).cast("int")
    day = F.try_to_number(F.substring(digits, 3, 3), F.lit("999")).cast("int")
    date = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day - 1)
    return F.when(digits != "", F.date_format(date, "yyyy-MM-dd")).otherwise("")


def to_utc(ts: Column, zone: str) -> Column:
    """Wall-clock time of ``zone`` as UTC text, to the second; NULL gives ''.

    Works on the wall clock itself, so the session time zone does not matter.
    """
    moved = F.convert_timezone(F.lit(zone), F.lit("UTC"), ts.cast("timestamp_ntz"))
    return F.coalesce(F.date_format(moved, "yyyy-MM-dd HH:mm:ss"), F.lit(""))


def clean_year(text: Column) -> Column:
    """Digits stay; else the first blank-separated token of exactly four digits; else UNKNOWN."""
    t = strip(text)
    token = F.regexp_extract(t, r"(?:^|\s)(\d{4})(?=\s|$)", 1)
    return (
        F.when(t.rlike(r"^\d+$"), t)
        .when(F.coalesce(token, F.lit("")) != "", token)
        .otherwise("UNKNOWN")
    )


def country_of_name(name: Column) -> Column:
    """Country code when the trimmed folder name is exactly one; else NULL."""
    code = F.upper(strip(name))
    return F.when(code.isin(COUNTRY_CODES), code)


def resource_type(name: Column) -> Column:
    """Resource type by prefix, then by extension, else ``Unknown``."""
    by_prefix = F.try_element_at(literal_map(RESOURCE_PREFIX), F.upper(F.substring(name, 1, 2)))
    ext = F.upper(F.regexp_extract(name, r"[^.](\.[^.]*)$", 1))
    return F.coalesce(by_prefix, F.try_element_at(literal_map(RESOURCE_EXTENSION), ext), F.lit("Unknown"))


def content_crc(content: Column) -> Column:
    return F.crc32(content)


def cut_field(line: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` .. ``end`` (0-based, both included), stripped; '' beyond the line."""
    width = F.greatest(end - start + 1, F.lit(0))
    return strip(F.substring(line, (start + 1).cast("int"), width.cast("int")))


def is_system_group(name: Column) -> Column:
    """Group names that are not all digits belong to the system."""
    return ~strip(F.coalesce(name, F.lit(""))).rlike(r"^\d+$")


def original_id(description: Column) -> Column:
    """``n`` of ``[OriginalID:n]``; NULL when the tag is missing."""
    found = F.regexp_extract(description, r"\[OriginalID:(\d+)\]", 1)
    return F.when(found != "", found)


def tag_original_id(description: Column, name: Column, ident: Column) -> Column:
    """Description with the id tag, added only when missing; an empty one starts from the name."""
    text = F.when(F.coalesce(description, F.lit("")) == "", name).otherwise(description)
    tagged = F.concat(text, F.lit(" [OriginalID:"), ident.cast("string"), F.lit("]"))
    return F.when(text.contains("[OriginalID:"), text).otherwise(tagged)


def display_text(line: Column, asa: Column) -> Column:
    """Line without its control character: a form feed, or one of ``1 0 - +`` and blank in ASA files."""
    drop = (F.substring(line, 1, 1) == "\f") | (asa & F.substring(line, 1, 1).isin("1", "0", "-", "+", " "))
    return F.when(drop, F.substring(line, F.lit(2), F.length(line))).otherwise(line)


def is_page_break(line: Column, asa: Column) -> Column:
    """A form feed in column 1, or ``1`` in column 1 of an ASA file."""
    first = F.substring(line, 1, 1)
    return (first == "\f") | (asa & (first == "1"))


def object_header(page: Column, marker: str = "Object Header Page:") -> Column:
    """``key: value`` lines of an object header page as a map; NULL when the marker is absent.

    Pass the archive vendor's whole marker line to be stricter. A repeated key keeps its last value.
    """
    lines = F.transform(F.split(page, r"\R"), strip)
    lines = F.filter(lines, lambda t: t.contains(":") & ~t.contains(marker))
    pairs = F.transform(
        lines,
        lambda t: F.struct(
            strip(F.substring_index(t, ":", 1)).alias("k"),
            strip(F.regexp_replace(t, r"^[^:]*:", "")).alias("v"),
        ),
    )
    pairs = F.filter(pairs, lambda p: (p["k"] != "") & (p["v"] != ""))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    last_value = lambda k: F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"]
    return F.when(page.contains(marker), F.map_from_arrays(keys, F.transform(keys, last_value)))


def object_format(content: Column, header: Column | None = None) -> Column:
    """Embedded format by magic bytes, else by the header's file extension, else ``.bin``."""
    if header is None:
        named = F.lit(None).cast("string")
    else:
        name = F.try_element_at(header, F.lit("Object File Name"))
        ext = F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))
        named = F.when(ext.isin("pdf", "afp"), F.concat(F.lit("."), ext))
    magic = F.hex(F.substring(content, 1, 4))
    return (
        F.when(magic == "25504446", ".pdf")
        .when(F.substring(magic, 1, 2) == "5A", ".afp")
        .otherwise(F.coalesce(named, F.lit(".bin")))
    )


def format_segments(segments: Column) -> Column:
    """Array of (section_id, start_page, page_count) to ``id#start#count|...``."""
    return F.array_join(
        F.transform(
            segments,
            lambda s: F.concat_ws("#", s["section_id"].cast("string"), s["start_page"].cast("string"), s["page_count"].cast("string")),
        ),
        "|",
    )


def parse_segments(text: Column) -> Column:
    """``a#b#c[#d]|...`` to an array of string arrays; parts with fewer than three fields are dropped."""
    parts = F.transform(F.split(text, r"\|"), lambda p: F.split(p, "#"))
    return F.filter(parts, lambda p: F.size(p) >= 3)
