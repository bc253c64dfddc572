"""Row selection: time windows, resume points, name matches, page ranges and sections."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _ntz(value: dt.date | dt.datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def year_window(df: DataFrame, ts: str, start: int, end: int | None = None) -> DataFrame:
    """Half-open window from ``start``-01-01 to the end of ``end``; plain literals, so it reaches the scan."""
    out = df.filter(F.col(ts) >= _ntz(f"{start:04d}-01-01"))
    return out if end is None else out.filter(F.col(ts) < _ntz(f"{end + 1:04d}-01-01"))


def date_window(
    df: DataFrame, ts: str, lo: str | None = None, hi: str | None = None, end_of_day: bool = False
) -> DataFrame:
    """Both ends optional. ``hi`` means its midnight, so later times of that day stay out,
    unless ``end_of_day`` asks for the whole last day."""
    out = df
    if lo is not None:
        out = out.filter(F.col(ts) >= _ntz(lo))
    if hi is not None:
        if end_of_day:
            out = out.filter(F.col(ts) < _ntz(dt.date.fromisoformat(hi[:10]) + dt.timedelta(days=1)))
        else:
            out = out.filter(F.col(ts) <= _ntz(hi))
    return out


def on_day(df: DataFrame, ts: str, day: str) -> DataFrame:
    """Rows of one calendar day, written as a range so that the scan can skip files."""
    first = dt.date.fromisoformat(day)
    return df.filter((F.col(ts) >= _ntz(first)) & (F.col(ts) < _ntz(first + dt.timedelta(days=1))))


def pending(df: DataFrame, ident: str, last_id: int | None) -> DataFrame:
    """Rows after the last processed id."""
    return df if last_id is None else df.filter(F.col(ident) > last_id)


def active_species(
    df: DataFrame, start: int = 0, n: int | None = None, ident: str = "REPORT_SPECIES_ID", in_use: str = "IN_USE"
) -> DataFrame:
    """Species in use from a start id; the first ``n`` of them by id when ``n`` is given."""
    out = df.filter((F.col(ident) >= start) & (F.col(in_use) == 1))
    return out if n is None else out.orderBy(ident).limit(n)


def only_names(df: DataFrame, names: Sequence[str], col: str = "NAME") -> DataFrame:
    return df.filter(F.col(col).isin(list(names)))


def name_contains(df: DataFrame, text: str, col: str = "NAME") -> DataFrame:
    """Literal substring; ``%`` and ``_`` have no special meaning."""
    return df.filter(F.col(col).contains(text))


def name_prefix(df: DataFrame, text: str, col: str = "NAME") -> DataFrame:
    return df.filter(F.col(col).startswith(text))


def drop_sentinels(
    df: DataFrame, species: str = "REPORT_SPECIES_ID", value: str | None = None, positive_only: bool = False
) -> DataFrame:
    """Drop species 0 (or every species not above 0), and rows without a value."""
    out = df.filter(F.col(species) > 0 if positive_only else F.col(species) != 0)
    return out if value is None else out.filter(F.col(value).isNotNull())


def select_fields(
    df: DataFrame, indexed: bool = False, significant: bool = False, patterns: Sequence[str] = (), name: str = "NAME"
) -> DataFrame:
    """Field rows by flag and by any of several LIKE patterns."""
    out = df
    if indexed:
        out = out.filter(F.col("IS_INDEXED") == 1)
    if significant:
        out = out.filter(F.col("IS_SIGNIFICANT") == 1)
    if patterns:
        any_like = F.lit(False)
        for p in patterns:
            any_like = any_like | F.col(name).like(p)
        out = out.filter(any_like)
    return out


def filter_records(
    df: DataFrame, detail_line: int | None = None, lines: Sequence[int] | None = None, line: str = "LINE_ID"
) -> DataFrame:
    """Keep the searched field's line, or a list of lines; the first wins if both are given."""
    if detail_line is not None:
        return df.filter(F.col(line) == detail_line)
    return df if lines is None else df.filter(F.col(line).isin(list(lines)))


def versions_from_year(df: DataFrame, year: int | None, version: str = "version") -> DataFrame:
    if year is None:
        return df
    return df.filter(F.substring(F.col(version), 1, 4).cast("int") >= year)


@dataclass(frozen=True)
class Selection:
    """What a selection rule asks for: everything, page ranges, or section ids in request order."""

    kind: str
    ranges: list[tuple[int, int]] = field(default_factory=list)
    sections: list[int] = field(default_factory=list)


def parse_selection(rule: str) -> Selection:
    """``all`` | ``5`` | ``1-5,10-20`` | ``pages:...`` | ``section:...`` | ``sections:...``.

    Bare numbers always mean pages; any other type is an error.
    """
    text = rule.strip()
    if text.lower() in ("", "all"):
        return Selection("all")
    kind, sep, body = text.partition(":")
    kind = kind.strip().lower() if sep else "pages"
    items = [i.strip() for i in (body if sep else text).split(",") if i.strip()]
    if kind in ("section", "sections"):
        return Selection("sections", sections=[int(i) for i in items])
    if kind not in ("page", "pages"):
        raise ValueError(f"unknown selection type: {kind}")
    ranges = []
    for item in items:
        bounds = re.fullmatch(r"(\d+)(?:\s*-\s*(\d+))?", item)
        if bounds is None:
            raise ValueError(f"bad page range: {item}")
        lo = int(bounds.group(1))
        ranges.append((lo, int(bounds.group(2) or lo)))
    return Selection("pages", ranges=ranges)


def ranges_of_rule(rule: Column) -> Column:
    """Page rules kept in a column (``1-5,10``) as array of (lo, hi), for one rule per row."""
    body = F.regexp_replace(rule, r"^\s*pages?\s*:", "")
    items = F.filter(F.transform(F.split(body, ","), lambda i: F.btrim(i)), lambda i: i.rlike(r"^\d+(\s*-\s*\d+)?$"))
    return F.transform(
        items,
        lambda i: F.struct(
            F.regexp_extract(i, r"^(\d+)", 1).cast("long").alias("lo"),
            F.regexp_extract(i, r"(\d+)$", 1).cast("long").alias("hi"),
        ),
    )


def ranges_table(spark: SparkSession, ranges: Sequence[tuple[int, int]]) -> DataFrame:
    return spark.createDataFrame([(int(a), int(b)) for a, b in ranges], "lo long, hi long")


def pages_in_ranges(pages: DataFrame, ranges: Sequence[tuple[int, int]], page: str = "page") -> DataFrame:
    """Pages inside any of the user's inclusive ranges, each once.

    The ranges of one rule are a short driver-side list: merged, they become one filter
    that runs inside the scan stage, with no join and no shuffle.
    """
    merged: list[list[int]] = []
    for lo, hi in sorted((max(1, int(a)), int(b)) for a, b in ranges):
        if merged and lo <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], hi)
        elif hi >= lo:
            merged.append([lo, hi])
    inside = F.lit(False)
    for lo, hi in merged:
        inside = inside | F.col(page).between(lo, hi)
    return pages.filter(inside)


def expand_ranges(df: DataFrame, lo: str = "lo", hi: str = "hi", max_page: str = "max_page", page: str = "page") -> DataFrame:
    """Clamp to ``[1, max_page]``, swap reversed ends, one row per page."""
    top = F.col(max_page)
    clamp = lambda c: F.least(F.greatest(F.col(c), F.lit(1)), top)
    first, last = F.least(clamp(lo), clamp(hi)), F.greatest(clamp(lo), clamp(hi))
    return df.filter(top >= 1).withColumn(page, F.explode(F.sequence(first, last)))


def pages_in_named_ranges(
    pages: DataFrame,
    ranges: DataFrame,
    keys: Sequence[str] = ("file",),
    page: str = "page",
    start: str = "start_page",
    count: str = "page_count",
) -> DataFrame:
    """Pages inside any (start, count) range of the same file, each once.

    A range is expanded to its page numbers, so the match is an equi semi-join on
    (file, page): its cost is pages + covered pages, where a range condition would test
    every page of a file against every range of it.
    """
    covered = _covered(pages, ranges, keys, start, count, page).select(*keys, page).distinct()
    return pages.join(covered, [*keys, page], "left_semi")


def _covered(pages: DataFrame, ranges: DataFrame, keys: Sequence[str], start: str, count: str, page: str) -> DataFrame:
    """Ranges as page numbers, cut at the last page of their file, so a damaged count cannot blow up."""
    top = pages.groupBy(*keys).agg(F.max(page).alias("_top"))
    valid = ranges.filter((F.col(start) >= 1) & (F.col(count) >= 1)).join(top, list(keys))
    last = F.least(F.col(start).cast("long") + F.col(count) - 1, F.col("_top").cast("long"))
    return (
        valid.filter(F.col(start) <= F.col("_top"))
        .withColumn(page, F.explode(F.sequence(F.col(start).cast("long"), last)))
        .drop("_top")
    )


def pages_in_sections(
    pages: DataFrame,
    sections: DataFrame,
    ids: Sequence[int],
    keys: Sequence[str] = ("file",),
    page: str = "page",
    section: str = "section_id",
    start: str = "start_page",
    count: str = "page_count",
    position: str = "position",
    first_definition: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Pages of the requested sections with their request position, and the ids no file defines.

    A section defined twice in a file: the last definition counts when several ids are
    requested, the first when only one is. ``position`` of the definition is taken from
    the ``position`` column. Order the result by (request_pos, page).
    """
    wanted = list(dict.fromkeys(int(i) for i in ids))
    first = len(wanted) == 1 if first_definition is None else first_definition
    pick = F.min_by if first else F.max_by
    chosen = (
        sections.filter(F.col(section).isin(wanted))
        .groupBy(*keys, section)
        .agg(pick(F.struct(start, count), F.col(position)).alias("_d"))
        .select(*keys, section, F.col("_d")[start].alias(start), F.col("_d")[count].alias(count))
    )
    order = F.array_position(F.array(*[F.lit(i) for i in wanted]).cast("array<long>"), F.col(section).cast("long"))
    covered = _covered(pages, chosen, keys, start, count, page).withColumn("request_pos", order)
    selected = pages.join(covered.select(*keys, section, page, "request_pos"), [*keys, page])
    spark = pages.sparkSession
    asked = spark.createDataFrame([(i, p + 1) for p, i in enumerate(wanted)], f"{section} long, request_pos long")
    found = sections.select(F.col(section).cast("long").alias(section)).filter(F.col(section).isin(wanted)).distinct()
    return selected, asked.join(found, section, "left_anti")


def pages_with_section(
    pages: DataFrame,
    sections: DataFrame,
    keys: Sequence[str] = ("file",),
    page: str = "page",
    section: str = "section_id",
    start: str = "start_page",
    count: str = "page_count",
) -> DataFrame:
    """Every (page, section) pair where the section covers the page; overlaps give several rows."""
    covered = _covered(pages, sections, keys, start, count, page)
    return pages.join(covered.select(*keys, page, section), [*keys, page])


def head_tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First and last ``n`` rows with the total; a row that is in both ends appears once."""
    first = df.orderBy(*order).limit(n).withColumn("part", F.lit("first"))
    last = df.orderBy(*[F.desc(c) for c in order]).limit(n).withColumn("part", F.lit("last"))
    total = df.agg(F.count("*")).scalar()
    both = first.unionByName(last).withColumn("total", total)
    # at most 2n rows reach this window
    seen = Window.partitionBy(*df.columns).orderBy("part")
    return both.withColumn("_r", F.row_number().over(seen)).filter("_r = 1").drop("_r")
