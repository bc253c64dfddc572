"""Report instances and the catalogue joins around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import (
    base_name,
    julian_date,
    report_year,
    strip,
    strip_ext,
    to_utc,
)
from foliant.operators.filters import year_window
from foliant.operators.windows import first_per_key, latest_per_key
from foliant.scale import ordered_concat, small_side
from foliant.sources.schemas import INSTANCE_KEY

SEGMENTS_PER_BLOCK = 4096
SIGNATURES_PER_BLOCK = 100_000


def instances(
    ri: DataFrame,
    rfi: DataFrame,
    rf: DataFrame,
    start: int,
    end: int | None = None,
    sst: DataFrame | None = None,
    mf: DataFrame | None = None,
) -> DataFrame:
    """Report instances of a year window with their report file, and their index file when
    ``sst`` and ``mf`` are given. All species in one job; instances without a file stay."""
    window = year_window(ri, "AS_OF_TIMESTAMP", start, end).select(*INSTANCE_KEY)
    # names join their links first, inside the same window: the instances shuffle once, by their key
    linked = lambda link, ident, files, name: (
        year_window(link, "AS_OF_TIMESTAMP", start, end)
        .select(*INSTANCE_KEY, ident)
        .join(files.select(ident, F.rtrim("FILENAME").alias(name)), ident, "left")
    )
    out = window.join(linked(rfi, "RPT_FILE_ID", rf, "FILENAME"), INSTANCE_KEY, "left")
    if sst is not None and mf is not None:
        out = out.join(linked(sst, "MAP_FILE_ID", mf, "MAP_FILENAME"), INSTANCE_KEY, "left")
    return out


def segments_string(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``name#number#start#pages|...`` in segment order per instance; no segments give ``##0#``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    entry = F.concat_ws(
        "#", text("NAME"), text("SEGMENT_NUMBER"), F.coalesce(F.col("START_PAGE_NUMBER"), F.lit(0)).cast("string"),
        text("NUMBER_OF_PAGES"),
    )
    rows = rows.withColumn("_entry", entry)
    block = F.floor(F.coalesce(F.col("SEGMENT_NUMBER"), F.lit(0)) / SEGMENTS_PER_BLOCK)
    return ordered_concat(rows, keys, ["SEGMENT_NUMBER", "_entry"], F.col("_entry"), "|", "segments", block)


def instances_with_segments(
    ri: DataFrame,
    rfi: DataFrame,
    rf: DataFrame,
    ris: DataFrame,
    section: DataFrame,
    sst: DataFrame,
    mf: DataFrame,
    start: int,
    end: int | None = None,
) -> DataFrame:
    """Instances with report file, index file and the ordered segment string."""
    base = instances(ri, rfi, rf, start, end, sst, mf)
    segs = year_window(ris, "AS_OF_TIMESTAMP", start, end).select(*INSTANCE_KEY, "SEGMENT_NUMBER", "START_PAGE_NUMBER", "NUMBER_OF_PAGES")
    names = section.select(
        "DOMAIN_ID", "REPORT_SPECIES_ID", F.col("SECTION_ID").alias("SEGMENT_NUMBER"), F.rtrim("NAME").alias("NAME")
    )
    named = segs.join(names, ["DOMAIN_ID", "REPORT_SPECIES_ID", "SEGMENT_NUMBER"], "left")
    # one string per instance before the files are joined, on the key that both sides are shuffled by
    strings = segments_string(named, INSTANCE_KEY)
    rows = base.join(strings, INSTANCE_KEY, "left").withColumn("segments", F.coalesce("segments", F.lit("##0#")))
    return rows.select("REPORT_SPECIES_ID", "AS_OF_TIMESTAMP", "RPT_FILE_ID", "FILENAME", "MAP_FILENAME", "segments")


def enrich_instances(
    df: DataFrame, species: DataFrame, zone: str = "Asia/Singapore", year_from_filename: bool = False
) -> DataFrame:
    """The instance exchange columns: base name, year, report date, UTC, country."""
    names = species.select("REPORT_SPECIES_ID", "REPORT_SPECIES_NAME", F.col("COUNTRY_CODE").alias("COUNTRY"))
    stem = strip_ext(base_name(F.coalesce(F.col("FILENAME"), F.lit(""))))
    return df.join(names, "REPORT_SPECIES_ID").select(
        "REPORT_SPECIES_ID",
        "REPORT_SPECIES_NAME",
        stem.alias("FILENAME"),
        F.col("FILENAME").alias("RPT_FILENAME"),
        "COUNTRY",
        report_year(F.col("AS_OF_TIMESTAMP"), F.coalesce(F.col("FILENAME"), F.lit("")), year_from_filename).alias("YEAR"),
        julian_date(stem).alias("REPORT_DATE"),
        "AS_OF_TIMESTAMP",
        to_utc(F.col("AS_OF_TIMESTAMP"), zone).alias("UTC"),
        F.col("RPT_FILE_ID").alias("REPORT_FILE_ID"),
    )


def map_catalogue(mf: DataFrame, sst: DataFrame) -> DataFrame:
    """Index file with the instance it belongs to."""
    return mf.select("MAP_FILE_ID", F.rtrim("FILENAME").alias("FILENAME")).join(
        sst.select("MAP_FILE_ID", *INSTANCE_KEY), "MAP_FILE_ID"
    )


def map_segments_db(mf: DataFrame, sst: DataFrame, ris: DataFrame) -> DataFrame:
    """Index file with the catalogue's segments of its instance (three key columns, no reprocess flag)."""
    key = INSTANCE_KEY[:3]
    return map_catalogue(mf, sst).join(
        ris.select(*key, "SEGMENT_NUMBER", "START_PAGE_NUMBER", "NUMBER_OF_PAGES"), key
    )


def with_segment_count(map_files: DataFrame, ris: DataFrame) -> DataFrame:
    """Segment count per row by instance, 0 when there is none."""
    key = INSTANCE_KEY[:3]
    counts = ris.groupBy(*key).agg(F.count("*").alias("segment_count"))
    return map_files.join(counts, key, "left").withColumn(
        "segment_count", F.coalesce(F.col("segment_count"), F.lit(0)).cast("long")
    )


def species_names(rsn: DataFrame) -> DataFrame:
    """Display name (slot 0, else ``UNKNOWN_<id>``) and name (slot 1 if the row exists, even when
    empty, else the display name)."""
    slot = lambda n: F.max(F.when(F.col("ITEM_ID") == n, F.rtrim("NAME")))
    return (
        rsn.groupBy("DOMAIN_ID", "REPORT_SPECIES_ID")
        .agg(slot(0).alias("_d"), slot(1).alias("_n"))
        .select(
            "DOMAIN_ID",
            "REPORT_SPECIES_ID",
            F.coalesce("_n", "_d", unknown_species(F.col("REPORT_SPECIES_ID"))).alias("REPORT_SPECIES_NAME"),
            F.coalesce("_d", unknown_species(F.col("REPORT_SPECIES_ID"))).alias("REPORT_SPECIES_DISPLAYNAME"),
        )
    )


def unknown_species(ident: Column) -> Column:
    return F.concat(F.lit("UNKNOWN_"), ident.cast("string"))


def latest_structures(ri: DataFrame) -> DataFrame:
    """Structure of the latest instance per species."""
    return latest_per_key(
        ri.select("DOMAIN_ID", "REPORT_SPECIES_ID", "AS_OF_TIMESTAMP", "STRUCTURE_DEF_ID"),
        ["DOMAIN_ID", "REPORT_SPECIES_ID"],
        ["AS_OF_TIMESTAMP", "STRUCTURE_DEF_ID"],
    ).select("DOMAIN_ID", "REPORT_SPECIES_ID", "STRUCTURE_DEF_ID")


def indexed_fields(
    field: DataFrame, ri: DataFrame, rsn: DataFrame, line: DataFrame, dedupe: bool = False
) -> DataFrame:
    """Indexed fields of every species' latest structure with names and width.

    Lines join without their minor version, so several minor versions fan out;
    ``dedupe`` keeps the newest line version instead.
    """
    slot = lambda n, alias: rsn.filter(F.col("ITEM_ID") == n).select(
        "DOMAIN_ID", "REPORT_SPECIES_ID", F.rtrim("NAME").alias(alias)
    )
    fields = field.filter(F.col("IS_INDEXED") == 1).select(
        "STRUCTURE_DEF_ID", "LINE_ID", "FIELD_ID", F.rtrim("NAME").alias("FIELD_NAME"), "START_COLUMN", "END_COLUMN"
    )
    if dedupe:
        line = first_per_key(line.withColumn("_v", -F.col("MINOR_VERSION")), ["STRUCTURE_DEF_ID", "LINE_ID"], ["_v"])
    lines = line.select("STRUCTURE_DEF_ID", "LINE_ID", F.rtrim("NAME").alias("LINE_NAME"))
    key = ["DOMAIN_ID", "REPORT_SPECIES_ID"]
    return (
        latest_structures(ri)
        .join(fields, "STRUCTURE_DEF_ID")
        .join(slot(0, "REPORT_SPECIES_DISPLAYNAME"), key)
        .join(slot(1, "_name"), key, "left")
        .join(lines, ["STRUCTURE_DEF_ID", "LINE_ID"], "left")
        .select(
            *key,
            F.coalesce("_name", "REPORT_SPECIES_DISPLAYNAME").alias("REPORT_SPECIES_NAME"),
            "REPORT_SPECIES_DISPLAYNAME",
            "STRUCTURE_DEF_ID",
            "LINE_ID",
            "LINE_NAME",
            "FIELD_ID",
            "FIELD_NAME",
            "START_COLUMN",
            "END_COLUMN",
            (F.col("END_COLUMN") - F.col("START_COLUMN") + 1).alias("WIDTH"),
        )
    )


def indexed_field_list(field: DataFrame, ri: DataFrame, with_ids: bool = False) -> DataFrame:
    """Indexed fields of the latest structure per species as one string, by line and field:
    ``NAME|...`` or ``NAME#LINE#FIELD|...``."""
    name = F.rtrim("NAME")
    text = F.concat_ws("#", name, F.col("LINE_ID").cast("string"), F.col("FIELD_ID").cast("string")) if with_ids else name
    rows = (
        field.filter(F.col("IS_INDEXED") == 1)
        .select("STRUCTURE_DEF_ID", "LINE_ID", "FIELD_ID", text.alias("_text"))
        .join(latest_structures(ri), "STRUCTURE_DEF_ID")
    )
    block = F.floor(F.col("LINE_ID") / SEGMENTS_PER_BLOCK)
    return ordered_concat(
        rows, ["DOMAIN_ID", "REPORT_SPECIES_ID"], ["LINE_ID", "FIELD_ID", "_text"], F.col("_text"), "|", "indexed_fields", block
    )


def signature_fields(sig: DataFrame, sf: DataFrame, f: DataFrame, keep_all: bool = True, across_versions: bool = False) -> DataFrame:
    """Signatures with their sensitive fields and the field definition at the same line and field.

    Fields belong to a version of a signature. ``across_versions`` joins on the signature id only, as the reports of
    old did: every version then meets the fields of all versions.
    """
    key = ["SIGN_ID"] if across_versions else ["SIGN_ID", "MINOR_VERSION"]
    sensitive = sf.select(*key, "LINE_ID", "FIELD_ID", "SENSITIVITY", F.rtrim("NAME").alias("SENSITIVE_NAME"))
    fields = f.select("LINE_ID", "FIELD_ID", F.rtrim("NAME").alias("FIELD_NAME")).distinct()
    return (
        sig.select("SIGN_ID", "MINOR_VERSION", "DOMAIN_ID", "REPORT_SPECIES_ID")
        .join(sensitive, key, "left" if keep_all else "inner")
        .join(fields, ["LINE_ID", "FIELD_ID"], "left")
    )


def species_signatures(rsn: DataFrame, sig: DataFrame) -> DataFrame:
    """Every named species with its signatures, if any.

    A species with more than ``SIGNATURES_PER_BLOCK`` signatures is cut into blocks by a hash of the signature, and its
    names go to each block, so that no task meets all signatures of a hot species. Names without signatures come apart.
    """
    key = ["DOMAIN_ID", "REPORT_SPECIES_ID"]
    names = rsn.filter(F.col("ITEM_ID") == 0).select(*key, F.rtrim("NAME").alias("NAME"))
    signatures = sig.select(*key, "SIGN_ID", "MINOR_VERSION", F.rtrim("DESCRIPTION").alias("DESCRIPTION"))
    counts = sig.groupBy(*key).agg(F.count("*").alias("_n"))
    hot = small_side(counts.select(*key, F.ceil(F.col("_n") / SIGNATURES_PER_BLOCK).alias("_blocks")).where("_blocks > 1"))
    blocks = F.coalesce("_blocks", F.lit(1).cast("long"))
    cut = signatures.join(hot, key, "left").withColumn("_block", F.pmod(F.xxhash64("SIGN_ID", "MINOR_VERSION", "DESCRIPTION"), blocks)).drop("_blocks")
    sent = names.join(hot, key, "left").withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).drop("_blocks")
    signed = cut.join(sent, [*key, "_block"]).select(*key, "NAME", "SIGN_ID", "MINOR_VERSION", "DESCRIPTION")
    unsigned = names.join(counts, key, "left_anti")
    return signed.unionByName(unsigned, allowMissingColumns=True)


def fields_per_signature(sig: DataFrame, sf: DataFrame) -> DataFrame:
    """Number of sensitive fields per (species, signature), 0 kept.

    The counting happens on the field side first, so a hot signature crosses the join as one row.
    """
    counts = sf.groupBy("SIGN_ID").agg(F.count("FIELD_ID").alias("_n"))
    return (
        sig.select("REPORT_SPECIES_ID", "SIGN_ID")
        .groupBy("REPORT_SPECIES_ID", "SIGN_ID")
        .agg(F.count("*").alias("_copies"))
        .join(counts, "SIGN_ID", "left")
        .select("REPORT_SPECIES_ID", "SIGN_ID", (F.coalesce("_n", F.lit(0)) * F.col("_copies")).alias("field_count"))
    )


def segment_names(seg: DataFrame, names: DataFrame | None, name: str = "NAME") -> DataFrame:
    """Section name: the catalogue's, else the index file's (id plain, then padded to two
    digits), else ``Unknown``. The fallback only runs when ``names`` is given.

    ``names``: (map_filename, segment_key, segment_name), see ``names_in_map_text``.
    """
    if names is None:
        return seg
    ident = F.col("SEGMENT_NUMBER").cast("string")
    one = names.groupBy("map_filename", "segment_key").agg(F.max_by("segment_name", "position").alias("_n"))
    plain = one.select(F.col("map_filename").alias("MAP_FILENAME"), F.col("segment_key").alias("_k1"), F.col("_n").alias("_n1"))
    padded = one.select(F.col("map_filename").alias("MAP_FILENAME"), F.col("segment_key").alias("_k2"), F.col("_n").alias("_n2"))
    own = F.when(strip(F.col(name)) != "", F.col(name))
    return (
        seg.withColumn("_k1", ident)
        .withColumn("_k2", F.when(F.length(ident) < 2, F.lpad(ident, 2, "0")).otherwise(ident))
        .join(plain, ["MAP_FILENAME", "_k1"], "left")
        .join(padded, ["MAP_FILENAME", "_k2"], "left")
        .withColumn(name, F.coalesce(own, "_n1", "_n2", F.lit("Unknown")))
        .drop("_k1", "_k2", "_n1", "_n2")
    )


def names_in_map_text(files: DataFrame, content: str = "content", file: str = "map_filename") -> DataFrame:
    """Segment names written in an index file's text as ``( 04-Name  ``: one row per id spelling
    (as found, and without leading zeros), with the position for "last one wins"."""
    pattern = F.lit(r"\(\s+(\d+)-(.+?)\s{2,}")
    text = F.col(content)
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(1)).alias("id"), F.regexp_extract_all(text, pattern, F.lit(2)).alias("name")
    )
    rows = files.select(F.col(file).alias("map_filename"), F.posexplode(pairs).alias("position", "p"))
    found = F.col("p.id")
    plain = F.regexp_replace(found, r"^0+(?=\d)", "")
    return rows.select(
        "map_filename",
        F.explode(F.array_distinct(F.array(plain, found))).alias("segment_key"),
        strip(F.col("p.name")).alias("segment_name"),
        "position",
    )


def match_files(df: DataFrame, listing: DataFrame, name: str = "FILENAME", path: str = "path") -> DataFrame:
    """Files whose name without extension equals the row's base name (``base.*``).

    Both sides derive the same key, so this is an equi-join, not a pattern match per pair.
    """
    stem = F.regexp_replace(base_name(F.col(path)), r"\.[^.]*$", "")
    files = listing.select(F.col(path).alias("matched_path"), F.upper(stem).alias("_stem"))
    rows = df.withColumn("_stem", F.upper(strip_ext(base_name(F.col(name)))))
    return rows.join(files, "_stem").drop("_stem")


def locate_files(df: DataFrame, listing: DataFrame, dirs: Sequence[str], name: str = "FILENAME", path: str = "path") -> DataFrame:
    """First match of a file name over an ordered list of directories; NULL when none has it."""
    ranked = F.array(*[F.lit(d.rstrip("/")) for d in dirs])
    files = (
        listing.select(F.col(path).alias("found_path"), base_name(F.col(path)).alias("_base"))
        .withColumn("_rank", F.array_position(ranked, F.regexp_replace("found_path", r"/[^/]*$", "")))
        .filter(F.col("_rank") > 0)
        .groupBy("_base")
        .agg(F.min_by("found_path", "_rank").alias("found_path"))
    )
    return df.withColumn("_base", base_name(F.col(name))).join(files, "_base", "left").drop("_base")


def with_file_flag(df: DataFrame, col: str, listing: DataFrame | None, flag: str = "FILE_EXISTS", path: str = "path") -> DataFrame:
    """``Y`` / ``N`` by a directory listing; '' without a file name or without a listing."""
    if listing is None:
        return df.withColumn(flag, F.lit(""))
    have = listing.select(F.upper(base_name(F.col(path))).alias("_base"), F.lit("Y").alias("_y")).distinct()
    named = F.coalesce(F.col(col), F.lit("")) != ""
    return (
        df.withColumn("_base", F.upper(base_name(F.coalesce(F.col(col), F.lit("")))))
        .join(have, "_base", "left")
        .withColumn(flag, F.when(named, F.coalesce("_y", F.lit("N"))).otherwise(""))
        .drop("_base", "_y")
    )


def correlate_maps(map_files: DataFrame, mf: DataFrame, sst: DataFrame, ris: DataFrame, section: DataFrame) -> DataFrame:
    """Index files against the catalogue: owner instance, segment and section counts, match flag.

    ``map_files``: (filename, file_size, header_valid, date_created, binary_segment_count).
    Lookups with several rows keep the last (greatest id, then latest instance).
    """
    by_name = mf.groupBy(F.rtrim("FILENAME").alias("filename")).agg(
        F.max_by(F.struct("MAP_FILE_ID", "LOCATION_ID"), F.col("MAP_FILE_ID")).alias("_m")
    )
    owner = sst.groupBy("MAP_FILE_ID").agg(
        F.max(F.struct("AS_OF_TIMESTAMP", "DOMAIN_ID", "REPORT_SPECIES_ID")).alias("_o")
    )
    key = INSTANCE_KEY[:3]
    segs = ris.groupBy(*key).agg(F.count("*").alias("_segs"))
    secs = section.groupBy("DOMAIN_ID", "REPORT_SPECIES_ID").agg(F.count("*").alias("_secs"))
    return (
        map_files.join(by_name, "filename", "left")
        .select(map_files["*"], F.col("_m.MAP_FILE_ID").alias("MAP_FILE_ID"), F.col("_m.LOCATION_ID").alias("LOCATION_ID"))
        .join(owner, "MAP_FILE_ID", "left")
        .select(
            *map_files.columns, "MAP_FILE_ID", "LOCATION_ID",
            *[F.col(f"_o.{c}").alias(c) for c in key], F.col("_o").isNotNull().alias("has_db_entry"),
        )
        .join(segs, key, "left")
        .join(secs, ["DOMAIN_ID", "REPORT_SPECIES_ID"], "left")
        .withColumn("db_segment_count", F.coalesce("_segs", F.lit(0)))
        .withColumn("section_count", F.coalesce("_secs", F.lit(0)))
        .withColumn("segments_match", F.col("binary_segment_count") == F.col("db_segment_count"))
        .drop("_segs", "_secs")
    )


def find_field(fields: DataFrame, name: str, order: Sequence[str] = ("LINE_ID", "FIELD_ID"), keys: Sequence[str] = ()) -> DataFrame:
    """Field by name, white space and case ignored; the first by line and field wins."""
    hits = fields.filter(F.upper(strip(F.col("NAME"))) == name.strip().upper())
    return first_per_key(hits, keys, order) if keys else hits.orderBy(*order).limit(1)


def find_segment(segments: DataFrame, line_id: int, field_id: int, keys: Sequence[str] = ("file",)) -> DataFrame:
    """First index segment of a (line, field) per file; segment 0 is the lookup and never matches."""
    hits = segments.filter(
        (F.col("segment_no") > 0) & (F.col("line_id") == line_id) & (F.col("field_id") == field_id)
    )
    return first_per_key(hits, keys, ["segment_no"])


def report_profile(
    ri: DataFrame, rfi: DataFrame, rf: DataFrame, sst: DataFrame, mf: DataFrame, ris: DataFrame,
    section: DataFrame, field: DataFrame,
) -> DataFrame:
    """Per species: latest instance with its files, segments with end page, section and field lists.

    Every list is aggregated on its own key before the joins, so lists do not multiply.
    """
    species = ["DOMAIN_ID", "REPORT_SPECIES_ID"]
    latest = latest_per_key(ri.select(*INSTANCE_KEY, "STRUCTURE_DEF_ID"), species, ["AS_OF_TIMESTAMP", "STRUCTURE_DEF_ID"])
    spool = rfi.join(rf, "RPT_FILE_ID").groupBy(*INSTANCE_KEY).agg(F.max(F.rtrim("FILENAME")).alias("spool_file"))
    index = sst.join(mf, "MAP_FILE_ID").groupBy(*INSTANCE_KEY).agg(F.max(F.rtrim("FILENAME")).alias("index_file"))
    end_page = (F.col("START_PAGE_NUMBER") + F.col("NUMBER_OF_PAGES") - 1).alias("end_page")
    segments = (
        ris.join(latest.select(*INSTANCE_KEY), INSTANCE_KEY, "left_semi")
        .groupBy(*INSTANCE_KEY)
        .agg(F.sort_array(F.collect_list(F.struct("SEGMENT_NUMBER", "START_PAGE_NUMBER", end_page))).alias("segments"))
    )
    sections = section.groupBy(*species).agg(
        F.sort_array(F.collect_list(F.struct("SECTION_ID", F.rtrim("NAME").alias("NAME")))).alias("sections")
    )
    wanted = field.join(latest.select("STRUCTURE_DEF_ID").distinct(), "STRUCTURE_DEF_ID", "left_semi")
    pick = lambda flag: F.sort_array(
        F.collect_list(F.when(F.col(flag) == 1, F.struct("LINE_ID", "FIELD_ID", F.rtrim("NAME").alias("NAME"))))
    )
    fields = wanted.groupBy("STRUCTURE_DEF_ID").agg(
        pick("IS_INDEXED").alias("indexed_fields"), pick("IS_SIGNIFICANT").alias("significant_fields")
    )
    return (
        latest.join(spool, INSTANCE_KEY)
        .join(index, INSTANCE_KEY)
        .join(segments, INSTANCE_KEY, "left")
        .join(sections, species, "left")
        .join(fields, "STRUCTURE_DEF_ID", "left")
    )


def section_id_hits(candidates: DataFrame, section: DataFrame, key: str = "file", ids: str = "candidates") -> DataFrame:
    """Numbers seen in a binary segment that are known section ids, with their sections' count."""
    known = section.groupBy(F.col("SECTION_ID").cast("long").alias("candidate")).agg(F.count("*").alias("sections"))
    seen = candidates.select(key, F.explode(ids).alias("candidate")).distinct()
    return seen.withColumn("candidate", F.col("candidate").cast("long")).join(known, "candidate")
