"""Index files: header, segments, entries, page keys; value search and page resolution.

Each Python function below decodes one kind of fixed-width record with numpy into plain
columns; filtering, joins and counts are DataFrame work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.sources.schemas import INSTANCE_KEY

# Layout of the index file.
SIGNATURE = "MAPHDR".encode("utf-16le")
MARKER = "**ME".encode("utf-16le")
#: What follows a segment's marker.
HEADER = np.dtype(
    {
        "names": ["segment_index", "next_offset", "page_start", "line_id", "field_id", "field_width", "entry_count"],
        "formats": ["<u4", "<u4", "<u2", "<u2", "<u2", "<u2", "<u2"],
        "offsets": [12, 16, 24, 26, 30, 34, 38],
        "itemsize": 48,
    }
)
LOOKUP_OFFSET = 0xC2
PROBES, FALLBACK_OFFSET = np.arange(0xC0, 0xE0), 0xCD
LOOKUP_GAP = 4
PAGE_MASK = 0x7FFFFFFF

BATCH_ROWS = 50_000

Columns = dict[str, np.ndarray]

_SEGMENT_SCHEMA = (
    "file string, segment_no long, segment_index long, offset long, next_offset long, size long, page_start long, "
    "line_id long, field_id long, field_width long, entry_count long, data_offset long"
)
_ENTRY_SCHEMA = (
    "file string, segment_no long, line_id long, field_id long, field_width long, entry_no long, value string, "
    "page long, u32_key long, format string"
)


def _markers(data: bytes) -> list[int]:
    out, at = [], data.find(MARKER)
    while at >= 0:
        out.append(at)
        at = data.find(MARKER, at + len(MARKER))
    return out


def _number(data: bytes, at: int, size: int) -> int:
    return int.from_bytes(data[at : at + size], "little")


def _data_offsets(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Where each segment's entries begin: the first probe whose length field is the width and whose text is mostly
    printable, all probes of all segments at once."""
    at = starts[:, None] + PROBES
    inside = (at < ends[:, None] - 2) & (at + 2 + widths[:, None] <= len(raw)) & (widths[:, None] > 0)
    printable = np.concatenate([[0], np.cumsum((raw >= 32) & (raw < 127))])
    at_safe = np.where(inside, at, 0)
    length = raw[at_safe].astype(np.int64) | raw[np.minimum(at_safe + 1, len(raw) - 1)].astype(np.int64) << 8
    text_end = np.minimum(at_safe + 2 + widths[:, None], len(raw))
    shown = printable[text_end] - printable[np.minimum(at_safe + 2, len(raw))]
    fits = inside & (length == widths[:, None]) & (2 * shown > widths[:, None])
    return starts + np.where(fits.any(axis=1), PROBES[fits.argmax(axis=1)], FALLBACK_OFFSET)


def _segments(data: bytes) -> list[dict]:
    """Headers of the segments, read together; segment 0 is the lookup and has no field."""
    marks = np.array(_markers(data), np.int64)
    ends = np.append(marks[1:], len(data))
    number = np.flatnonzero(marks + HEADER.itemsize <= len(data))
    if not len(number):
        return []
    raw, starts, ends = np.frombuffer(data, np.uint8), marks[number], ends[number]
    heads = np.ascontiguousarray(raw[starts[:, None] + np.arange(HEADER.itemsize)]).view(HEADER)[:, 0]
    cols = {n: heads[n].astype(np.int64) for n in HEADER.names}
    for n in ("page_start", "line_id", "field_id", "field_width", "entry_count"):
        cols[n][number == 0] = 0
    begins = _data_offsets(raw, starts, ends, cols["field_width"])
    cols |= {"segment_no": number, "offset": starts, "size": ends - starts, "data_offset": np.where(number == 0, starts + LOOKUP_OFFSET, begins)}
    return [dict(zip(cols, row)) for row in zip(*(c.tolist() for c in cols.values()))]


def _values(texts: np.ndarray, width: int) -> pa.Array:
    """Stripped ASCII values of a column of fixed-width texts; other bytes show as the replacement character."""
    raw = np.ascontiguousarray(texts).view(np.uint8)
    if (raw >= 128).any():
        joined = raw.tobytes().decode("ascii", "replace")
        return pa.array([joined[i : i + width].strip() for i in range(0, len(joined), width)], pa.large_string())
    places = np.arange(len(texts) + 1, dtype=np.int64) * width
    return pc.ascii_trim_whitespace(pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(places), pa.py_buffer(raw)]))


def _is_keyed(numbers: np.ndarray, keys: Columns | None) -> bool:
    """Whether a segment's numbers are keys of segment 0 rather than pages: all are known there, or all are odd, as keys
    are, and most are known (the others lead nowhere). Without a key table they are pages, whatever their number."""
    if keys is None or not keys["u32_key"].size or not numbers.size:
        return False
    return keyed_by(len(numbers), int(np.isin(numbers, keys["u32_key"]).sum()), bool((numbers % 2 == 1).all()))


def keyed_by(count: int, known: int, odd: bool) -> bool:
    """The rule of ``_is_keyed`` for ``count`` numbers, ``known`` of them known and all of them ``odd`` or not."""
    return count > 0 and (known == count or odd and 2 * known > count)


def _entries(data: bytes, seg: dict, signs: bool = False, keys: Columns | None = None, keyed: bool | None = None, blanks: bool = False) -> Columns | None:
    """Entries of a segment, all of them with ``blanks``; ``keys`` are those of segment 0, unless ``keyed`` says what the numbers are."""
    width = seg["field_width"]
    if width <= 0:
        return None
    record = np.dtype(
        {
            "names": ["length", "text", "u16", "u32"],
            "formats": ["<u2", f"V{width}", "<u2", "<u4"],
            "offsets": [0, 2, 2 + width, 2 + width],
            "itemsize": 7 + width,
        }
    )
    first, end = seg["data_offset"], min(seg["offset"] + seg["size"], len(data))
    count = max(0, (end - first) // record.itemsize)
    rows = np.frombuffer(data, record, count, first) if count else np.empty(0, record)
    broken = np.flatnonzero(rows["length"] != width)
    rows = rows[: broken[0]] if len(broken) else rows
    if not len(rows):
        return None
    keyed = _is_keyed(rows["u32"].astype("int64"), keys) if keyed is None else keyed
    values = _values(rows["text"], width)
    shown = pc.not_equal(values, "") if signs else pc.match_substring_regex(values, r"(?s)^.{0,4}[0-9A-Za-z]")
    kept = np.arange(len(rows)) if blanks else np.flatnonzero(shown.to_numpy(zero_copy_only=False))
    size = len(kept)
    zeros = np.zeros(size, "int64")
    return {
        **{k: np.full(size, seg[k], "int64") for k in ("segment_no", "line_id", "field_id", "field_width")},
        "entry_no": kept.astype("int64"),
        "value": values.take(pa.array(kept)).to_numpy(zero_copy_only=False),
        "page": zeros if keyed else rows["u16"][kept].astype("int64"),
        "u32_key": rows["u32"][kept].astype("int64") if keyed else zeros,
        "format": np.full(size, "u32_index" if keyed else "page", dtype=object),
    }


def _page_keys(data: bytes, segs: list[dict] | None = None) -> Columns | None:
    segs = _segments(data) if segs is None else segs
    if not segs:
        return None
    record = np.dtype(
        {"names": ["page", "type", "key"], "formats": ["<u4", "u1", "<u4"], "offsets": [0, 5, 7], "itemsize": 15}
    )
    first, end = segs[0]["data_offset"], min(segs[0]["offset"] + segs[0]["size"], len(data))
    count = max(0, (end - first) // record.itemsize)
    rows = np.frombuffer(data, record, count, first) if count else np.empty(0, record)
    numbers = np.flatnonzero(rows["type"] == 0x08)
    rows = rows[numbers]
    return {"record_no": numbers.astype("int64"), "u32_key": rows["key"].astype("int64"), "page": (rows["page"] & PAGE_MASK).astype("int64")}


def _resolve(entries: Columns, keys: Columns | None) -> None:
    """Put the pages of keyed entries in place; the last of equal keys counts, unknown keys give 0."""
    if entries["format"].size and entries["format"][0] == "u32_index" and keys is not None and keys["u32_key"].size:
        order = np.argsort(keys["u32_key"], kind="stable")
        known = keys["u32_key"][order]
        at = np.searchsorted(known, entries["u32_key"], side="right") - 1
        hit = (at >= 0) & (known[at] == entries["u32_key"])
        entries["page"] = np.where(hit, keys["page"][order][at], 0)


def _matching(entries: Columns, value: str | None, prefix: bool) -> Columns:
    if value is None:
        return entries
    values = pa.array(entries["value"], pa.large_string())
    hits = (pc.starts_with(values, value) if prefix else pc.equal(values, value)).to_numpy(zero_copy_only=False)
    return {k: v[hits] for k, v in entries.items()}


def _lookups(data: bytes) -> Columns | None:
    """Rows of the lookup table: segments that the file has, with a line and a field; LOOKUP_GAP other rows end it."""
    marks = _markers(data)
    if len(marks) < 2:
        return None
    begin, end = marks[0] + LOOKUP_OFFSET, marks[1] - 4
    count = max(0, -(-(end - begin) // 4))
    rows = np.frombuffer(data, np.uint8, 4 * count, begin).reshape(-1, 4).astype("int64")
    good = (rows[:, 0] < len(marks)) & (rows[:, 1] > 0) & (rows[:, 2] > 0)
    bad = np.concatenate([[0], np.cumsum(~good)])
    gaps = np.flatnonzero(bad[LOOKUP_GAP:] - bad[:-LOOKUP_GAP] == LOOKUP_GAP)
    rows = rows[: gaps[0]][good[: gaps[0]]] if len(gaps) else rows[good]
    return dict(zip(["segment", "line_id", "field_id", "flags"], rows.T))


def _is_index(data: bytes) -> bool:
    return len(data) >= 90 and data[: len(SIGNATURE)] == SIGNATURE


def map_header(files: DataFrame) -> DataFrame:
    """file, length, header_valid, segment_count, date_string and the number of markers found."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, data in zip(batch["file"], batch["content"]):
                good = _is_index(data)
                date = data[0x20:0x34].decode("utf-16le", "ignore").strip("\x00") if good else None
                rows.append((name, len(data), good, _number(data, 18, 2) if good else 0, date, data.count(MARKER)))
            yield pd.DataFrame(rows, columns=["file", "length", "header_valid", "segment_count", "date_string", "marker_count"])

    schema = "file string, length long, header_valid boolean, segment_count long, date_string string, marker_count long"
    return files.select("file", "content").mapInPandas(parse, schema)


def _per_file(files: DataFrame, decode: Callable, schema: str, extra: Sequence[str] = ()) -> DataFrame:
    """Decode every index file to columns; rows of many small files leave in one batch, a large
    file leaves in several, so neither the batch count nor the batch size grows with the archive."""
    names = [c.split()[0] for c in schema.split(",")]

    def frame(parts: list[Columns]) -> pd.DataFrame:
        return pd.DataFrame({n: np.concatenate([p[n] for p in parts]) for n in names})

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held = [], 0
        for batch in batches:
            for name, data, *more in zip(batch["file"], batch["content"], *[batch[c] for c in extra]):
                for cols in decode(data, *more) if _is_index(data) else ():
                    size = 0 if cols is None else len(next(iter(cols.values())))
                    for start in range(0, size, BATCH_ROWS):
                        part = {k: v[start : start + BATCH_ROWS] for k, v in cols.items()}
                        rows = len(next(iter(part.values())))
                        part["file"] = np.full(rows, name, dtype=object)
                        parts.append(part)
                        held += rows
                        if held >= BATCH_ROWS:
                            yield frame(parts)
                            parts, held = [], 0
        if parts:
            yield frame(parts)

    return files.select("file", "content", *extra).mapInPandas(parse, schema)


def map_segment(files: DataFrame) -> DataFrame:
    """Segment metadata; segment 0 is the lookup."""

    def decode(data: bytes):
        segs = _segments(data)
        if segs:
            yield {k: np.array([s[k] for s in segs], dtype="int64") for k in segs[0]}

    return _per_file(files, decode, _SEGMENT_SCHEMA)


def map_entry(
    files: DataFrame,
    line_id: int | None = None,
    field_id: int | None = None,
    value: str | None = None,
    prefix: bool = False,
    resolve: bool = False,
    signs: bool = False,
) -> DataFrame:
    """Index entries of all segments, or of the first segment of one (line, field).

    Blank values are left out, and so are values without a letter or digit in their first five characters, unless
    ``signs`` keeps them. ``entry_no`` counts all entries, so gaps in it show how many were left out.

    A field asked for (by argument, or per file in an array column ``want`` of (line_id, field_id)),
    a value and ``resolve`` are handled inside the decoder: other segments are skipped, other
    values never leave the worker, and keyed entries get their page from the same file, which
    saves the join of ``resolve_pages`` and a second read of the file.
    """
    per_file = "want" in files.columns
    text = None if value is None else value.strip()

    def decode(data: bytes, want=None):
        segs = _segments(data)
        named = segs[1:]
        if line_id is not None:
            named = [s for s in named if (s["line_id"], s["field_id"]) == (line_id, field_id)][:1]
        elif per_file:
            asked = dict.fromkeys((w["line_id"], w["field_id"]) for w in want)
            first = {(s["line_id"], s["field_id"]): s for s in reversed(named)}
            named = [first[k] for k in asked if k in first]
        keys = _page_keys(data, segs) if named else None
        for seg in named:
            entries = _entries(data, seg, signs, keys)
            if entries is not None:
                entries = _matching(entries, text, prefix)
                if resolve:
                    _resolve(entries, keys)
                yield entries

    return _per_file(files, decode, _ENTRY_SCHEMA, ["want"] if per_file else [])


def map_page_key(files: DataFrame) -> DataFrame:
    """(file, record_no, u32_key, page) of the data records in segment 0."""
    return _per_file(files, lambda data: [_page_keys(data)], "file string, record_no long, u32_key long, page long")


def map_lookup(files: DataFrame) -> DataFrame:
    """(file, segment, line_id, field_id, flags) rows of the lookup table."""
    return _per_file(files, lambda data: [_lookups(data)], "file string, segment long, line_id long, field_id long, flags long")


def write_entries(entries: DataFrame, path: str) -> None:
    """Entries as parquet, range-sorted by (line, field, value), so that a later search reads
    only the row groups whose value range fits: the file format's own binary search."""
    order = ["line_id", "field_id", "value", "file", "entry_no"]
    entries.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def search_index(entries: DataFrame, line_id: int, field_id: int, value: str, prefix: bool = False) -> DataFrame:
    """Entries of a field equal to a value (blanks around it ignored), or starting with it."""
    wanted = value.strip()
    match = F.col("value").startswith(wanted) if prefix else F.col("value") == wanted
    return entries.filter((F.col("line_id") == line_id) & (F.col("field_id") == field_id) & match)


def resolve_pages(entries: DataFrame, page_keys: DataFrame) -> DataFrame:
    """Page of every entry: its own, or the one its key has in segment 0 (0 when unknown).

    Of repeated keys the last record counts. Only keyed entries take part in the join.
    """
    keys = page_keys.groupBy("file", "u32_key").agg(F.max_by("page", "record_no").alias("_page"))
    keyed = entries.filter(F.col("format") == "u32_index").join(keys, ["file", "u32_key"], "left")
    keyed = keyed.withColumn("page", F.coalesce("_page", F.lit(0))).select(*entries.columns)
    return entries.filter(F.col("format") != "u32_index").unionByName(keyed)


def found_pages(resolved: DataFrame) -> DataFrame:
    """Distinct (file, page) with a real page number."""
    return resolved.filter(F.col("page") > 0).select("file", "page").distinct()


def list_fields(segments: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Indexed fields of the files, with names when metadata rows are given."""
    rows = segments.filter(F.col("segment_no") > 0).select("file", "segment_no", "line_id", "field_id", "field_width", "entry_count")
    if metadata is None:
        return rows.withColumn("field_name", F.lit(None).cast("string"))
    names = metadata.groupBy("line_id", "field_id").agg(F.min("field_name").alias("field_name"))
    return rows.join(names, ["line_id", "field_id"], "left")


def index_integrity(headers: DataFrame, segments: DataFrame, catalogue: DataFrame, ris: DataFrame) -> DataFrame:
    """Header segment count, markers found, readable segments and the catalogue's segments side by side.

    ``catalogue``: (file, instance key) rows, see ``map_catalogue``.
    """
    key = INSTANCE_KEY[:3]
    read = segments.groupBy("file").agg(F.count("*").alias("_read"))
    counts = ris.groupBy(*key).agg(F.count("*").alias("_db"))
    db = catalogue.select("file", *key).join(counts, key).groupBy("file").agg(F.sum("_db").alias("_db"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (
        headers.select("file", "header_valid", "segment_count", "marker_count")
        .join(read, "file", "left")
        .join(db, "file", "left")
        .select(
            "file", "header_valid", "segment_count", "marker_count", zero("_read").alias("readable_segments"), zero("_db").alias("db_segments"),
            (F.col("segment_count") == F.col("marker_count")).alias("header_matches"),
            (F.col("marker_count") == zero("_db")).alias("segments_match"),
        )
    )


def candidate_ids(files: DataFrame, head_bytes: int | None = None, highest: int | None = None) -> DataFrame:
    """Numbers from 1 to ``highest`` (all by default) at even offsets in the first ``head_bytes`` of every segment (the
    whole segment by default), as an array.

    Read in one pass with the segments, so that file contents take part in no join.
    """

    def decode(data: bytes):
        for seg in _segments(data):
            head = data[seg["offset"] : seg["offset"] + min(seg["size"], head_bytes or seg["size"])]
            short = np.frombuffer(head, "<u2", len(head) // 2).astype("int64")
            numbers = np.unique(np.concatenate([short, short[:-1] + (short[1:] << 16)]))
            found = np.empty(1, dtype=object)
            found[0] = numbers[(numbers >= 1) & (numbers <= (highest or numbers.max(initial=0)))].tolist()
            yield {"segment_no": np.array([seg["segment_no"]], dtype="int64"), "candidates": found}

    return _per_file(files, decode, "file string, segment_no long, candidates array<long>")
