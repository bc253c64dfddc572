"""Value search in stored index files by seeks: a catalogue of segments is made once, a search then reads a few blocks.

The catalogue has a row for each segment, with what a reader cannot know without seeing all of it: how many entries it
has, whether they are sorted, whether their numbers are pages or keys of segment 0. With it, the entries of a value are
found by bisection over fixed-width records, and pages of keys likewise in the key table.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.operators import mapindex as mi
from foliant.sources.ranges import open_file

#: Bytes that hold a segment's header and all places where its entries may begin, but for the width of one.
LEAD = int(mi.PROBES[-1]) + 3
#: Bytes read at once in a search, and in a pass over a whole segment.
BLOCK, CHUNK = 4_096, 8 << 20
#: Bytes of a record beside its text, and of a row of the key table.
AROUND, KEY_ROW = 7, 15

_SEGMENT = "segment_no long, segment_index long, offset long, next_offset long, size long, page_start long, line_id long, field_id long, field_width long, entry_count long, data_offset long"
_CATALOGUE = f"file string, path string, length long, {_SEGMENT}, entries long, sorted boolean, keyed boolean, key_offset long, key_rows long, keys_sorted boolean"


class _Stored:
    """A stored file, read by ranges that are counted."""

    def __init__(self, uri: str, length: int):
        self.source, self.length, self.bytes_read = open_file(uri), length, 0

    def read(self, at: int, size: int) -> bytes:
        size = min(size, self.length - at)
        if size <= 0:
            return b""
        data = self.source.read_at(size, at)
        self.bytes_read += len(data)
        return data

    def find(self, mark: bytes, at: int) -> int:
        """Place of the next ``mark``, searched in pieces; -1 if there is none."""
        while at < self.length:
            place = (piece := self.read(at, CHUNK)).find(mark)
            if place >= 0:
                return at + place
            if at + len(piece) >= self.length:
                break
            at += len(piece) - len(mark) + 1
        return -1


def _segments(f: _Stored) -> list[dict]:
    """Headers of the segments, from one to the next by its offset; where that leads to no marker, the marker is searched."""
    head = f.read(0, BLOCK)
    if not mi._is_index(head):
        return []
    declared = mi._number(head, 18, 2)
    starts = [head.find(mi.MARKER)] if mi.MARKER in head else [f.find(mi.MARKER, 0)]
    pieces: list[bytes] = []
    while starts[-1] >= 0:
        at = starts[-1]
        piece = f.read(at, LEAD)
        width = mi._number(piece, int(mi.HEADER.fields["field_width"][1]), 2) if len(piece) >= mi.HEADER.itemsize else 0
        pieces.append(piece + f.read(at + LEAD, width))
        following = mi._number(piece, int(mi.HEADER.fields["next_offset"][1]), 4)
        if following > at and f.read(following, len(mi.MARKER)) == mi.MARKER:
            starts.append(following)
        else:
            starts.append(-1 if len(starts) == declared else f.find(mi.MARKER, at + len(mi.MARKER)))
    rows = []
    for number, (at, end, piece) in enumerate(zip(starts, [*starts[1:-1], f.length], pieces)):
        own = mi._segments(piece[: end - at])
        if own:
            seg = own[0]
            if number:
                seg |= _named(piece, end - at)
            rows.append(seg | {"segment_no": number, "offset": at, "size": end - at, "data_offset": at + seg["data_offset"]})
    return rows


def _named(piece: bytes, size: int) -> dict:
    """Header fields and the begin of the entries of a segment other than the first, which has none."""
    head = np.frombuffer(piece, mi.HEADER, 1)
    fields = {n: int(head[n][0]) for n in mi.HEADER.names}
    begin = mi._data_offsets(np.frombuffer(piece, np.uint8), np.zeros(1, np.int64), np.array([size]), np.array([fields["field_width"]]))
    return fields | {"data_offset": int(begin[0])}


def _keys(f: _Stored, seg: dict) -> tuple[mi.Columns, int, bool]:
    """The key table, the rows before its first data row (of the lookup table), and whether from there it holds data rows
    only with ascending keys."""
    data = f.read(seg["data_offset"], seg["offset"] + seg["size"] - seg["data_offset"])
    keys = mi._page_keys(data, [seg | {"data_offset": 0, "offset": 0, "size": len(data)}])
    skipped = int(keys["record_no"][0]) if len(keys["record_no"]) else 0
    ordered = len(keys["u32_key"]) == len(data) // KEY_ROW - skipped and bool((np.diff(keys["u32_key"]) > 0).all())
    return keys, skipped, ordered


def _pass(f: _Stored, seg: dict, keys: mi.Columns) -> tuple[int, bool, bool]:
    """(number of entries, sorted, keyed) of a segment, read once in pieces."""
    size = AROUND + seg["field_width"]
    at, end = seg["data_offset"], min(seg["offset"] + seg["size"], f.length)
    count, ordered, last, known, odd = 0, True, None, 0, True
    while at + size <= end:
        data = f.read(at, min(max(CHUNK // size, 1) * size, (end - at) // size * size))
        part = mi._entries(data, seg | {"data_offset": 0, "offset": 0, "size": len(data)}, keyed=True, blanks=True)
        n = 0 if part is None else len(part["value"])
        if n:
            values = pa.array(part["value"], pa.large_string())
            ordered = ordered and (last is None or last <= part["value"][0]) and not pc.any(pc.less(values[1:], values[:-1])).as_py()
            last = part["value"][-1]
            known += int(np.isin(part["u32_key"], keys["u32_key"]).sum())
            odd = odd and bool((part["u32_key"] % 2 == 1).all())
        count += n
        if n < len(data) // size:
            break
        at += len(data)
    return count, ordered, mi.keyed_by(count, known, odd)


def read_segments(files: DataFrame) -> DataFrame:
    """``map_segment`` of a listing (file, path, length), headers only, with ``bytes_read`` of the file."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, path, length in zip(*(batch.column(c).to_pylist() for c in ("file", "path", "length"))):
                f = _Stored(path, length)
                found = _segments(f)
                rows += [{"file": name, **seg, "bytes_read": f.bytes_read} for seg in found]
            yield pa.RecordBatch.from_pylist(rows, _arrow(f"file string, {_SEGMENT}, bytes_read long"))

    return files.select("file", "path", "length").mapInArrow(read, f"file string, {_SEGMENT}, bytes_read long")


def index_catalogue(files: DataFrame) -> DataFrame:
    """The segments of a listing (file, path, length) with what a search needs; each file is read once, in pieces.

    Write it beside the archive: it is a row for each segment. Broken and empty files have no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, path, length in zip(*(batch.column(c).to_pylist() for c in ("file", "path", "length"))):
                f = _Stored(path, length)
                segs = _segments(f)
                keys, skipped, ordered = _keys(f, segs[0]) if segs else (None, 0, False)
                for seg in segs[1:]:
                    count, in_order, keyed = _pass(f, seg, keys) if seg["field_width"] else (0, True, False)
                    more = {"entries": count, "sorted": in_order, "keyed": keyed, "key_offset": segs[0]["data_offset"] + skipped * KEY_ROW, "keys_sorted": ordered}
                    more["key_rows"] = max(0, segs[0]["offset"] + segs[0]["size"] - more["key_offset"]) // KEY_ROW
                    rows.append({"file": name, "path": path, "length": length, **seg, **more})
            yield pa.RecordBatch.from_pylist(rows, _arrow(_CATALOGUE))

    return files.select("file", "path", "length").mapInArrow(read, _CATALOGUE)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


class _Records:
    """A table of ``count`` records of ``size`` bytes, read by blocks as they are asked for."""

    def __init__(self, f: _Stored, at: int, size: int, count: int):
        self.f, self.at, self.size, self.count = f, at, size, count
        self.per_block = max(BLOCK // size, 1)
        self.blocks: dict[int, bytes] = {}

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, i: int) -> bytes:
        block, place = divmod(i, self.per_block)
        if block not in self.blocks:
            self.blocks[block] = self.f.read(self.at + block * self.per_block * self.size, min(self.per_block, self.count - block * self.per_block) * self.size)
        return self.blocks[block][place * self.size : (place + 1) * self.size]


def _value(record: bytes) -> str:
    return record[2 : len(record) - AROUND + 2].decode("ascii", "replace").strip(" \t\n\v\f\r")


def _range(records: _Records, value: str, prefix: bool) -> tuple[int, int]:
    """First entry with the value and the first after those; blocks are read around the places that are looked at."""
    low = bisect_left(records, value, key=_value)
    beyond = (lambda r: _value(r)[: len(value)] > value) if prefix else (lambda r: _value(r) > value)
    # doubled steps from there, so that few entries of a value cost few blocks
    step = 1
    while low + step < len(records) and not beyond(records[low + step]):
        step *= 2
    return low, bisect_left(records, True, lo=low, hi=min(low + step, len(records)), key=beyond)


def _page(keys: _Records, key: int) -> int:
    """Page of a key in an ascending key table, 0 if it has none."""
    place = bisect_left(keys, key, key=lambda r: mi._number(r, 7, 4))
    found = place < len(keys) and mi._number(keys[place], 7, 4) == key
    return mi._number(keys[place], 0, 4) & mi.PAGE_MASK if found else 0


_FOUND = "file string, segment_no long, line_id long, field_id long, field_width long, entry_no long, value string, page long, u32_key long, format string, bytes_read long"


def search_stored(catalogue: DataFrame, line_id: int, field_id: int, value: str, prefix: bool = False, signs: bool = False) -> DataFrame:
    """Entries of a field with a value (blanks around it ignored), or starting with it, pages resolved, in stored files.

    ``catalogue``: see ``index_catalogue``; of several segments of the field in a file the first counts. Rows as from
    ``map_entry`` with ``resolve``, and ``bytes_read`` of the file. Sorted segments are bisected, others read in pieces;
    a key table that is not ascending is read whole. Batches leave in pieces, however often a value occurs.
    """
    text = value.strip()
    wanted = catalogue.where((F.col("line_id") == line_id) & (F.col("field_id") == field_id) & (F.col("entries") > 0))
    first = wanted.groupBy("file").agg(F.min_by(F.struct(*[c for c in catalogue.columns if c != "file"]), "segment_no").alias("s")).select("file", "s.*")

    def found(f: _Stored, seg: dict) -> Iterator[mi.Columns]:
        size = AROUND + seg["field_width"]
        records = _Records(f, seg["data_offset"], size, seg["entries"])
        low, high = _range(records, text, prefix) if seg["sorted"] else (0, seg["entries"])
        keys = whole = None
        if seg["keyed"] and seg["keys_sorted"]:
            keys = _Records(f, seg["key_offset"], KEY_ROW, seg["key_rows"])
        elif seg["keyed"]:
            data = f.read(seg["key_offset"], seg["key_rows"] * KEY_ROW)
            whole = mi._page_keys(data, [{"data_offset": 0, "offset": 0, "size": len(data)}])
        step = max(CHUNK // size, 1)
        for start in range(low, high, step):
            data = f.read(seg["data_offset"] + start * size, min(step, high - start) * size)
            part = mi._entries(data, seg | {"data_offset": 0, "offset": 0, "size": len(data)}, signs, keyed=seg["keyed"])
            if part is None:
                continue
            part["entry_no"] = part["entry_no"] + start
            part = mi._matching(part, text, prefix)
            if keys is not None:
                part["page"] = np.array([_page(keys, k) for k in part["u32_key"].tolist()], "int64")
            elif whole is not None:
                mi._resolve(part, whole)
            yield part

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seg in batch.to_pylist():
                f = _Stored(seg["path"], seg["length"])
                for part in found(f, seg):
                    rows = len(part["value"])
                    if rows:
                        part |= {"file": np.full(rows, seg["file"], object), "bytes_read": np.full(rows, f.bytes_read, "int64")}
                        yield pa.record_batch({n: pa.array(part[n], t) for n, t in zip(_arrow(_FOUND).names, _arrow(_FOUND).types)})

    return first.mapInArrow(read, _FOUND)
