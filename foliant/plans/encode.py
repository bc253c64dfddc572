"""Turns rows of the given tables into container and index bytes.

Only input for the parsing queries and tests: the operators read such bytes, they never write them.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from foliant.functions.udf import once

HEAD = 0x200
BASE = 0xF0


def container(species: int, pages: list[bytes], sections: list[tuple[int, int, int]], objects: list[bytes] = ()) -> bytes:
    """A report container with the given pages, (id, start, count) sections and embedded objects."""
    streams = [zlib.compress(p, 1) for p in [*pages, *objects]]
    starts = HEAD + np.cumsum([0] + [len(s) for s in streams])
    rows = [(int(at) - BASE, raw, len(s)) for at, raw, s in zip(starts, [*pages, *objects], streams)]
    head = bytearray(HEAD)
    line = f"RPTFILEHDR\t0001:{species}\t2024/01/02 03:04:05".encode() + b"\x1a"
    head[: len(line)] = line
    for at, value in ((0x1D4, len(pages)), (0x1E4, len(sections)), (0x1E8, int(starts[-1])), (0x1F4, len(objects))):
        struct.pack_into("<I", head, at, value)
    page_rows = b"".join(
        struct.pack("<IIHHIII", at, 0, min(max((len(t) for t in raw.split(b"\n")), default=0), 65535), min(raw.count(b"\n") + 1, 65535), len(raw), size, 0)
        for at, raw, size in rows[: len(pages)]
    )
    object_rows = b"".join(struct.pack("<IIII", at, 0, len(raw), size) for at, raw, size in rows[len(pages) :])
    triplets = b"".join(struct.pack("<III", *s) for s in sections)
    tail = b"SECTIONHDR\0\0\0" + triplets + b"ENDDATA" + b"PAGETBLHDR\0\0\0" + page_rows
    return bytes(head) + b"".join(streams) + tail + (b"BPAGETBLHDR\0\0" + object_rows if objects else b"")


def index(segments: list[tuple[int, int, int, list[tuple[str, int]]]], page_keys: list[tuple[int, int]] = (), lookups=()) -> bytes:
    """An index file: (line, field, width, sorted entries) segments behind a segment 0.

    An entry is (value, number): a page, or an odd key when ``page_keys`` (key, page) are given. Segment 0 holds the
    ``lookups`` and behind them, from the next full record after four empty rows, the keys.
    """
    mark = "**ME".encode("utf-16le")
    head = bytearray(96)
    head[:12] = "MAPHDR".encode("utf-16le")
    struct.pack_into("<H", head, 18, len(segments) + 1)
    head[0x20:0x34] = "02/01/2024".encode("utf-16le")
    first = bytearray(0xC2)
    first[:8] = mark
    keys = b"".join(struct.pack("<IBBBII", page, 0, 8, 0, key, 0) for key, page in page_keys)
    table = b"".join(bytes(row) for row in lookups)
    records = table + bytes(16 + -(len(table) + 16) % 15) + keys if table and keys else keys or table + bytes(8)
    out = bytearray(head) + first + records
    struct.pack_into("<I", out, len(head) + 16, len(out) if segments else 0)
    for number, (line, field, width, entries) in enumerate(segments, 1):
        seg = bytearray(0xCD)
        seg[:8] = mark
        struct.pack_into("<III", seg, 8, 1, number, 0)
        struct.pack_into("<HHHHHHHH", seg, 24, 1, line, 0, field, 0, width, 0, min(len(entries), 65535))
        body = b"".join(
            struct.pack("<H", width) + value.encode("ascii", "replace")[:width].ljust(width) + struct.pack("<IB", n, 0) for value, n in entries
        )
        if number < len(segments):
            struct.pack_into("<I", seg, 16, len(out) + len(seg) + len(body))
        out += seg + body
    return bytes(out)


@F.pandas_udf(BinaryType())
def container_bytes(species: pd.Series, pages: pd.Series, objects: pd.Series) -> pd.Series:
    """One container per row; every three pages form a section 101, 102, ..."""

    def build(s, p, o):
        count = len(p)
        sections = [(101 + i, 1 + 3 * i, min(3, count - 3 * i)) for i in range((count + 2) // 3)]
        return container(int(s), [t.encode() for t in p], sections, [bytes(x) for x in o] if o is not None else [])

    return pd.Series([build(*row) for row in zip(species, pages, objects)], dtype=object)


container_bytes = once(container_bytes)


@F.pandas_udf(BinaryType())
def index_bytes(values: pd.Series, pages: pd.Series, keyed: pd.Series) -> pd.Series:
    """One index file per row with a single field (line 4, field 2) of width 12.

    Plain files hold page numbers; keyed files hold odd keys 1, 3, 5, ... resolved by segment 0. Both have the lookup table.
    """

    def build(v, p, k):
        rows, lookups = sorted(zip(v, p)), [(1, 4, 2, 0)]
        if not k:
            return index([(4, 2, 12, [(value, int(page)) for value, page in rows])], lookups=lookups)
        keys = [2 * i + 1 for i in range(len(rows))]
        return index([(4, 2, 12, [(value, key) for (value, _), key in zip(rows, keys)])], [(key, int(page)) for key, (_, page) in zip(keys, rows)], lookups)

    return pd.Series([build(*row) for row in zip(values, pages, keyed)], dtype=object)


index_bytes = once(index_bytes)
