"""Little-endian integers and byte positions inside BinaryType columns, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _byte(col: Column, pos: Column) -> Column:
    return F.conv(F.hex(F.substring(col, pos, F.lit(1))), 16, 10).cast("long")


def _as_col(pos: Column | int) -> Column:
    return F.lit(pos) if isinstance(pos, int) else pos


def u16(col: Column, offset: Column | int) -> Column:
    """Unsigned 16-bit little-endian integer at a 0-based offset."""
    at = _as_col(offset)
    return _byte(col, at + 1) + _byte(col, at + 2) * 256


def u32(col: Column, offset: Column | int) -> Column:
    """Unsigned 32-bit little-endian integer at a 0-based offset (needs a long)."""
    at = _as_col(offset)
    h = F.hex(F.substring(col, at + 1, F.lit(4)))
    big_endian = F.concat(*[F.substring(h, p, 2) for p in (7, 5, 3, 1)])
    return F.conv(big_endian, 16, 10).cast("long")


def u32_hex(value: Column) -> Column:
    """The 8 hex digits of a 32-bit little-endian integer."""
    h = F.lpad(F.hex(value.cast("long")), 8, "0")
    return F.concat(*[F.substring(h, p, 2) for p in (7, 5, 3, 1)])


def latin1(col: Column) -> Column:
    """Bytes as text, one character per byte, so character positions are byte positions."""
    return F.decode(col, "ISO-8859-1")


def byte_find(col: Column, marker: str) -> Column:
    """0-based byte offset of the first ASCII ``marker``, -1 when absent."""
    return F.locate(marker, latin1(col)) - 1
