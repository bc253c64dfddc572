"""Access-control blobs: security identifiers, masks and descriptor entries.

The scan over a blob needs a byte loop, so it runs as one Arrow UDF per batch; every
later step (principals, roll-ups, translation) is plain DataFrame work.
"""

from __future__ import annotations

import struct

import pandas as pd
import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from foliant.functions.binary import _byte, u32, u32_hex
from foliant.functions.text import literal_map
from foliant.functions.udf import once

EVERYONE = "S-1-1-0"

# Names of well-known identifiers.
WELL_KNOWN_SID = {
    "S-1-1-0": "Everyone",
    "S-1-2-0": "Local",
    "S-1-3-0": "Creator Owner",
    "S-1-3-1": "Creator Group",
    "S-1-5-18": "Local System",
    "S-1-5-19": "NT Authority\\Local Service",
    "S-1-5-20": "NT Authority\\Network Service",
    "S-1-5-32-544": "BUILTIN\\Administrators",
    "S-1-5-32-545": "BUILTIN\\Users",
    "S-1-5-32-546": "BUILTIN\\Guests",
    "S-1-5-32-547": "BUILTIN\\Power Users",
    "S-1-5-32-551": "BUILTIN\\Backup Operators",
}
# Names of well-known last parts of domain identifiers.
WELL_KNOWN_RID = {
    "500": "Domain Administrator",
    "501": "Domain Guest",
    "502": "KRBTGT",
    "512": "Domain Admins",
    "513": "Domain Users",
    "514": "Domain Guests",
    "515": "Domain Computers",
    "516": "Domain Controllers",
    "517": "Cert Publishers",
    "518": "Schema Admins",
    "519": "Enterprise Admins",
    "520": "Group Policy Creator Owners",
}
# Rights by mask bit, in output order.
RIGHT_BITS = [
    (0x10000000, "GENERIC_ALL"),
    (0x20000000, "GENERIC_EXECUTE"),
    (0x40000000, "GENERIC_WRITE"),
    (0x80000000, "GENERIC_READ"),
    (0x00010000, "DELETE"),
    (0x00020000, "READ_CONTROL"),
    (0x00040000, "WRITE_DAC"),
    (0x00080000, "WRITE_OWNER"),
    (0x00100000, "SYNCHRONIZE"),
    (0x00000001, "FILE_READ_DATA/LIST_DIRECTORY"),
    (0x00000002, "FILE_WRITE_DATA/ADD_FILE"),
    (0x00000004, "FILE_APPEND_DATA/ADD_SUBDIRECTORY"),
    (0x00000008, "FILE_READ_EA"),
    (0x00000010, "FILE_WRITE_EA"),
    (0x00000020, "FILE_EXECUTE/TRAVERSE"),
    (0x00000040, "FILE_DELETE_CHILD"),
    (0x00000080, "FILE_READ_ATTRIBUTES"),
    (0x00000100, "FILE_WRITE_ATTRIBUTES"),
]
# Masks with a name of their own.
RIGHT_COMBINATIONS = {0x001F01FF: "FULL_CONTROL (All Rights)", 0x00000007: "READ & EXECUTE", 0x00000006: "MODIFY"}
# Entry types and control flags of a security descriptor.
ACE_TYPES = {
    "0": "ACCESS_ALLOWED_ACE_TYPE",
    "1": "ACCESS_DENIED_ACE_TYPE",
    "2": "SYSTEM_AUDIT_ACE_TYPE",
    "3": "SYSTEM_ALARM_ACE_TYPE",
    "5": "ACCESS_ALLOWED_OBJECT_ACE_TYPE",
    "6": "ACCESS_DENIED_OBJECT_ACE_TYPE",
    "7": "SYSTEM_AUDIT_OBJECT_ACE_TYPE",
    "8": "SYSTEM_ALARM_OBJECT_ACE_TYPE",
}
CONTROL_FLAGS = [
    (0x0001, "SE_OWNER_DEFAULTED"),
    (0x0002, "SE_GROUP_DEFAULTED"),
    (0x0004, "SE_DACL_PRESENT"),
    (0x0008, "SE_DACL_DEFAULTED"),
    (0x0010, "SE_SACL_PRESENT"),
    (0x0020, "SE_SACL_DEFAULTED"),
    (0x0100, "SE_DACL_AUTO_INHERIT_REQ"),
    (0x0200, "SE_SACL_AUTO_INHERIT_REQ"),
    (0x0400, "SE_DACL_AUTO_INHERITED"),
    (0x0800, "SE_SACL_AUTO_INHERITED"),
    (0x1000, "SE_DACL_PROTECTED"),
    (0x2000, "SE_SACL_PROTECTED"),
    (0x4000, "SE_RM_CONTROL_VALID"),
    (0x8000, "SE_SELF_RELATIVE"),
]

_SID_TYPE = ArrayType(
    StructType().add("pos", IntegerType()).add("sid", StringType()).add("rid", LongType()).add("mask", LongType())
)
_ACE_TYPE = (
    StructType()
    .add("revision", IntegerType())
    .add("control", IntegerType())
    .add("owner_sid", StringType())
    .add("group_sid", StringType())
    .add(
        "aces",
        ArrayType(
            StructType()
            .add("acl", StringType())
            .add("ace_type", IntegerType())
            .add("ace_flags", IntegerType())
            .add("mask", LongType())
            .add("sid", StringType())
        ),
    )
)


def sid_text(blob: bytes, at: int) -> tuple[str, int] | None:
    """Identifier text and its last part at ``at``; NULL when the bytes run out."""
    if at < 0 or at + 8 > len(blob):
        return None
    parts = blob[at + 1]
    if at + 8 + 4 * parts > len(blob):
        return None
    subs = struct.unpack_from(f"<{parts}I", blob, at + 8)
    authority = int.from_bytes(blob[at + 2 : at + 8], "big")
    return "-".join(["S", str(blob[at]), str(authority), *map(str, subs)]), (subs[-1] if subs else 0)


@F.arrow_udf(_SID_TYPE)
def acl_sids(blob: pa.Array) -> pa.Array:
    """Every identifier found at any offset of the blob, with the mask in the four bytes before it.

    Candidates are found in the batch's one data buffer; only bytes that can begin an identifier reach Python.
    """
    blob = blob.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(blob.buffers()[1], np.int64)[blob.offset : blob.offset + len(blob) + 1]
    data = blob.buffers()[2] or pa.py_buffer(b"")
    raw = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(raw[bounds[0] : bounds[-1]] == 1) + bounds[0]
    row = np.searchsorted(bounds, at, side="right") - 1
    end = bounds[row + 1]
    near = at + 8 < end
    at, row, end = at[near], row[near], end[near]
    parts = raw[at + 1].astype(np.int64)
    whole = (parts > 0) & (parts <= 15) & (at + 8 + 4 * parts <= end)
    at, row = at[whole], row[whole]
    ends = np.append(0, np.cumsum(np.bincount(row, minlength=len(blob))))
    spots, sids, rids, masks = (at - bounds[row]).tolist(), [], [], []
    view = memoryview(data)
    for place, spot in zip(at.tolist(), spots):
        sid, last = sid_text(view[place : place + 8 + 4 * view[place + 1]], 0)
        sids.append(sid)
        rids.append(last if sid.count("-") >= 7 and sid.split("-", 4)[3] == "21" else None)
        masks.append(struct.unpack_from("<I", view, place - 4)[0] if spot >= 4 else None)
    columns = [pa.array(spots, pa.int32()), pa.array(sids, pa.string()), pa.array(rids, pa.int64()), pa.array(masks, pa.int64())]
    rows = pa.StructArray.from_arrays(columns, ["pos", "sid", "rid", "mask"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)


acl_sids = once(acl_sids)


def _entries(blob: bytes, at: int, kind: str) -> list[dict]:
    out = []
    if not 0 < at <= len(blob) - 8:
        return out
    pos = at + 8
    for _ in range(struct.unpack_from("<H", blob, at + 4)[0]):
        if pos + 8 > len(blob):
            return []
        ace_type, flags, size, mask = struct.unpack_from("<BBHI", blob, pos)
        sid = sid_text(blob, pos + 8)
        if sid is None or size == 0:
            return []
        out.append({"acl": kind, "ace_type": ace_type, "ace_flags": flags, "mask": mask, "sid": sid[0]})
        pos += size
    return out


def _descriptor(blob: bytes | None) -> dict | None:
    if blob is None or len(blob) < 20:
        return None
    control, owner, group, sacl, dacl = struct.unpack_from("<HIIII", blob, 2)
    name = lambda at: (sid_text(blob, at) or (None,))[0] if at > 0 else None
    return {
        "revision": blob[0],
        "control": control,
        "owner_sid": name(owner),
        "group_sid": name(group),
        "aces": _entries(blob, dacl, "DACL") + _entries(blob, sacl, "SACL"),
    }


@F.pandas_udf(_ACE_TYPE)
def acl_aces(blob: pd.Series) -> pd.DataFrame:
    """Whole descriptor: header, owner, group and the entries of both lists."""
    rows = [_descriptor(b) or dict.fromkeys(("revision", "control", "owner_sid", "group_sid", "aces")) for b in blob]
    frame = pd.DataFrame(rows, columns=["revision", "control", "owner_sid", "group_sid", "aces"])
    return frame.astype({"revision": "Int32", "control": "Int32"})


acl_aces = once(acl_aces)


def blob_of_hex(text: Column) -> Column:
    """Hex text, with or without ``0x``, as bytes; bad hex gives NULL."""
    digits = F.regexp_replace(text, r"^0x", "")
    return F.try_to_binary(F.regexp_replace(digits, r"\s", ""), F.lit("hex"))


def acl_grants(blob: Column) -> Column:
    """``struct(rids, everyone)``: distinct RIDs in first-seen order, and the Everyone flag."""
    return grants_of_sids(acl_sids(blob))


def grants_of_sids(sids: Column) -> Column:
    rids = F.array_distinct(F.filter(F.transform(sids, lambda s: s["rid"]), lambda r: r.isNotNull()))
    everyone = F.exists(sids, lambda s: s["sid"] == EVERYONE).cast("int")
    empty = F.array().cast("array<long>")
    return F.struct(F.coalesce(rids, empty).alias("rids"), F.coalesce(everyone, F.lit(0)).alias("everyone"))


def rid_of_sid(sid: Column) -> Column:
    """Last part of an identifier's text, NULL when it is not a number."""
    return F.element_at(F.split(sid, "-"), -1).try_cast("long")


def rid_of_sid_bytes(sid: Column) -> Column:
    """Last part of binary identifier, JVM-side; NULL below 12 bytes."""
    last = (_byte(sid, F.lit(2)) * 4 + 4).cast("int")
    return F.when(F.octet_length(sid) >= 12, u32(sid, last))


def format_sid(sid: Column) -> Column:
    """Binary identifier to text, JVM-side."""
    authority = F.conv(F.hex(F.substring(sid, 3, 6)), 16, 10)
    count = _byte(sid, F.lit(2)).cast("int")
    subs = F.transform(
        F.filter(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: i < count),
        lambda i: u32(sid, i * 4 + 8).cast("string"),
    )
    head = F.concat(F.lit("S-"), _byte(sid, F.lit(1)).cast("string"), F.lit("-"), authority)
    return F.when(F.octet_length(sid) >= 8, F.concat_ws("-", head, F.array_join(subs, "-")))


def sid_hex(subs: list[Column], authority: int = 5) -> Column:
    """Hex text of a binary identifier (revision 1)."""
    head = F.lit(f"01{len(subs):02X}{authority:012X}")
    return F.concat(head, *[u32_hex(s) for s in subs])


def sid_name(sid: Column) -> Column:
    """Readable name of a well-known or domain identifier, else the identifier itself."""
    rid = F.element_at(F.split(sid, "-"), -1)
    known = F.try_element_at(literal_map(WELL_KNOWN_RID), rid)
    tail = F.concat(F.lit(" (RID: "), rid, F.lit(")"))
    domain = F.when(known.isNotNull(), F.concat(F.lit("Domain: "), known, tail)).otherwise(
        F.concat(F.lit("Domain User/Group"), tail)
    )
    is_domain = sid.startswith("S-1-5-21-") & (F.size(F.split(sid, "-")) >= 8)
    return F.coalesce(F.try_element_at(literal_map(WELL_KNOWN_SID), sid), F.when(is_domain, domain), sid)


def _bits(value: Column, table: list[tuple[int, str]]) -> Column:
    names = [F.when(value.bitwiseAND(F.lit(bit).cast("long")) != 0, F.lit(name)) for bit, name in table]
    return F.filter(F.array(*names), lambda n: n.isNotNull())


def mask_rights(mask: Column) -> Column:
    """Rights of an access mask; three masks have their own name, an empty list becomes ``Custom: 0x...``."""
    m = mask.cast("long")
    rights = _bits(m, RIGHT_BITS)
    custom = F.array(F.concat(F.lit("Custom: 0x"), F.lpad(F.hex(m), 8, "0")))
    out = F.when(F.size(rights) > 0, rights).otherwise(custom)
    for value, name in RIGHT_COMBINATIONS.items():
        out = F.when(m == value, F.array(F.lit(name))).otherwise(out)
    return out


def control_flags(control: Column) -> Column:
    return _bits(control.cast("long"), CONTROL_FLAGS)


def ace_type_name(code: Column) -> Column:
    text = code.cast("string")
    return F.coalesce(
        F.try_element_at(literal_map(ACE_TYPES), text), F.concat(F.lit("Unknown ("), text, F.lit(")"))
    )


def principal_type(sid: Column, rid: Column) -> Column:
    """EVERYONE, BUILTIN_GROUP, USER (RID from 1000), GROUP or UNKNOWN."""
    return (
        F.when(sid == EVERYONE, "EVERYONE")
        .when(sid.startswith("S-1-5-32-"), "BUILTIN_GROUP")
        .when(sid.startswith("S-1-5-21-") & (rid >= 1000), "USER")
        .when(sid.startswith("S-1-5-21-"), "GROUP")
        .otherwise("UNKNOWN")
    )
