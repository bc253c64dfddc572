"""Blob decoding against a literal byte loop, and the edge cases of the fixtures."""

import random
import struct

from pyspark.sql import functions as F

from foliant.functions import acl
from foliant.operators import grants as gr


def brute_force(data):
    found = []
    for i in range(len(data) - 8):
        n = data[i + 1]
        if data[i] == 1 and 0 < n <= 15 and i + 8 + 4 * n <= len(data):
            subs = [struct.unpack_from("<I", data, i + 8 + 4 * j)[0] for j in range(n)]
            sid = f"S-1-{int.from_bytes(data[i + 2:i + 8], 'big')}" + "".join(f"-{s}" for s in subs)
            parts = sid.split("-")
            rid = subs[-1] if len(parts) >= 8 and parts[3] == "21" else None
            mask = struct.unpack_from("<I", data, i - 4)[0] if i >= 4 else None
            found.append((i, sid, rid, mask))
    return found


def domain_sid(rid, mask=7):
    return struct.pack("<I", mask) + bytes([1, 5]) + (5).to_bytes(6, "big") + struct.pack("<5I", 21, 1, 2, 3, rid)


EVERYONE = bytes([0, 0, 0, 0, 1, 1]) + (1).to_bytes(6, "big") + bytes(4)


def test_scan_equals_byte_loop_on_random_blobs(spark):
    rnd = random.Random(11)
    pool = [domain_sid(5), EVERYONE, b"\x01\x02\x03", bytes(9)]
    blobs = [bytearray(rnd.choice([0, 1, 1, 2, 5, 21, 255]) for _ in range(rnd.randrange(0, 90))) for _ in range(300)]
    blobs += [bytearray(b"".join(rnd.choice(pool) for _ in range(5))) for _ in range(100)]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(blobs)], "i int, b binary")
    got = {r["i"]: [tuple(s) for s in r["s"]] for r in df.select("i", acl.acl_sids("b").alias("s")).collect()}
    assert got == {i: brute_force(bytes(b)) for i, b in enumerate(blobs)}


def test_grants_keep_first_seen_order_and_flags(spark):
    data = bytes(20) + domain_sid(900) + EVERYONE + domain_sid(17) + domain_sid(900)
    rows = [(1, bytearray(data)), (2, bytearray(b"")), (3, bytearray(b"\x01\x01")), (4, None)]
    df = spark.createDataFrame(rows, "FOLDER_ID int, VALUE binary")
    got = {r["FOLDER_ID"]: (r["rids"], r["everyone"]) for r in gr.decode_grants(df, ["FOLDER_ID"]).collect()}
    assert got == {1: ([900, 17], 1), 2: ([], 0), 3: ([], 0)}


def test_hex_text_with_and_without_prefix_and_bad(spark):
    hex_text = domain_sid(42).hex()
    df = spark.createDataFrame([("0x" + hex_text,), (hex_text,), ("0xZZ",)], "t string")
    got = [r["g"]["rids"] for r in df.select(acl.acl_grants(acl.blob_of_hex(F.col("t"))).alias("g")).collect()]
    assert got == [[42], [42], []]


def test_a_rid_can_be_user_and_group_at_once(spark):
    df = spark.createDataFrame([(1, bytearray(domain_sid(5) + domain_sid(6) + domain_sid(7)))], "FOLDER_ID int, VALUE binary")
    users = spark.createDataFrame([(5,), (6,)], "USER_ID int")
    groups = spark.createDataFrame([(5,)], "GROUP_ID int")
    row = gr.folder_access(df, users, groups).first()
    assert (row["User"], row["Group"], row["RID"], row["Everyone"]) == ("5|6", "5", "5|6|7", 0)
    done, extended = gr.refresh_grants(df, users, groups.withColumn("GROUPNAME", F.lit("g")), ["FOLDER_ID"])
    assert done.first()["Group"] == "5|7"
    assert {r["GROUP_ID"] for r in extended.collect()} == {5, 7}


def test_sid_text_rid_and_names(spark):
    known = spark.createDataFrame([("S-1-1-0",), ("S-1-5-21-1-2-3-512",), ("S-1-5-21-1-2-3-4000",), ("S-1-9-9",)], "s string")
    names = [r[0] for r in known.select(acl.sid_name(F.col("s"))).collect()]
    assert names == ["Everyone", "Domain: Domain Admins (RID: 512)", "Domain User/Group (RID: 4000)", "S-1-9-9"]
    raw = spark.createDataFrame([(bytearray(domain_sid(4294967295)[4:]),), (bytearray(b"\x01\x00" + bytes(6)),)], "b binary")
    out = raw.select(acl.format_sid(F.col("b")).alias("s"), acl.rid_of_sid_bytes(F.col("b")).alias("r")).collect()
    assert tuple(out[0]) == ("S-1-5-21-1-2-3-4294967295", 4294967295)
    assert out[1]["r"] is None and out[1]["s"].startswith("S-1-0")


def test_descriptor_with_broken_list_has_no_entries(spark):
    head = struct.pack("<BBHIIII", 1, 0, 0x8004, 0, 0, 0, 20)
    good = head + struct.pack("<BBHHH", 2, 0, 0, 1, 0) + struct.pack("<BBHI", 1, 0, 20, 0x10000) + EVERYONE[4:]
    broken = head + struct.pack("<BBHHH", 2, 0, 0, 9, 0)
    df = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(broken)), (3, bytearray(b"x"))], "k int, VALUE binary")
    rows = gr.descriptor_aces(df).collect()
    assert [(r["k"], r["ace_type"], r["rights"], r["sid_name"]) for r in rows] == [(1, "ACCESS_DENIED_ACE_TYPE", ["DELETE"], "Everyone")]


def test_translate_keeps_order_unmapped_and_first_mapping(spark):
    df = spark.createDataFrame([(1, "5|x|9|5", "5", "5"), (2, "", "8", "")], "FOLDER_ID int, RID string, Group string, User string")
    mapping = spark.createDataFrame(
        [("5", "group", "g", 500), ("5", "user", "u", 700), ("9", "group", "n", 900)], "Original_ID string, Object_Type string, Name string, AD_RID long"
    )
    mixed = {r["FOLDER_ID"]: r for r in gr.translate_all({"folders": df}, mapping)["folders"].collect()}
    assert (mixed[1]["RID"], mixed[1]["Group"], mixed[1]["User"], mixed[1]["translated"]) == ("700|x|900|700", "700", "5", 4)
    assert (mixed[2]["RID"], mixed[2]["Group"], mixed[2]["unmapped"]) == ("", "8", 1)
    typed = {r["FOLDER_ID"]: r for r in gr.translate_all({"folders": df}, mapping, by_type=True)["folders"].collect()}
    assert typed[1]["Group"] == "500"
