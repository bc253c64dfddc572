"""Report containers and index files: edge cases of the layouts, real files on disk, readback."""

import json
import os
import struct

import pytest

from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, StringContains

from __spark_entry__ import queries
from foliant.operators import containers as ct
from foliant.operators.containers import SECTION_COUNT_AT
from foliant.operators import filters as fl
from foliant.operators import instances as ins
from foliant.operators import mapindex as mi
from foliant.operators import mapsearch as ms
from foliant.operators import search as se
from foliant.operators import sets as st
from foliant.plans.encode import container, index
from foliant.sources import files as fs
from foliant.sources import pages as ps
from foliant.sources import ranges as rg


def frame(spark, **named):
    rows = [(n, bytearray(c), len(c)) for n, c in named.items()]
    return spark.createDataFrame(rows, "file string, content binary, length long")


PAGES = [f"page {i}\nline".encode() for i in range(1, 8)]


def test_invalid_file_is_flagged_in_the_header_and_skipped_elsewhere(spark):
    files = frame(spark, a=container(12, PAGES, [(5, 1, 2)]), b=b"junk", c=b"")
    got = {r["file"]: (r["valid"], r["species_id"], r["page_count"]) for r in ct.rpt_header(files).collect()}
    assert got["a"] == (True, 12, 7) and not got["b"][0] and not got["c"][0]
    assert {r["file"] for r in ct.rpt_page(files).collect()} == {"a"}
    assert [tuple(r) for r in ct.rpt_inventory(files).collect()] == [("a", 12, 1, 7, "")]


def test_sections_stop_at_zero_row_near_the_data_and_skip_bad_rows(spark):
    near = container(1, PAGES, [(5, 1, 2), (6, 0, 3), (0, 0, 0), (7, 3, 1)])
    # a wrong end of data sends the search through the whole file, up to ENDDATA, zero rows only skipped
    far = bytearray(near)
    struct.pack_into("<I", far, 0x1E8, 0)
    rows = ct.rpt_section(frame(spark, near=near, far=bytes(far))).collect()
    got = {}
    for r in rows:
        got.setdefault(r["file"], []).append((r["section_id"], r["start_page"], r["page_count"]))
    assert got == {"near": [(5, 1, 2)], "far": [(5, 1, 2), (7, 3, 1)]}


def test_pages_out_of_range_broken_or_cut_off_are_reported(spark):
    good = container(1, PAGES, [])
    broken = bytearray(good)
    broken[0x200:0x204] = b"\xff\xff\xff\xff"
    files = frame(spark, good=good, broken=bytes(broken))
    wanted = spark.createDataFrame([("good", 2), ("good", 2), ("good", 9), ("broken", 1), ("none", 1)], "file string, page long")
    got = {(r["file"], r["page"]): (r["status"], r["text"]) for r in ct.page_text(files, wanted).collect()}
    assert got == {("good", 2): ("ok", "page 2\nline"), ("good", 9): ("out_of_range", None), ("broken", 1): ("inflate_error", None)}


def test_object_document_with_header_page(spark):
    header = b"Vendor Object Header Page:\nObject File Name: stmt.PDF\nAuthor: x"
    files = frame(spark, **{"r.RPT": container(1, [header, b"text"], [], [b"not magic ", b"rest"]), "p.rpt": container(1, [b"t"], [], [b"%PDF-x"])})
    got = {r["file"]: (r["document_name"], r["format"], bytes(r["document"])) for r in ct.rpt_document(files).collect()}
    assert got == {"r.RPT": ("stmt.PDF", "PDF", b"not magic rest"), "p.rpt": ("p_binary.pdf", "PDF", b"%PDF-x")}
    pages = ct.page_text(files)
    kept = {(r["file"], r["page"]) for r in ct.report_text(pages, "page", ct.rpt_object(files)).collect()}
    assert kept == {("r.RPT", 2), ("p.rpt", 1)}
    joined = {r["file"]: r["text"] for r in ct.report_text(pages, "concat").collect()}
    assert joined["r.RPT"] == header.decode() + "\f\ntext"


def test_section_selection_order_duplicates_and_unknown_ids(spark):
    pages = spark.createDataFrame([("f", p) for p in range(1, 8)], "file string, page long")
    sections = spark.createDataFrame(
        [("f", 1, 10, 2, 2), ("f", 2, 20, 1, 3), ("f", 3, 10, 6, 99), ("f", 4, 30, 4, 0)],
        "file string, position int, section_id long, start_page long, page_count long",
    )
    chosen, skipped = fl.pages_in_sections(pages, sections, [20, 10, 44])
    got = [(r["section_id"], r["page"]) for r in chosen.orderBy("request_pos", "page").collect()]
    assert got == [(20, 1), (20, 2), (20, 3), (10, 6), (10, 7)]
    assert [r["section_id"] for r in skipped.collect()] == [44]
    single, _ = fl.pages_in_sections(pages, sections, [10])
    assert sorted(r["page"] for r in single.collect()) == [2, 3]


def test_selection_rules():
    assert fl.parse_selection("ALL").kind == "all"
    assert fl.parse_selection("5").ranges == [(5, 5)]
    assert fl.parse_selection("pages: 1-5, 10-20").ranges == [(1, 5), (10, 20)]
    assert fl.parse_selection("section:14").sections == [14]
    for bad in ("lines:3", "1-x"):
        with pytest.raises(ValueError):
            fl.parse_selection(bad)


def test_rules_kept_in_a_column(spark):
    df = spark.createDataFrame([("pages: 1-5,10",), ("7, x, 9 - 12",), ("",)], "rule string")
    got = [[tuple(r) for r in row[0]] for row in df.select(fl.ranges_of_rule(F.col("rule"))).collect()]
    assert got == [[(1, 5), (10, 10)], [(7, 7), (9, 12)], []]


def test_segment_of_a_field_is_the_first_and_never_the_lookup(spark):
    content = index([(4, 2, 6, [("AB", 2)]), (4, 2, 3, [("X1", 8)])])
    segs = mi.map_segment(frame(spark, m=content))
    assert [r["segment_no"] for r in ins.find_segment(segs, 4, 2).collect()] == [1]
    assert ins.find_segment(segs, 0, 0).count() == 0


def entry_rows(spark, content):
    return mi.map_entry(frame(spark, m=content)).orderBy("segment_no", "entry_no").collect()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 300])
def test_index_format_is_told_from_the_key_table(spark, n):
    """Entries are keyed where segment 0 knows their numbers; without a key table they are pages, odd ones too."""
    for pages in ([1] * n, [2 * i + 1 for i in range(n)], list(range(1, n + 1))):
        plain = entry_rows(spark, index([(4, 2, 6, [(f"v{i:03}", page) for i, page in enumerate(pages)])]))
        assert [(r["page"], r["format"]) for r in plain] == [(page, "page") for page in pages]
    keys = [(2 * i + 1, i + 7) for i in range(300)]
    mixed = index([(4, 2, 6, [(f"v{i:03}", 2 * i + 1) for i in range(n)]), (5, 2, 6, [(f"v{i:03}", 2 * i + 2) for i in range(n)])], keys)
    rows = mi.map_entry(frame(spark, m=mixed), resolve=True).orderBy("segment_no", "entry_no").collect()
    assert [(r["page"], r["format"]) for r in rows] == [(i + 7, "u32_index") for i in range(n)] + [(2 * i + 2, "page") for i in range(n)]


def stored_indexes(spark, tmp_path):
    """Plain, keyed, unsorted, repeated, broken and large files."""
    many = [(f"k{i // 3:05}", 2 * i + 1) for i in range(30_000)]
    files = {
        "plain": index([(4, 2, 6, [("AB", 1), ("AB", 3), ("ABC", 2), ("B", 4)]), (4, 2, 6, [("AB", 9)]), (9, 1, 200, [("w" * 200, 5)])], lookups=[(1, 4, 2, 0)]),
        "keyed": index([(4, 2, 6, many), (5, 2, 3, [("--", 2), ("AB", 2)])], [(key, i + 1) for i, (_, key) in enumerate(many)]),
        "unsorted": index([(4, 2, 6, [("B", 8), ("AB", 6), (" AB", 1), ("", 2)])]),
        "repeated keys": index([(4, 2, 4, [("AB", 1), ("B", 3), ("C", 9)])], [(1, 70), (3, 2), (1, 7)]),
        "no entries": index([(4, 2, 6, [])]),
        "no segments": index([]),
        "broken": b"broken",
        "empty": b"",
    }
    unchained = bytearray(files["plain"])
    at = unchained.find("**ME".encode("utf-16le"))
    unchained[at + 16 : at + 20] = bytes(4)
    for name, data in (files | {"unchained": bytes(unchained)}).items():
        (tmp_path / f"{name}.map").write_bytes(data)
    listed = rg.list_files(spark, str(tmp_path), "*.map")
    return listed, fs.scan_map(spark, str(tmp_path)).withColumn("file", F.col("path"))


def test_segments_of_stored_files_by_headers(spark, tmp_path):
    listed, whole = stored_indexes(spark, tmp_path)
    got = ms.read_segments(listed)
    assert sorted(map(tuple, got.drop("bytes_read").collect())) == sorted(map(tuple, mi.map_segment(whole).collect()))
    read = {r["file"]: r["bytes_read"] for r in got.collect()}
    (large,) = [n for f, n in read.items() if f.endswith("/keyed.map")]
    assert large < 8_000


def test_search_in_stored_files_equals_decoding(spark, tmp_path):
    listed, whole = stored_indexes(spark, tmp_path)
    catalogue = ms.index_catalogue(listed).cache()
    for prefix in (False, True):
        for value in (" AB ", "B", "ABC", "k00000", "k05000", "k09999", "k1", "k0012", "zz", "w" * 200, "--"):
            for line, field in ((4, 2), (5, 2), (9, 1)):
                want = mi.map_entry(whole, line, field, value, prefix, resolve=True)
                got = ms.search_stored(catalogue, line, field, value, prefix)
                assert sorted(map(tuple, got.drop("bytes_read").collect())) == sorted(map(tuple, want.collect())), (value, prefix)
    size = {r["file"]: r["length"] for r in listed.collect()}
    for row in ms.search_stored(catalogue, 4, 2, "k05000").collect():
        # about log2(390,000 / 4096) blocks of entries and as many of keys
        assert row["bytes_read"] < 24 * ms.BLOCK and size[row["file"]] > 800_000
    assert [r["page"] for r in ms.search_stored(catalogue, 4, 2, "k05000").orderBy("page").collect()] == [15_001, 15_002, 15_003]
    assert ms.search_stored(catalogue, 7, 7, "AB").count() == 0


def test_blank_values_are_skipped_but_counted_in_the_sample(spark):
    rows = entry_rows(spark, index([(4, 2, 6, [("", 2), ("--", 3), ("AB", 5)])]))
    assert [(r["value"], r["page"], r["entry_no"]) for r in rows] == [("AB", 5, 2)]


def test_entries_end_where_the_length_field_differs_and_second_segment_is_separate(spark):
    content = index([(4, 2, 6, [("AB", 2), ("CD", 4)]), (4, 2, 3, [("X1", 8)]), (9, 1, 3, [("Y1", 6)])])
    rows = entry_rows(spark, content)
    assert [(r["segment_no"], r["value"]) for r in rows] == [(1, "AB"), (1, "CD"), (2, "X1"), (3, "Y1")]
    first = mi.map_entry(frame(spark, m=content), 4, 2).collect()
    assert {r["segment_no"] for r in first} == {1}


def test_keys_without_page_give_zero_and_the_last_record_wins(spark):
    content = index([(4, 2, 4, [("A1", 1), ("B1", 3), ("C1", 9)])], [(1, 70), (3, 2), (1, 7)])
    files = frame(spark, m=content)
    want = {"A1": 7, "B1": 2, "C1": 0}
    joined = mi.resolve_pages(mi.map_entry(files), mi.map_page_key(files))
    assert {r["value"]: r["page"] for r in joined.collect()} == want
    assert {r["value"]: r["page"] for r in mi.map_entry(files, resolve=True).collect()} == want


def test_exact_and_prefix_search(spark):
    files = frame(spark, m=index([(4, 2, 6, [("AB", 2), ("ABC", 4), ("B", 6)])]))
    entries = mi.map_entry(files)
    exact = lambda df: sorted(r["value"] for r in df.collect())
    assert exact(mi.search_index(entries, 4, 2, " AB ")) == ["AB"]
    assert exact(mi.search_index(entries, 4, 2, "AB", prefix=True)) == ["AB", "ABC"]
    assert exact(mi.map_entry(files, 4, 2, "AB")) == ["AB"]


def test_scans_read_real_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "A.RPT").write_bytes(container(3, PAGES, [(5, 1, 7)]))
    (tmp_path / "sub" / "b.rpt").write_bytes(container(4, PAGES[:1], []))
    (tmp_path / "x.MAP").write_bytes(index([(4, 2, 6, [("AB", 2)])]))
    (tmp_path / "y.map").write_bytes(b"broken")
    assert {r["file"] for r in fs.scan_rpt(spark, str(tmp_path)).collect()} == {"A.RPT", "b.rpt"}
    flat = fs.scan_rpt(spark, str(tmp_path), recursive=False)
    assert {r["species_id"] for r in ct.rpt_header(flat).collect()} == {3}
    maps = {r["file"]: r["header_valid"] for r in mi.map_header(fs.scan_map(spark, str(tmp_path))).collect()}
    assert maps == {"x.MAP": True, "y.map": False}
    assert [r["file"] for r in fs.scan_map(spark, str(tmp_path), limit=1).collect()] == ["x.MAP"]


def test_candidate_ids_read_numbers_of_the_segment_head(spark):
    files = frame(spark, m=index([(4, 2, 6, [("AB", 2)])]))
    rows = mi.candidate_ids(files).collect()
    assert {4, 2, 6} <= set(next(r["candidates"] for r in rows if r["segment_no"] == 1))


def test_field_metadata_keeps_the_last_definition(spark, tmp_path):
    doc = {"species": {"name": "S"}, "indexed_fields": [{"name": " acc ", "line_id": 1, "field_id": 2}, {"name": "ACC", "line_id": 4, "field_id": 2}]}
    (tmp_path / "m.json").write_text(json.dumps(doc, indent=1))
    rows = fs.read_field_metadata(spark, str(tmp_path)).collect()
    assert [(r["field_key"], r["line_id"]) for r in rows] == [("ACC", 4)]


def test_match_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("m", "ACC", 1, "page", i, f"v{i}", i, 0) for i in range(5)],
                                 "file string, field string, segment_no long, format string, entry_no long, value string, page long, u32_key long")
    docs = fs.match_documents(rows, part_rows=2).orderBy("part").collect()
    assert [(d["part"], d["match_count"], len(d["matches"])) for d in docs] == [(0, 5, 2), (1, 5, 2), (2, 5, 1)]
    fs.write_matches(rows, "json", str(tmp_path / "j"), 100_000)
    fs.write_matches(rows, "csv", str(tmp_path / "c"), 100_000)
    assert spark.read.json(str(tmp_path / "j")).first()["match_count"] == 5
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 5
    with pytest.raises(ValueError):
        fs.write_matches(rows, "xml", str(tmp_path / "x"), 100_000)


def test_search_to_records_with_sections_and_day(spark):
    pages = [b"ACCT 1001 Ann\n----", b"ACCT 1002 Bob", b"ACCT 1001 Cid"]
    rpt = frame(spark, **{"D1.RPT": container(9, pages, [(11, 1, 2), (12, 3, 1)])})
    maps = frame(spark, **{"D1.MAP": index([(4, 2, 4, [("1001", 2 - 1), ("1001", 3), ("1002", 2)])])})
    at = lambda *rest: spark.sql(f"SELECT 1 DOMAIN_ID, 9 REPORT_SPECIES_ID, timestamp_ntz'2024-05-01 10:00:00' AS_OF_TIMESTAMP, 0 REPROCESS_IN_PROGRESS{''.join(rest)}")
    tables = {
        "REPORT_SPECIES_NAME": spark.createDataFrame([(1, 9, 0, "DAILY LIST  ")], "DOMAIN_ID int, REPORT_SPECIES_ID int, ITEM_ID int, NAME string"),
        "REPORT_INSTANCE": at(", 7 STRUCTURE_DEF_ID"),
        "SST_STORAGE": at(", 1 MAP_FILE_ID"),
        "MAPFILE": spark.createDataFrame([(1, "X\\D1.MAP  ")], "MAP_FILE_ID int, FILENAME string"),
        "RPTFILE_INSTANCE": at(", 1 RPT_FILE_ID"),
        "RPTFILE": spark.createDataFrame([(1, "X\\D1.RPT")], "RPT_FILE_ID int, FILENAME string"),
        "LINE": spark.createDataFrame([(7, 4, "DETAIL", "AAAA 9999 AAA*")], "STRUCTURE_DEF_ID int, LINE_ID int, NAME string, TEMPLATE string"),
        "FIELD": spark.createDataFrame([(7, 4, 2, "ACCOUNT", 5, 8), (7, 4, 3, "NAME", 10, 20)],
                                       "STRUCTURE_DEF_ID int, LINE_ID int, FIELD_ID int, NAME string, START_COLUMN int, END_COLUMN int"),
    }
    find = lambda **kw: sorted((r["page"], r["FIELD_NAME"], r["value"]) for r in se.search_and_extract(tables, rpt, maps, "DAILY", "account ", "1001", **kw).collect())
    everything = [(1, "ACCOUNT", "1001"), (1, "NAME", "Ann"), (3, "ACCOUNT", "1001"), (3, "NAME", "Cid")]
    assert find() == everything
    assert find(day="2024-05-01", prefix=False) == everything
    assert find(day="2024-05-02") == []
    assert find(sections=[12]) == everything[2:]
    assert find(lines=[5]) == [] and find(detail_only=True) == everything


def test_readback_finds_a_changed_page(spark):
    files = frame(spark, a=container(1, PAGES, []))
    expected = spark.createDataFrame([("a", i + 1, p.decode() if i else "other") for i, p in enumerate(PAGES)], "file string, page long, text string")
    bad = ct.readback(ct.page_text(files).select("file", "page", "text"), expected, ["file", "page"])
    assert [(r["page"], r["status"]) for r in bad.collect()] == [(1, "mismatch")]
    assert st.verdict(bad).first()["verdict"] == "FAIL"


def test_index_without_limits_on_width_sample_and_segments(spark):
    """Wide fields, an even number late in a segment, more than twenty segments, values of signs."""
    wide = "w" * 200
    late = [(f"v{i:03d}", 2 * i + 1 if i != 150 else 8) for i in range(300)]
    segments = [(1, 1, 200, [(wide, 4)]), (2, 1, 4, late)] + [(3 + i, 1, 3, [("abc", 2), ("--+", 2), ("", 2)]) for i in range(23)]
    data = index(segments, lookups=[(i + 1, line, field, 0) for i, (line, field, _, _) in enumerate(segments)])
    files = spark.createDataFrame([("a", bytearray(data))], "file string, content binary")
    entries = mi.map_entry(files).collect()
    assert [e.value for e in entries if e.line_id == 1] == [wide]
    assert sum(e.page > 0 for e in entries if e.line_id == 2) == 300
    assert {r.segment for r in mi.map_lookup(files).collect()} == set(range(1, 26))
    assert [e.value for e in entries if e.line_id == 9] == ["abc"]
    assert [e.value for e in mi.map_entry(files, 9, 1, signs=True).collect()] == ["abc", "--+"]


def test_lookup_of_plain_and_keyed_files(spark, tmp_path):
    """Keyed files have a lookup table before their keys; the query reads both kinds, however few entries they have."""
    lines = {2: "Alpha one", 3: "Beta", 4: "Gamma\nDelta", 5: "Alpha\nBeta\nGamma\nDelta", 6: "-"}
    spark.createDataFrame(list(lines.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries()["map_lookup"](spark, str(tmp_path)).collect()
    assert sorted((int(r.doc_id), r.segment, r.line_id, r.field_id) for r in rows) == [(i, 1, 4, 2) for i in (2, 3, 4, 5)]
    keys = [(2 * i + 1, 10 + i) for i in range(100)]
    data = index([(4, 2, 6, [(f"v{i:03d}", key) for i, (key, _) in enumerate(keys)])], keys, [(1, 4, 2, 0)])
    files = spark.createDataFrame([("a", bytearray(data))], "file string, content binary")
    assert [(r.u32_key, r.page) for r in mi.map_page_key(files).collect()] == keys
    rg.write_files(files, str(tmp_path / "maps"))
    catalogue = ms.index_catalogue(rg.list_files(spark, str(tmp_path / "maps"), "a", by_name=True)).cache()
    assert [(r.keyed, r.keys_sorted, r.key_rows) for r in catalogue.collect()] == [(True, True, 100)]
    assert [r.page for r in ms.search_stored(catalogue, 4, 2, "v042").collect()] == [52]


def test_sections_without_a_declared_count_are_all_read(spark):
    data = bytearray(container(7, [b"a"] * 3, [(i + 1, 1, 1) for i in range(1500)]))
    struct.pack_into("<I", data, SECTION_COUNT_AT, 0)
    rows = ct.rpt_section(spark.createDataFrame([("a", data, len(data))], "file string, content binary, length long")).collect()
    assert [r["section_id"] for r in rows] == list(range(1, 1501))


def test_listed_files_are_read_by_ranges(spark, tmp_path):
    """Same rows as from whole contents, equal names in two folders apart, and few bytes read."""
    pages = [b"page %d " % i + bytes(range(256)) * 40 for i in range(30)]
    for folder, species in (("a", 7), ("b", 8)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "same.rpt").write_bytes(container(species, [bytes([species]) * 3 + p for p in pages], [(5, 1, 10), (6, 11, 20)], [b"%PDF-1.4"]))
    (tmp_path / "short.RPT").write_bytes(b"RPTFILEHDR")
    whole = fs.scan_rpt(spark, str(tmp_path)).withColumn("file", F.col("path"))
    listed = rg.list_files(spark, str(tmp_path))
    assert listed.columns == ["file", "path", "length"] and listed.count() == 3
    for operator in (ct.rpt_header, ct.rpt_section, ct.rpt_page, ct.rpt_object):
        assert sorted(map(tuple, operator(listed).collect()), key=repr) == sorted(map(tuple, operator(whole).collect()), key=repr)
    wanted = listed.select("file", F.explode(F.array(*map(F.lit, (2, 29, 31)))).alias("page"))
    for some in (None, wanted):
        assert sorted(map(tuple, ct.page_text(listed, some, "ISO-8859-1").collect())) == sorted(map(tuple, ct.page_text(whole, some, "ISO-8859-1").collect()))
    sizes = {r["path"]: (r["bytes_read"], r["length"]) for r in rg.read_tables(listed).collect()}
    assert all(read <= 512 + 16 + 30 * 24 + 200 for read, _ in sizes.values())
    # nobody wants b, so it may be gone
    only = listed.where(F.col("path").contains("/a/")).select("file", F.lit(3).alias("page")).collect()
    (tmp_path / "b" / "same.rpt").write_bytes(b"")
    assert ct.page_text(listed, spark.createDataFrame(only), "ISO-8859-1").first()["status"] == "ok"


def test_embedded_objects_are_read_by_ranges(spark, tmp_path):
    """Same documents and inventory as from whole contents; only tables, objects and one page are read."""
    pages = [b"page %d " % i + bytes(os.urandom(20_000)) for i in range(40)]
    header = b"Object Header Page: v1\nObject File Name: stmt.PDF\n"
    (tmp_path / "a.rpt").write_bytes(container(7, [header, *pages], [(5, 1, 41)], [b"%PDF-1.4 ", bytes(os.urandom(3000)), b"end"]))
    (tmp_path / "b.rpt").write_bytes(container(8, pages, [(5, 1, 40)], [b"\x5a\x00\x08\xd3\xa8\xa8\x00\x00 rest"]))
    (tmp_path / "none.rpt").write_bytes(container(9, pages, [(5, 1, 40)]))
    broken = bytearray(container(10, [b"t"], [], [b"%PDF-1.4 " + os.urandom(500), b"tail"]))
    broken[broken.index(b"x\x01", 0x200 + 9) + 20] ^= 255
    (tmp_path / "broken.rpt").write_bytes(bytes(broken))
    (tmp_path / "short.rpt").write_bytes(b"RPTFILEHDR")
    (tmp_path / "empty.rpt").write_bytes(b"")
    whole = fs.scan_rpt(spark, str(tmp_path))
    listed = rg.list_files(spark, str(tmp_path), by_name=True)
    for operator in (ct.rpt_document, ct.rpt_inventory):
        got, expected = (sorted(map(tuple, operator(f).collect())) for f in (listed, whole))
        assert got == expected and len(got) >= 3
    assert {r["document_name"] for r in ct.rpt_document(listed).collect()} >= {"stmt.PDF", "b_binary.afp"}


def test_near_places_share_a_read_and_far_ones_do_not(tmp_path):
    data = bytes(range(256)) * 8192
    (tmp_path / "f").write_bytes(data)
    places = [(2_000_000, 10), None, (100, 5), (110, 5), (0, 4), (2_097_150, 50)]
    with rg.open_file(str(tmp_path / "f")) as f:
        found, done = rg.read_runs(f, places)
        assert found == [None if p is None else data[p[0] : p[0] + p[1]] for p in places]
        assert done == 115 + 10 + 2
        assert rg.read_runs(f, []) == ([], 0)


def test_parts_are_counted(spark, tmp_path):
    (tmp_path / "f").write_bytes(bytes(1_000_000))
    kind = "path string, parts array<struct<offset:bigint,span:bigint,size:bigint>>, extra string"
    rows = spark.createDataFrame([(str(tmp_path / "f"), [(0, 10, 10), None, (20, 5, 5), (900_000, 7, 7), (None, None, 3)], "x"), (str(tmp_path / "gone"), [], None)], kind)
    got = [(r["extra"], [p["packed"] and len(p["packed"]) for p in r["parts"]], r["bytes_read"]) for r in rg.read_parts(rows).collect()]
    assert got == [("x", [10, None, 5, 7, None], 32), (None, [], 0)]


class _Counted:
    """An open file that counts the bytes read."""

    def __init__(self, source, log):
        self.source, self.log = source, log

    def read_at(self, n, at):
        part = self.source.read_at(n, at)
        self.log.append(len(part))
        return part

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.source.close()


def test_page_source_opens_only_what_is_asked_for(spark, tmp_path, monkeypatch):
    pages = [b"page %d " % i + os.urandom(9000).hex().encode() for i in range(40)]
    for name in ("a.RPT", "b.rpt", "sub/c.rpt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(container(7, pages, [(5, 1, 40)], [b"%PDF-1.4"]))
    cut = container(7, [b"one", b"two" * 50], [])
    (tmp_path / "cut.rpt").write_bytes(cut[:0x1D4] + (9).to_bytes(4, "little") + cut[0x1D8:])
    (tmp_path / "empty.rpt").write_bytes(b"")
    (tmp_path / "other.txt").write_bytes(b"no container")
    rows = ps.scan_pages(spark, str(tmp_path))
    whole = fs.scan_rpt(spark, str(tmp_path))
    assert sorted(map(tuple, rows.select("file", "page", "status", "text").collect())) == sorted(map(tuple, ct.page_text(whole).collect()))
    some = rows.where("file = 'b.rpt' AND page IN (3, 40, 41)")
    assert sorted((r["file"], r["page"], r["text"].encode() == pages[r["page"] - 1]) for r in some.collect()) == [("b.rpt", 3, True), ("b.rpt", 40, True)]
    assert "Filter" not in some._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]
    assert rows.where("page >= 39 AND length > 500000").count() == rows.where("page + 0 >= 39 AND length > 500000").count()
    assert rows.where("file = 'none'").count() == 0

    opened, log = [], []
    monkeypatch.setattr(ps, "open_file", lambda uri: (opened.append(uri), _Counted(rg.open_file(uri), log))[1])
    reader = ps.PageReader({"path": str(tmp_path)})
    rest = list(reader.pushFilters([EqualTo(("file",), "b.rpt"), In(("page",), (3, 40)), StringContains(("text",), "x")]))
    assert rest == [StringContains(("text",), "x")]
    assert sum(b.num_rows for part in reader.partitions() for b in reader.read(part)) == 2
    assert [o.rpartition("/")[2] for o in opened] == ["b.rpt"]
    assert sum(log) < (tmp_path / "b.rpt").stat().st_size / 5
    packed = ps.PageReader({"path": str(tmp_path), "partitionbytes": "300000", "openbytes": "0"}).partitions()
    assert len(packed) >= 3 and sorted(f for p in packed for f in p.files) == ps.PageReader({"path": str(tmp_path)}).listing()


def test_report_text_is_written_in_ordered_parts(spark, tmp_path):
    texts = {"a.rpt": ["é" * n + f" page {n}" for n in (3, 40, 0, 7, 500, 1)], "b.rpt": ["one"], "c d.rpt": ["", ""]}
    rows = [(f, i, "ok", t) for f, pages in texts.items() for i, t in enumerate(pages, 1)] + [("a.rpt", 9, "out_of_range", None)]
    pages = spark.createDataFrame(rows, "file string, page long, status string, text string").repartition(7)
    target = str(tmp_path / "text")
    ct.write_report_text(pages, target, part_bytes=64)
    got = {}
    for r in sorted(ct.read_report_parts(spark, target).collect()):
        assert len(r["text"].encode()) < 64 + max(len(t.encode()) for t in texts[r["file"]]) + 2
        got[r["file"]] = got.get(r["file"], "") + r["text"]
    assert got == {f: "\f\n".join(pages) + "\n" for f, pages in texts.items()}
    # a part is one file
    assert all(len([n for n in names if n.endswith(".txt")]) == 1 for _, dirs, names in os.walk(target) if not dirs)
    first = {(r["part"], r["byte_offset"]) for r in ct.report_parts(pages, 64).where("file = 'a.rpt'").collect()}
    assert (0, 0) in first and all(at // 64 == part for part, at in first) and len({p for p, _ in first}) > 2
    ct.write_report_text(pages.limit(0), str(tmp_path / "none"))


def test_report_text_is_written_and_listed_by_tasks(spark, tmp_path):
    """The layout is that of Spark's partitioned writer, which could read and write it; nothing passes through the driver."""
    names = ["a.rpt", "c d+e%41.rpt", "x/y=z:é'\"[q]{r}^#?*\\.rpt", "new\nline.rpt"]
    pages = spark.createDataFrame([(f, i, "ok", f"{f} {i} " + "é" * 30) for f in names for i in range(1, 6)], "file string, page long, status string, text string")
    target = tmp_path / "te=xt" / "file=up" / "part=0"
    target.mkdir(parents=True)
    (target / "stale.txt").write_text("of an earlier run")
    ct.write_report_text(pages.repartition(3), str(target), part_bytes=128)
    files = [os.path.join(at, n) for at, _, found in os.walk(target) for n in found]
    # no checksum files or temporary folders of a driver's commit
    assert os.path.exists(target / "_SUCCESS") and {os.path.basename(f) for f in files} <= {"_SUCCESS", "._SUCCESS.crc", "part-00000.txt"}
    own = spark.read.schema("value string, file string, part long").text(str(target), wholetext=True).select("file", "part", "value")
    got = ct.read_report_parts(spark, str(target))
    assert "FileScan" not in got._jdf.queryExecution().toString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, own.collect())) and got.dtypes == [("file", "string"), ("part", "bigint"), ("text", "string")]
    texts = {}
    for r in sorted(got.collect()):
        texts[r["file"]] = texts.get(r["file"], "") + r["text"]
    assert texts == {f: "\f\n".join(f"{f} {i} " + "é" * 30 for i in range(1, 6)) + "\n" for f in names}
    # what Spark's writer left is read as well
    old = str(tmp_path / "old")
    own.write.partitionBy("file", "part").text(old)
    assert {(r["file"], r["part"]) for r in ct.read_report_parts(spark, old).collect()} == {(r["file"], r["part"]) for r in own.collect()}
