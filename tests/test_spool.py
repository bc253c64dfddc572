"""Spool scanning, pagination, search, and line classification against a literal scorer."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from foliant.operators import spool as sp
from foliant.sources import files as fs


def score(line, template):
    """Position by position, with the weights as fractions."""
    t = template.rstrip()
    t = t[:-1].rstrip() if t.endswith("*") else t
    if not t or (not line.rstrip() and len(t) > 10):
        return 0.0
    got = total = 0.0
    for i, want in enumerate(t):
        c = line[i] if i < len(line) else " "
        if want in "A9":
            total += 1
            same, other, signs = (str.isalpha, str.isdigit, "*#@&()") if want == "A" else (str.isdigit, str.isalpha, "*#.,-+")
            got += 1 if same(c) else 0.7 if other(c) else 0.5 if c in signs else 0.3 if c == " " else 0
        elif want == " ":
            total += 0.5
            got += 0.5 if c == " " else 0.1
        else:
            total += 3
            got += 3 if c == want else 0
    return got / total


ALPHABET = "Ab9 1-/.,:*#@&()+é"


@pytest.fixture(scope="module")
def pairs():
    rnd = random.Random(5)
    text = lambda letters, n: "".join(rnd.choice(letters) for _ in range(rnd.randrange(n)))
    return [(text(ALPHABET, 30), text("AA99  -/.", 25) + rnd.choice(["", "*", "*  "])) for _ in range(400)]


def test_template_score_equals_literal_scorer(spark, pairs):
    df = spark.createDataFrame(pd.DataFrame(pairs, columns=["l", "t"])).withColumn("i", F.monotonically_increasing_id())
    got = [r["s"] for r in df.select("i", sp.template_score("l", "t").alias("s")).orderBy("i").collect()]
    assert got == pytest.approx([score(*p) for p in pairs], abs=1e-12)


def test_classify_picks_best_template_and_lowest_id_on_ties(spark):
    pages = spark.createDataFrame(
        [(1, 1, 7, "12-34 ABC\r\nhello world\n\n???"), (1, 2, 8, "12-34 ABC")], "file int, page int, STRUCTURE_DEF_ID int, text string"
    )
    lines = spark.createDataFrame(
        [(7, 9, "99-99 AAA*   "), (7, 3, "99-99 AAA*"), (7, 4, "AAAAA AAAAA*"), (7, 1, "   *")], "STRUCTURE_DEF_ID int, LINE_ID int, TEMPLATE string"
    )
    got = {(r["page"], r["line_no"]): r["LINE_ID"] for r in sp.classify_lines(pages, lines).collect()}
    assert got == {(1, 1): 3, (1, 2): 4, (1, 3): None, (1, 4): None, (2, 1): None}


def test_records_are_cut_by_column(spark):
    pages = spark.createDataFrame([("f", 1, 7, "12-34 \tABC ")], "file string, page int, STRUCTURE_DEF_ID int, text string")
    lines = spark.createDataFrame([(7, 3, "L3 ", "99-99 AAAA*")], "STRUCTURE_DEF_ID int, LINE_ID int, NAME string, TEMPLATE string")
    fields = spark.createDataFrame(
        [(7, 3, 1, "NO", 0, 4), (7, 3, 2, "NAME", 5, 99), (7, 3, 3, "FAR", 40, 50)],
        "STRUCTURE_DEF_ID int, LINE_ID int, FIELD_ID int, NAME string, START_COLUMN int, END_COLUMN int",
    )
    rows = sp.extract_fields(sp.classify_lines(pages, lines), fields, lines)
    assert {r["FIELD_NAME"]: r["value"] for r in rows.collect()} == {"NO": "12-34", "NAME": "ABC", "FAR": ""}
    record = sp.field_records(rows).first()["record"]
    assert record == '[{"name":"NO","value":"12-34"},{"name":"NAME","value":"ABC"},{"name":"FAR","value":""}]'


def test_scan_numbers_lines_across_splits(spark, tmp_path):
    text = [f"line {i} of the spool file" for i in range(4000)]
    (tmp_path / "a.txt").write_bytes("\r\n".join(text).encode())
    (tmp_path / "b.txt").write_bytes(b"only\none more")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = fs.scan_spool(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 1
        got = {(r["file"], r["line_no"]): r["text"] for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {("a.txt", i + 1): t for i, t in enumerate(text)} | {("b.txt", 1): "only", ("b.txt", 2): "one more"}
    assert got == want


def paged(spark, lines, **kw):
    df = spark.createDataFrame([("f", i + 1, t) for i, t in enumerate(lines)], "file string, line_no long, text string")
    return [(r["page"], r["line_in_page"]) for r in sp.paginate(df, **kw).orderBy("line_no").collect()]


def test_first_line_never_starts_a_second_page(spark):
    assert paged(spark, ["\fa", "b", "\fc", "d\f"]) == [(1, 0), (1, 1), (2, 0), (2, 1)]
    assert paged(spark, ["1 a", "  b", "1c", "0 d"]) == [(1, 0), (1, 1), (2, 0), (2, 1)]
    assert paged(spark, ["1a", "1b", "1c"]) == [(1, 0), (1, 1), (1, 2)]


def test_form_feeds_inside_lines_start_pages(spark):
    assert paged(spark, ["x\fy", "z"]) == [(1, 0), (2, 1)]
    assert paged(spark, ["a\fb\fc", "d\fe", "\ff", "g"]) == [(1, 0), (3, 1), (5, 0), (5, 1)]


def test_fixed_pages_ignore_control_characters(spark):
    assert paged(spark, ["\fa", "\fb", "\fc"], mode=2) == [(1, 0), (1, 1), (2, 0)]


def test_spool_format_looks_at_the_first_hundred_bytes(spark):
    rows = [("ff", 1, "x" * 98), ("ff", 2, "\f"), ("late", 1, "1" + "x" * 120), ("late", 2, "\f"), ("none", 1, "abc"), ("wide", 1, "1" + "é" * 70 + "\f")]
    df = spark.createDataFrame(rows, "file string, line_no long, text string")
    assert {r["file"]: r["format"] for r in sp.detect_spool_format(df).collect()} == {"ff": "form_feed", "late": "asa", "none": "form_feed", "wide": "asa"}


def test_search_is_literal_and_non_overlapping(spark):
    df = spark.createDataFrame([(1, "a.a.a.a"), (2, "aXa"), (3, "A.a É"), (4, "q\\E q\\E")], "line_no long, text string")
    hits = lambda term, case=False: [(r["line_no"], r["match_start"]) for r in sp.search_lines(df, term, case).orderBy("line_no", "match_start").collect()]
    assert hits("a.a", True) == [(1, 0), (1, 4)]
    assert hits(" A.A ") == [(1, 0), (1, 4), (3, 0)]
    assert hits("é") == [(3, 4)]
    assert hits("\\E") == [(4, 1), (4, 5)]
    assert hits("   ") == []


def test_positions_give_the_first_line_with_byte_offset(spark):
    lines = spark.createDataFrame([("f", 1, "é head"), ("f", 2, "\fvalue 12"), ("f", 3, "value 12")], "file string, line_no long, text string")
    row = sp.spool_positions(["value 12", "gone"], sp.paginate(lines), eol_bytes=2).collect()
    assert [tuple(r) for r in row] == [("f", "value 12", 2, 2, 0, 9)]


def test_pages_without_structure_or_text_keep_their_lines(spark):
    pages = spark.createDataFrame([("f", 1, 1, "A1"), ("f", 2, None, "x\ny"), ("f", 3, 1, None)], "file string, page int, STRUCTURE_DEF_ID int, text string")
    templates = spark.createDataFrame([(1, 5, "A9")], "STRUCTURE_DEF_ID int, LINE_ID int, TEMPLATE string")
    rows = sp.classify_lines(pages, templates).collect()
    assert sorted((r["page"], r["line_no"], r["text"]) for r in rows) == [(1, 1, "A1"), (2, 1, "x"), (2, 2, "y"), (3, 1, "")]
    assert {r["LINE_ID"] for r in rows if r["page"] > 1} == {None}
