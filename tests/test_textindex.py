"""Stored text index against the same search over all lines."""

import random

import pytest
from pyspark.sql import functions as F

from foliant.operators import spool as sp
from foliant.operators import textindex as ti

WORDS = ["Konto", "konto", "KONTO", "straße", "STRASSE", "ΟΔΟΣ", "οδος", "οδοσ", "ſumme", "Summe", "Konto", "日本語の文", "a", "", "İstanbul", "istanbul", "🙂🙂🙂🙂", "x.y*z"]
TERMS = ["konto", "Straße", "οδος", "summe", "日本語", "🙂🙂🙂", "istanbul", "x.y*z", "a", "on", "no such text", "  ", "konto straße", "K" * 70]


@pytest.fixture(scope="module")
def paged(spark):
    rnd = random.Random(3)
    rows = []
    for file in range(6):
        n = 900 if file == 0 else rnd.randrange(1, 150)
        for i in range(1, n + 1):
            text = " ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(6))) + f" {file}-{i}"
            rows.append((file, i, ("\f" if i % 40 == 0 else "") + text))
    rows += [(7, 1, None), (7, 2, ""), (7, 3, "k" * 100), (8, 1, "only here: Zebra")]
    return sp.paginate(spark.createDataFrame(rows, "file long, line_no long, text string").repartition(5)).cache()


@pytest.fixture(scope="module")
def index(paged, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("text") / "index")
    ti.build_text_index(paged, path)
    return path


@pytest.mark.parametrize("case", [False, True])
@pytest.mark.parametrize("term", TERMS)
def test_search_equals_search_of_all_lines(spark, paged, index, term, case):
    cols = ["file", "line_no", "page", "line_in_page", "text", "match_start", "match_length"]
    key = lambda df: sorted(tuple(r) for r in df.select(*cols).collect())
    assert key(ti.search_text_index(spark, index, term, case)) == key(sp.search_lines(paged, term, case))


def test_rare_terms_read_few_lines(spark, paged, index):
    assert ti.candidate_lines(spark, index, ["Zebra"]).count() <= ti.LINES_PER_UNIT
    assert ti.candidate_lines(spark, index, ["no such text"]).count() == 0
    assert ti.candidate_lines(spark, index, ["on"]).count() == paged.count()


def test_every_gram_row_is_bounded_and_filters_reach_the_scan(spark, index):
    grams = spark.read.parquet(f"{index}/grams")
    assert grams.agg(F.max(F.size("units"))).scalar() is not None
    assert grams.groupBy("gram", "block").count().where("count > 1").count() == 0
    plan = ti.candidate_units(spark, index, ["Zebra"])._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(" in plan or "EqualTo(gram" in plan


def test_positions_equal_those_without_index(spark, paged, index):
    values = ["Konto", "straße", "Zebra", "a", "on", "gone", "İstanbul", "kkk", "Konto"]
    key = lambda df: sorted(tuple(r) for r in df.select("file", "value", "line_no", "page", "line_in_page", "byte_offset").collect())
    assert key(ti.positions_from_index(spark, index, values)) == key(sp.spool_positions(values, paged))


def test_many_values_in_one_pass(spark, paged):
    here = paged.where("text IS NOT NULL")
    values = [f"{f}-{i}" for f in range(5) for i in range(1, 400, 3)] + ["Konto", "", "ont", "o", "Konto"]
    assert len(set(values)) > sp.MANY_VALUES
    got = {(r["file"], r["value"]): (r["line_no"], r["byte_offset"]) for r in sp.spool_positions(values, here).collect()}
    lines = sorted((r["file"], r["line_no"], r["text"]) for r in here.collect())
    want, offset = {}, {}
    for file, no, text in lines:
        at = offset.get(file, 0)
        for v in set(values):
            if v in text:
                want.setdefault((file, v), (no, at))
        offset[file] = at + len(text.encode()) + 1
    assert got == want


def test_long_lines_and_empty_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ti, "CHARACTERS_AT_ONCE", 10)
    df = spark.createDataFrame([(1, 1, "abcdefghijklmnopqrstuvwxyz" * 3, 1, 0)], "file long, line_no long, text string, page long, line_in_page long")
    batch = df.select(F.lit(5).cast("long").alias("unit"), "text").toArrow().to_batches()
    got = {(g, u) for b in ti._unit_grams(iter(batch)) for g, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    assert got == {(g, 5) for g in ti._grams(ti._codes("abcdefghijklmnopqrstuvwxyz" * 3)).tolist()}
    ti.build_text_index(df.limit(0), str(tmp_path / "none"))
    assert ti.search_text_index(spark, str(tmp_path / "none"), "abc").count() == 0
