"""Listings by tasks find the files that Spark's own reader finds, and leave the driver out of it."""

import os

import pytest
from pyspark.errors import AnalysisException

from foliant.sources import files as fs
from foliant.sources import listing as ls
from foliant.sources import ranges as rg

NAMES = [
    "a.RPT", "b.rpt", "_x.rpt", ".y.rpt", "_a=b.rpt", "q.rpt._COPYING_", "_metadata_x.rpt", "we ird %41é'\"#?.rpt", "empty.rpt",
    "sub/c.rpt", "sub/_h/d.rpt", "sub/k=v/e.rpt", "sub/deep/er/f.Rpt", ".hid/g.rpt", "sub/x{1}.rpt", "new\nline.rpt", "other.txt",
]


def tree(folder):
    for size, name in enumerate(NAMES):
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(b"" if name == "empty.rpt" else b"z" * (size + 1))
    (folder / "none").mkdir()
    (folder / "folder.rpt").mkdir()
    os.symlink(folder / "sub" / "deep", folder / "link")
    os.symlink("/nowhere", folder / "broken.rpt")
    return str(folder)


def plan(df):
    return df._jdf.queryExecution().toString()


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_listing_finds_what_spark_finds(spark, tmp_path, monkeypatch):
    root = tree(tmp_path / "archive")
    monkeypatch.setattr(ls, "LIST_ROWS", 3)
    for path, glob in ((root, "*.[Rr][Pp][Tt]"), (root, "*"), (root, "{a,b}.*"), (f"{root}/a.RPT", "*"), (f"{root}/s*", "?.rpt"), (f"{root}/none", "*"), (f"file:{root}/", "[!a]*")):
        own = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
        found = ls.listing(spark, path, glob)
        assert rows(found) == rows(own.select("path", "modificationTime", "length")), (path, glob)
        assert rows(rg.list_files(spark, path, glob).select("path", "length")) == rows(own.select("path", "length"))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        ls.listing(spark, f"{root}/gone")


def test_listing_is_made_by_tasks(spark, tmp_path, monkeypatch):
    root = tree(tmp_path / "archive")
    listed = rg.list_files(spark, root)
    assert "FileScan" not in plan(listed) and "binaryFile" not in plan(listed)
    # partitions by bytes and number of files, not one for each few files
    assert listed.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(ls, "PARTITION_BYTES", 20)
    monkeypatch.setattr(ls, "OPEN_BYTES", 7)
    n, size = len(rows(listed)), sum(r["length"] for r in listed.collect())
    assert rg.list_files(spark, root).rdd.getNumPartitions() == max(n, -(-(size + 7 * n) // 20))
    # later files do not show up
    (tmp_path / "archive" / "late.rpt").write_bytes(b"late")
    assert listed.count() == n


def test_listing_leaves_to_spark_what_only_spark_can_read(spark, tmp_path):
    (tmp_path / "year=2024").mkdir()
    (tmp_path / "year=2024" / "x.rpt").write_bytes(b"x")
    assert ls.listing(spark, str(tmp_path), recursive=False) is None
    assert ls.listing(spark, str(tmp_path)).count() == 1
    assert [r["file"] for r in rg.list_files(spark, str(tmp_path), recursive=False, by_name=True).collect()] == ["x.rpt"]
    spark.conf.set("spark.hadoop.fs.viewfs.mounttable.archive.link./in", f"file://{tmp_path}")
    try:
        spark.conf.set("fs.viewfs.mounttable.archive.link./in", f"file://{tmp_path}")
        assert ls.listing(spark, "viewfs://archive/in") is None
        assert [r["file"] for r in rg.list_files(spark, "viewfs://archive/in", by_name=True).collect()] == ["x.rpt"]
    finally:
        spark.conf.unset("fs.viewfs.mounttable.archive.link./in")
        spark.conf.unset("spark.hadoop.fs.viewfs.mounttable.archive.link./in")


def test_scans_list_by_tasks_and_open_only_what_is_used(spark, tmp_path, monkeypatch):
    for number in range(9):
        (tmp_path / f"{number}.map").write_bytes(os.urandom(1000 + number))
    own = spark.read.format("binaryFile").load(str(tmp_path))
    found = fs.scan_map(spark, str(tmp_path))
    assert "FileScan" not in plan(found) and "binaryFile" not in plan(found)
    assert found.columns == ["path", "modificationTime", "length", "content", "file"]
    assert rows(found.drop("file")) == rows(own)
    two = fs.scan_map(spark, str(tmp_path), limit=2)
    for n in range(2, 9):
        (tmp_path / f"{n}.map").unlink()
    # contents of the first two alone are read, and none where nobody asks for them
    assert sorted(r["file"] for r in two.select("file", "content").collect()) == ["0.map", "1.map"]
    assert found.select("file", "length").count() == len(found.select("file").collect()) == 9


def test_contents_leave_in_pieces(monkeypatch, tmp_path):
    import pyarrow as pa

    monkeypatch.setattr(rg, "HELD_BYTES", 100)
    for number, size in enumerate((10, 90, 5, 300, 1)):
        (tmp_path / str(number)).write_bytes(bytes([number]) * size)
    got = list(rg.file_content.func(iter([pa.array([str(tmp_path / str(n)) for n in range(5)])])))
    assert [len(piece) for piece in got] == [2, 2, 1]
    assert [len(v.as_py()) for piece in got for v in piece] == [10, 90, 5, 300, 1]
