"""Listings of folders made by tasks, level by level, so that the driver holds neither names nor sizes of an archive's files.

Spark's own file sources list on the driver and keep every file there, and plan a partition for each few files.
"""

from __future__ import annotations

import os
import re
import stat
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.scale import cut_lineage

_LISTED = "path string, modified long, length long, folder boolean"
_ARROW = pa.schema([("path", pa.string()), ("modified", pa.int64()), ("length", pa.int64()), ("folder", pa.bool_())])
#: Rows of a listing that leave a task at once, and folders that one task lists at least before more tasks are used.
LIST_ROWS, FOLDERS = 10_000, 4_000
#: Bytes of one partition of a listing, and what opening a file costs in bytes.
PARTITION_BYTES, OPEN_BYTES = 128 << 20, 64 << 10


def place_of(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a listed file, whose name may hold characters that a URI would escape."""
    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem(), re.sub(r"^file:(//)?(?=/)", "", uri)
    root, path = re.fullmatch(r"([^:]+://[^/]*)(.*)", uri, re.DOTALL).groups()
    system, base = fs.FileSystem.from_uri(root + "/")
    return system, base.rstrip("/") + path


def hadoop_place(spark: SparkSession, path: str):
    """Spark's file system and path of a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system, system.makeQualified(place)


def task_readable(spark: SparkSession, path: str) -> bool:
    """Whether Python tasks can open the store of ``path``; some stores are known to Spark only."""
    try:
        place_of(hadoop_place(spark, path)[1].toString())
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def _hidden(name: str, folder: bool) -> bool:
    """Names that Spark's file sources leave out."""
    if folder and name.startswith(("_common_metadata", "_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _children(uri: str) -> Iterator[tuple[str, int, int, bool]]:
    """(path, modification time in ms, length, whether it is a folder) of what a folder holds; a local one is never held whole."""
    system, place = place_of(uri)
    if not isinstance(system, fs.LocalFileSystem):
        for x in system.get_file_info(fs.FileSelector(place)):
            yield x.base_name, (x.mtime_ns or 0) // 1_000_000, x.size or 0, x.type == fs.FileType.Directory
        return
    with os.scandir(place or "/") as found:
        for x in found:
            try:
                info = x.stat()
            except FileNotFoundError:  # gone meanwhile, or a link that leads nowhere
                continue
            yield os.fsencode(x.name).decode("utf-8", "replace"), info.st_mtime_ns // 1_000_000, info.st_size, stat.S_ISDIR(info.st_mode)


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            rows = ((f"{uri.rstrip('/')}/{name}", *rest) for name, *rest in _children(uri) if not _hidden(name, rest[-1]))
            while some := list(islice(rows, LIST_ROWS)):
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*some), _ARROW.types)], schema=_ARROW)


def listing(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame | None:
    """(path, modificationTime, length) of the files below ``path`` whose names match, as Spark's file sources find them:
    hidden and empty files are left out.

    Each level of folders is listed by tasks and kept as a checkpoint, so the listing does not change later. Its
    partitions are dealt by the bytes and the number of the files. None where Spark itself has to read: a store that
    Python tasks cannot open, or, when not ``recursive``, folders named ``column=value``.
    """
    if not task_readable(spark, path):
        return None
    system, place = hadoop_place(spark, path)
    tops = list(system.globStatus(place) or ())
    if not tops:
        spark.read.format("binaryFile").load(path)  # the usual error
    wanted = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    name = F.substring_index("path", "/", -1)
    keep = F.col("folder") | name.rlike(rf"^(?s:{wanted})\z")
    tasks = 2 * spark.sparkContext.defaultParallelism
    rows = [(t.getPath().toString(), t.getModificationTime(), t.getLen(), t.isDirectory()) for t in tops]
    level = spark.createDataFrame([r for r in rows if r[3] or not _hidden(r[0].rpartition("/")[2], False)], _LISTED)
    levels = [level.where(keep)]
    while count := levels[-1].where("folder").count():
        if len(levels) > 1 and not recursive:
            if levels[-1].where(F.col("folder") & name.contains("=")).count():
                return None
            break
        dealt = levels[-1].where("folder").select("path").repartition(min(count, max(tasks, count // FOLDERS)))
        levels.append(cut_lineage(dealt.mapInArrow(_list, _LISTED).where(keep)))
    files = levels[0]
    for level in levels[1:]:
        files = files.unionByName(level)
    files = files.where("NOT folder AND length > 0").select("path", F.timestamp_millis("modified").alias("modificationTime"), "length")
    load = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    parts = max(min(load["n"], tasks), -(-(load["bytes"] + load["n"] * OPEN_BYTES) // PARTITION_BYTES), 1)
    return files.repartition(parts, "path")
