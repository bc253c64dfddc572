"""Pages of report containers as a data source: ``spark.read.format("report_pages").load(folder)``.

Conditions on ``file`` and ``path`` are applied to the listing, those on ``page`` to the page tables, so a query opens
only the files it names and reads only the pages it asks for. Files are packed into partitions by bytes.
"""

from __future__ import annotations

import fnmatch
import operator
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

from foliant.operators.containers import BASE_OFFSET, MARKER_BYTES, PAGE_COUNT_AT, PAGE_ROW, SLACK, unpack
from foliant.sources.ranges import BEFORE, HEADER_BYTES, HELD_BYTES, PACKED_END_AT, locate, open_file, read_runs

SCHEMA = "file string, path string, length long, page long, status string, content binary"
#: Bytes of one partition, and what opening a file costs in bytes; both are options of the source.
PARTITION_BYTES, OPEN_BYTES = 128 << 20, 64 << 10
ROW = np.dtype({"names": ["offset", "size"], "formats": ["<u4", "<u4"], "offsets": [0, 16], "itemsize": PAGE_ROW})
MARKER = b"PAGETBLHDR"

_COMPARE = {EqualTo: operator.eq, LessThan: operator.lt, LessThanOrEqual: operator.le, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge}


def _test(condition: Filter) -> tuple[str, Callable] | None:
    """Column and test (on a value, or on a numpy array of pages) of a condition the source can apply, else None."""
    column = ".".join(getattr(condition, "attribute", ()))
    if column not in ("file", "path", "page"):
        return None
    if isinstance(condition, IsNotNull):
        return column, lambda v: v == v
    if type(condition) in _COMPARE:
        compare, value = _COMPARE[type(condition)], condition.value
        return column, lambda v: compare(v, value)
    if isinstance(condition, In):
        if column == "page":
            pages = np.array(sorted(v for v in condition.value if v is not None), dtype="i8")
            return column, lambda v: np.isin(v, pages)
        names = frozenset(condition.value)
        return column, lambda v: v in names
    return None


@dataclass
class FilePart(InputPartition):
    files: list[tuple[str, int]]


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"]
        self.glob = options.get("glob", "*.rpt").lower()
        self.recursive = options.get("recursive", "true").lower() == "true"
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.open_bytes = int(options.get("openbytes", OPEN_BYTES))
        self.tests: list[tuple[str, Callable]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Keeps what it can apply; yields the rest, which Spark applies."""
        for condition in filters:
            test = _test(condition)
            if test is None:
                yield condition
            else:
                self.tests.append(test)

    def _passes(self, path: str) -> bool:
        values = {"path": path, "file": path.rpartition("/")[2]}
        return all(test(values[column]) for column, test in self.tests if column in values)

    def listing(self) -> list[tuple[str, int]]:
        """(path, length) of the files that conditions and glob leave, by path: all that the driver holds."""
        system, place, prefix = locate(self.folder)
        found = system.get_file_info(fs.FileSelector(place, recursive=self.recursive))
        files = ((prefix + f.path, f.size) for f in found if f.type == fs.FileType.File and fnmatch.fnmatchcase(f.base_name.lower(), self.glob))
        return sorted(f for f in files if self._passes(f[0]))

    def partitions(self) -> list[InputPartition]:
        parts, load = [], 0
        for path, length in self.listing():
            cost = length + self.open_bytes
            if not parts or load + cost > self.partition_bytes:
                parts.append(FilePart([]))
                load = 0
            parts[-1].files.append((path, length))
            load += cost
        return parts or [FilePart([])]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for path, length in partition.files:
            with open_file(path) as f:
                for row in self._pages(f, path, length):
                    held.append(row)
                    size += len(row[-1] or b"")
                    if size > HELD_BYTES:
                        yield _batch(held)
                        held, size = [], 0
        if held:
            yield _batch(held)

    def _pages(self, f, path: str, length: int) -> Iterator[tuple]:
        """Rows of the wanted pages of one open file; packed bytes are read in runs, one run in memory at a time."""
        table = page_table(f, length)
        pages = np.arange(1, len(table) + 1)
        keep = np.ones(len(pages), bool)
        for column, test in self.tests:
            if column == "page":
                keep &= test(pages)
        pages, table = pages[keep], table[keep]
        offsets, sizes = table["offset"].astype("i8") + BASE_OFFSET, table["size"].astype("i8")
        spans = np.where(offsets + sizes <= length, np.minimum(sizes + SLACK, length - offsets), -1)
        share = np.cumsum(np.maximum(spans, 0)) // HELD_BYTES
        cuts = np.flatnonzero(np.diff(share)) + 1
        for some in np.split(np.arange(len(pages)), cuts):
            places = [(int(offsets[i]), int(spans[i])) if spans[i] >= 0 else None for i in some]
            for i, packed in zip(some, read_runs(f, places)[0]):
                content = unpack(packed, int(sizes[i]))
                status = "out_of_range" if packed is None else "inflate_error" if content is None else "ok"
                yield path.rpartition("/")[2], path, length, int(pages[i]), status, content


def page_table(f, length: int) -> np.ndarray:
    """Rows (offset, size) of an open file's page table; none of a file that is no container.

    The table is looked for behind the declared end of the packed data, then in the whole file.
    """
    head = f.read_at(min(HEADER_BYTES, length), 0)
    if len(head) < HEADER_BYTES or not head.startswith(b"RPTFILEHDR"):
        return np.empty(0, ROW)
    count, end = (int.from_bytes(head[at : at + 4], "little") for at in (PAGE_COUNT_AT, PACKED_END_AT))
    start = max(end - BEFORE, 0)
    tail = f.read_at(length - start, start) if count and start < length else b""
    at = tail.find(MARKER)
    if at < 0 and count:
        tail = f.read_at(length, 0)
        at = tail.find(MARKER)
    if at < 0:
        return np.empty(0, ROW)
    begin = at + MARKER_BYTES
    return np.frombuffer(tail, ROW, min(count, max(len(tail) - begin, 0) // PAGE_ROW), begin)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["file", "path", "length", "page", "status", "content"])


class ReportPages(DataSource):
    """Options: ``path``, ``glob`` (any case, ``*.rpt``), ``recursive``, ``partitionBytes``, ``openBytes``."""

    @classmethod
    def name(cls) -> str:
        return "report_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return PageReader({k.lower(): v for k, v in self.options.items()})


def scan_pages(spark: SparkSession, path: str, encoding: str = "UTF-8", **options: object) -> DataFrame:
    """(file, path, length, page, status, text) of all pages below ``path``.

    ``status`` is ``ok``, ``out_of_range`` (the bytes end beyond the file) or ``inflate_error``; files that are no
    containers have no rows. Conditions on ``file``, ``path`` and ``page`` (=, IN, <, <=, >, >=) reach the source.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ReportPages)
    rows = spark.read.format("report_pages").options(**options).load(path)
    return rows.select("file", "path", "length", "page", "status", F.decode("content", encoding).alias("text"))
