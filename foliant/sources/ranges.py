"""Report containers read by ranges: header, tables and wanted pages, never a whole archive.

A listing knows only paths and lengths. Joins prune it first; then tasks open the files that are left and read the
bytes they need.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import accumulate, groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from foliant.functions.text import base_name
from foliant.functions.udf import once
from foliant.sources.listing import hadoop_place, listing, place_of

# The header's length, where it has the end of the packed data, and the names of the tables behind it.
HEADER_BYTES, PACKED_END_AT, BEFORE = 512, 0x1E8, 16
TABLES = (b"SECTIONHDR", b"PAGETBLHDR")
#: Places at most GAP bytes apart are read at once, up to RUN_BYTES; a task holds about HELD_BYTES of slices between two batches.
GAP, RUN_BYTES, HELD_BYTES = 64 << 10, 8 << 20, 8 << 20


def list_files(spark: SparkSession, path: str, glob: str = "*.[Rr][Pp][Tt]", recursive: bool = True, by_name: bool = False) -> DataFrame:
    """(file, path, length) of the matching files, listed by tasks; contents are not read.

    ``file``, the key of all container operators, is the whole path; ``by_name`` takes the base name, for archives
    whose names are unique and whose catalogue knows names only.
    """
    found = listing(spark, path, glob, recursive)
    if found is None:
        found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(path)
    return found.select((base_name(F.col("path")) if by_name else F.col("path")).alias("file"), "path", "length")


def locate(uri: str) -> tuple[fs.FileSystem, str, str]:
    """File system and path of a folder, and what to put in front of its file system's paths to open them again."""
    system, place = place_of(uri)
    return system, place, "" if uri.startswith("file:") or "://" not in uri else re.match(r"[^:]+://[^/]*", uri).group()


def open_file(uri: str):
    system, place = place_of(uri)
    return system.open_input_file(place)


@F.arrow_udf(BinaryType())
def file_content(paths: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Whole contents of listed files, a few at a time; a query that does not use the column opens no file."""
    for batch in paths:
        held, size = [], 0
        for uri in batch.to_pylist():
            with open_file(uri) as f:
                held.append(f.read())
            size += len(held[-1])
            if size >= HELD_BYTES:
                yield pa.array(held, pa.binary())
                held, size = [], 0
        if held:
            yield pa.array(held, pa.binary())


file_content = once(file_content)


def read_heads(files: DataFrame) -> DataFrame:
    """The files with ``content``: their first 512 bytes, all that ``rpt_header`` looks at."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for uri in batch.column("path").to_pylist():
                with open_file(uri) as f:
                    parts.append(f.read_at(HEADER_BYTES, 0))
            yield pa.record_batch([batch.column("file"), batch.column("length"), pa.array(parts, pa.binary())], ["file", "length", "content"])

    return files.select("file", "path", "length").mapInArrow(read, "file string, length long, content binary")


def read_tables(files: DataFrame) -> DataFrame:
    """The files with ``content``: header and tables without the packed data between them, and ``bytes_read``.

    The header's end of the packed data is set to where the tables now begin, so ``rpt_section``, ``rpt_page`` and
    ``rpt_object`` work on it as on a whole file; offsets in the tables stay those of the file. Only a file whose
    tables are not behind its packed data is read whole.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (uri, length) in enumerate(zip(batch.column("path").to_pylist(), batch.column("length").to_pylist())):
                with open_file(uri) as f:
                    head = f.read_at(min(HEADER_BYTES, length), 0)
                    end = int.from_bytes(head[PACKED_END_AT : PACKED_END_AT + 4], "little")
                    start = max(end - BEFORE, HEADER_BYTES)
                    tail = f.read_at(max(length - start, 0), start) if len(head) == HEADER_BYTES else b""
                    part, done = head + tail, len(head) + len(tail)
                    if any(t in tail for t in TABLES):
                        moved = (HEADER_BYTES + BEFORE).to_bytes(4, "little")
                        part = head[:PACKED_END_AT] + moved + head[PACKED_END_AT + 4 :] + tail
                    elif done < length:
                        part = f.read_at(length, 0)
                        done += length
                columns = [*[c.slice(row, 1) for c in batch.columns], pa.array([part], pa.binary()), pa.array([done])]
                yield pa.record_batch(columns, ["file", "path", "length", "content", "bytes_read"])

    return files.select("file", "path", "length").mapInArrow(read, "file string, path string, length long, content binary, bytes_read long")


def read_runs(source, places: Sequence[tuple[int, int] | None]) -> tuple[list[bytes | None], int]:
    """Bytes of each (offset, span), None for None, and the number of bytes read; near places share one read."""
    found: list[bytes | None] = [None] * len(places)
    order = sorted((i for i, place in enumerate(places) if place is not None), key=lambda i: places[i])
    done = at = 0
    while at < len(order):
        first, span = places[order[at]]
        end, stop = first + span, at + 1
        while stop < len(order):
            offset, span = places[order[stop]]
            if offset > end + GAP or offset + span - first > RUN_BYTES:
                break
            end, stop = max(end, offset + span), stop + 1
        part = source.read_at(end - first, first)
        done += len(part)
        for i in order[at:stop]:
            offset, span = places[i]
            found[i] = part[offset - first : offset - first + span]
        at = stop
    return found, done


def read_slices(wanted: DataFrame) -> DataFrame:
    """(file, page, size, packed) of ``wanted`` (file, path, page, size, offset, span): ``span`` bytes of each file at
    ``offset``; a null offset reads nothing.

    Rows of one file that follow each other share one open file, and slices that lie near each other one read.
    """
    schema = "file string, page long, size long, packed binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uris, offsets, spans = (batch.column(c).to_pylist() for c in ("path", "offset", "span"))
            share = [held // HELD_BYTES for held in accumulate(span or 0 for span in spans)]
            for _, rows in groupby(range(batch.num_rows), share.__getitem__):
                rows, packed = list(rows), []
                for uri, some in groupby(rows, uris.__getitem__):
                    places = [None if offsets[r] is None else (offsets[r], spans[r]) for r in some]
                    if any(places):
                        with open_file(uri) as f:
                            places = read_runs(f, places)[0]
                    packed += places
                kept = [batch.column(c).slice(rows[0], len(rows)) for c in ("file", "page", "size")]
                yield pa.record_batch([*kept, pa.array(packed, pa.binary())], ["file", "page", "size", "packed"])

    return wanted.select("file", "path", "page", "size", "offset", "span").mapInArrow(read, schema)


def read_parts(wanted: DataFrame, parts: str = "parts") -> DataFrame:
    """``wanted`` (path, ``parts`` and more columns) with the bytes of each row's parts instead of their places.

    ``parts`` is an array of (offset, span, size) and becomes one of (packed, size); a null offset gives null bytes. All
    parts of a file are read in as few reads as their distances allow, and ``bytes_read`` counts them.
    """
    rest = [c for c in wanted.columns if c != parts]
    kind = pa.list_(pa.struct([("packed", pa.binary()), ("size", pa.int64())]))
    new = StructType.fromDDL(f"`{parts}` array<struct<packed:binary,size:bigint>>, bytes_read long")
    schema = StructType([wanted.schema[c] for c in rest] + new.fields)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, uri in enumerate(batch.column("path").to_pylist()):
                asked = batch.column(parts)[row].as_py() or []
                places = [None if p is None or p["offset"] is None else (p["offset"], p["span"]) for p in asked]
                found, done = places, 0
                if any(places):
                    with open_file(uri) as f:
                        found, done = read_runs(f, places)
                cells = [{"packed": b, "size": None if p is None else p["size"]} for b, p in zip(found, asked)]
                kept = [batch.column(c).slice(row, 1) for c in rest]
                yield pa.record_batch([*kept, pa.array([cells], kind), pa.array([done])], [*rest, parts, "bytes_read"])

    return wanted.select(*rest, parts).mapInArrow(read, schema)


def write_files(contents: DataFrame, path: str) -> None:
    """Write each row's ``content`` (file, content) to a file of its own below ``path``, from the tasks; written again
    by a retried task, a file is the same."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("file").to_pylist(), batch.column("content").to_pylist()):
                system, place = place_of(f"{path.rstrip('/')}/{name}")
                system.create_dir(place.rpartition("/")[0], recursive=True)
                with system.open_output_stream(place) as f:
                    f.write(content)
            yield pa.record_batch([batch.column("file")], ["file"])

    contents.select("file", "content").mapInArrow(write, "file string").count()


#: Characters that Spark writes as %XX in the folder names of a partitioned table, and its name for a missing value.
_ESCAPED, _MISSING = re.compile(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]"), "__HIVE_DEFAULT_PARTITION__"


def _folder(key: str, value: object) -> str:
    text = _MISSING if value is None or value == "" else _ESCAPED.sub(lambda c: f"%{ord(c.group()):02X}", str(value))
    return f"{key}={text}"


def write_lines(rows: DataFrame, path: str, keys: Sequence[str]) -> None:
    """``rows`` (``keys``, value) as lines of one text file for each key, in folders as Spark's partitioned writer names them.

    Equal keys have to follow each other in one partition. Tasks write the files at their place, so that the driver has
    nothing to move; written again by a retried task, a file is the same. What was at ``path`` goes first, and
    ``_SUCCESS`` comes last.
    """
    system, place = hadoop_place(rows.sparkSession, path)
    root = place.toString().rstrip("/")
    system.delete(place, True)
    system.mkdirs(place)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, None
        try:
            for batch in batches:
                for *key, value in zip(*(batch.column(c).to_pylist() for c in (*keys, "value"))):
                    if key != now:
                        if out:
                            out.close()
                        store, folder = place_of("/".join([root, *map(_folder, keys, key)]))
                        store.create_dir(folder, recursive=True)
                        now, out = key, store.open_output_stream(f"{folder}/part-00000.txt")
                    out.write((value or b"") + b"\n")
                yield pa.record_batch([pa.array([batch.num_rows])], ["rows"])
        finally:
            if out:
                out.close()

    rows.select(*keys, F.col("value").cast("binary").alias("value")).mapInArrow(write, "rows long").agg(F.sum("rows")).collect()
    system.create(rows.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{root}/_SUCCESS")).close()


def read_lines(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    """(``keys`` as strings, value) of the files that ``write_lines`` or Spark's partitioned writer left below ``path``, each file's text as
    one value; None where only Spark can read."""
    found = listing(spark, path)
    if found is None:
        return None
    inside = "/".join(f"{k}=([^/]*)" for k in keys)
    folders = found.where(F.col("path").rlike(rf"/{inside}/[^/]*\z"))

    def key(number: int) -> Column:
        raw = F.regexp_extract("path", rf"/{inside}/[^/]*\z", number)
        plain = F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)
        return F.when(raw != _MISSING, plain)

    texts = folders.select(*[key(i).alias(k) for i, k in enumerate(keys, 1)], file_content("path").alias("value"))
    return texts.select(*keys, F.col("value").cast("string").alias("value"))
