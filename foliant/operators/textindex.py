"""Stored text index of spool lines: which blocks of lines hold three given characters in a row.

``build_text_index`` writes Parquet tables below one folder: ``lines``, the lines in the order of their file, ``offsets``,
where each begins in its file, and ``grams``, for every three characters that stand in a row the numbers of the blocks of stored lines that hold them.
A search reads the rows of its own grams, intersects them, and tests the text of the lines in the blocks left.
The index only ever leaves out blocks that cannot hold a hit, so results equal those of ``operators.spool`` on all lines.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.spool import first_positions, line_block, search_lines
from foliant.scale import running_sum, small_side

LINES_PER_UNIT = 64
#: Blocks of lines per stored row of a gram, so a gram that every line holds is spread over many rows.
UNITS_PER_ROW = 32_768
#: Grams that a value is looked up by. Any choice leaves candidates only; the text decides.
GRAMS_PER_VALUE = 16
#: Candidate blocks of lines that are sent to all tasks; with more, the lines are joined by a shuffle.
MAX_UNITS = 2_000_000
CHARACTERS_AT_ONCE = 1 << 21
GRAM = 3

# The characters outside ASCII that a search without case takes for an ASCII letter.
FOLDS_TO_ASCII = {"İ": "i", "ı": "i", "ſ": "s", "K": "k"}
CASED = 0x1FFFFF


def _fold(char: str) -> int:
    """Number of a character, equal for all characters that a search without case takes for each other."""
    if char in FOLDS_TO_ASCII:
        return ord(FOLDS_TO_ASCII[char])
    if char.isascii():
        return ord(char.lower())
    # letters without case stay apart; what may have a second form is one class, however a regular expression pairs it
    return ord(char) if unicodedata.category(char) == "Lo" else CASED


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    distinct, inverse = np.unique(codes, return_inverse=True)
    return np.array([_fold(chr(c)) for c in distinct], np.int64)[inverse] if len(codes) else codes.astype(np.int64)


def _grams(codes: np.ndarray) -> np.ndarray:
    """Three numbers of 21 bits each as one, so different grams never meet."""
    return codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]


def grams_of(value: str) -> list[int]:
    """Up to ``GRAMS_PER_VALUE`` grams of a searched value, from all over it; none for one under three characters."""
    found = list(dict.fromkeys(_grams(_codes(value)).tolist()))
    if len(found) <= GRAMS_PER_VALUE:
        return found
    return [found[i * (len(found) - 1) // (GRAMS_PER_VALUE - 1)] for i in range(GRAMS_PER_VALUE)]


def _unit_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (gram, unit) of stored lines, a few million characters at a time."""

    def emit(units: list[int], texts: list[str]) -> pa.RecordBatch:
        codes = _codes("\n".join(texts))
        owner = np.repeat(np.array(units, np.int64), [len(t) + 1 for t in texts])[: len(codes)]
        grams = _grams(codes)
        breaks = codes == ord("\n")
        inside = ~(breaks[:-2] | breaks[1:-1] | breaks[2:])
        grams, owner = grams[inside], owner[: len(grams)][inside]
        order = np.lexsort((grams, owner))
        grams, owner = grams[order], owner[order]
        new = np.append(True, (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1]))[: len(grams)]
        return pa.RecordBatch.from_arrays([pa.array(grams[new]), pa.array(owner[new])], ["gram", "unit"])

    for batch in batches:
        units, texts, size = [], [], 0
        for unit, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            # a long line is taken in pieces that overlap by two characters
            for at in range(0, max(len(text) - GRAM + 1, 0), CHARACTERS_AT_ONCE):
                piece = text[at : at + CHARACTERS_AT_ONCE + GRAM - 1]
                units.append(unit)
                texts.append(piece)
                size += len(piece)
                if size >= CHARACTERS_AT_ONCE:
                    yield emit(units, texts)
                    units, texts, size = [], [], 0
        if texts:
            yield emit(units, texts)


def build_text_index(paged: DataFrame, path: str, keys: Sequence[str] = ("file",), eol_bytes: int = 1) -> None:
    """Write the index of paged lines (``keys``, line_no, page, line_in_page, text) below ``path``.

    Lines are range-sorted by file and number, so a block is 64 lines that follow each other, also in a file that holds
    a third of all lines. Lines are numbered when they are written; the grams are read back from what was written, so
    a task that runs again cannot number them otherwise. Texts are shuffled once; byte offsets are summed over sizes alone
    and kept beside the lines. A NULL text has no bytes and is never found.
    """
    spark = paged.sparkSession
    lines, grams = f"{path.rstrip('/')}/lines", f"{path.rstrip('/')}/grams"
    row = paged.select(*keys, "line_no", "page", "line_in_page", "text")
    ordered = row.repartitionByRange(*keys, "line_no").sortWithinPartitions(*keys, "line_no")
    unit = F.floor(F.monotonically_increasing_id() / LINES_PER_UNIT).cast("long")
    stored = ordered.withColumn("unit", unit).withColumn("part", F.spark_partition_id())
    stored.write.mode("overwrite").partitionBy("part").parquet(lines)
    # without lines there is no part that could tell the columns
    stored.limit(0).write.mode("overwrite").parquet(f"{path.rstrip('/')}/columns")
    size = F.octet_length("text") + eol_bytes
    sizes = stored_lines(spark, path).select(*keys, "line_no", size.cast("long").alias("size"))
    offsets = running_sum(sizes, keys, ["line_no"], F.col("size"), "end", line_block())
    offsets.select(*keys, "line_no", (F.col("end") - F.col("size")).alias("byte_offset")).write.mode("overwrite").parquet(f"{path.rstrip('/')}/offsets")
    texts = stored_lines(spark, path).where("text IS NOT NULL").select("unit", "text")
    pairs = texts.mapInArrow(_unit_grams, "gram long, unit long")
    posting = pairs.groupBy("gram", F.floor(F.col("unit") / UNITS_PER_ROW).cast("long").alias("block")).agg(
        F.sort_array(F.collect_set((F.col("unit") % UNITS_PER_ROW).cast("int"))).alias("units")
    )
    posting.repartitionByRange("gram", "block").sortWithinPartitions("gram", "block").write.mode("overwrite").parquet(grams)


def stored_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines of an index, with the number of their block and part."""
    schema = spark.read.parquet(f"{path.rstrip('/')}/columns").schema
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/lines")


def candidate_units(spark: SparkSession, path: str, values: Sequence[str]) -> DataFrame:
    """(value, unit): blocks of lines that hold all looked-up grams of a value of three characters or more."""
    wanted = [(v, g, len(found)) for v in dict.fromkeys(values) for found in [grams_of(v)] for g in found]
    asked = spark.createDataFrame(wanted, "value string, gram long, asked int")
    stored = spark.read.parquet(f"{path.rstrip('/')}/grams")
    distinct = sorted({g for _, g, _ in wanted})
    if len(distinct) <= GRAMS_PER_VALUE:
        # equalities reach the row groups' statistics, one value reads a few of them
        hit = F.lit(False)
        for g in distinct:
            hit = hit | (F.col("gram") == g)
        stored = stored.where(hit)
    elif distinct:
        stored = stored.where(F.col("gram").between(distinct[0], distinct[-1]))
    rows = stored.join(small_side(asked), "gram")
    lists = rows.groupBy("value", "asked", "block").agg(F.collect_list("units").alias("lists"))
    common = F.aggregate(F.slice("lists", 2, GRAMS_PER_VALUE), F.element_at("lists", 1), F.array_intersect)
    found = lists.where(F.size("lists") == F.col("asked")).select("value", "block", F.explode(common).alias("u"))
    return found.select("value", (F.col("block") * UNITS_PER_ROW + F.col("u")).alias("unit"))


def candidate_lines(spark: SparkSession, path: str, values: Sequence[str]) -> DataFrame:
    """Stored lines that may hold one of the values: those of the candidate blocks, or all lines if a value is under
    three characters long. Files of stored lines without a candidate are not opened."""
    lines = stored_lines(spark, path)
    if any(len(v) < GRAM for v in values):
        return lines
    units = small_side(candidate_units(spark, path, values).select("unit").distinct(), max_rows=MAX_UNITS)
    # the upper bits of a block's number are those of the part; one row per part reaches the driver
    shift = 33 - (LINES_PER_UNIT.bit_length() - 1)
    parts = [r[0] for r in units.select(F.shiftright("unit", shift).alias("p")).distinct().collect()]
    return lines.where(F.col("part").isin(parts)).join(units, "unit", "left_semi")


def search_text_index(spark: SparkSession, path: str, term: str, case_sensitive: bool = False) -> DataFrame:
    """``search_lines`` over the stored lines of an index."""
    needle = term.strip()
    lines = stored_lines(spark, path).limit(0) if not needle else candidate_lines(spark, path, [needle])
    return search_lines(lines, needle, case_sensitive).drop("unit", "part")


def positions_from_index(spark: SparkSession, path: str, values: Sequence[str], keys: Sequence[str] = ("file",)) -> DataFrame:
    """``spool_positions`` over the stored lines of an index; short values are looked for in all lines, the others in
    their candidate blocks."""
    values = list(dict.fromkeys(values))
    short = [v for v in values if len(v) < GRAM]
    long = [v for v in values if len(v) >= GRAM]
    places = ["page", "line_in_page"]
    found = first_positions(candidate_lines(spark, path, long), long, keys, places)
    if short:
        found = found.unionByName(first_positions(candidate_lines(spark, path, short), short, keys, places))
    return found.join(spark.read.parquet(f"{path.rstrip('/')}/offsets"), [*keys, "line_no"])
