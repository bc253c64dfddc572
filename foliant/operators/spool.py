"""Spool text: control characters, pages, search, line classification, field records."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType

from foliant.functions.text import cut_field, is_page_break, strip
from foliant.functions.udf import once
from foliant.scale import LINES_PER_BLOCK, running, running_sum

MIN_SCORE = 0.55
# Tenths earned per position. Letters and digits swap at 7, listed signs earn 5, a blank 3.
ALPHA_SIGNS = "*#@&()"
DIGIT_SIGNS = "*#.,-+"
SLOT, OTHER_CLASS, SIGN, BLANK = 10, 7, 5, 3
SPACE, SPACE_MISMATCH, LITERAL = 5, 1, 30
LONG_TEMPLATE = 10
SCORE_CHUNK = 8192
#: Values up to which each is tested on its own.
MANY_VALUES = 16


def line_block(line_no: str = "line_no") -> Column:
    return F.floor(F.col(line_no) / LINES_PER_BLOCK)


def detect_control(lines: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Per file ``asa``: one of its first five lines starts with ``1 0 -`` or blank, then a blank."""
    text = F.col("text")
    control = F.substring(text, 1, 1).isin("1", "0", "-", " ") & (F.substring(text, 2, 1) == " ")
    return lines.filter(F.col("line_no") <= 5).groupBy(*keys).agg(F.bool_or(control).alias("asa"))


def detect_spool_format(lines: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Per file ``form_feed`` or ``asa`` from its first 100 bytes in UTF-8: a form feed decides, else a
    ``1`` in column 1 of the first line means ASA, else form feed."""
    # 100 bytes lie in at most the first 101 lines, so the list is short; two hex digits a byte
    start = F.hex(F.substring(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 1, 100))
    rows = lines.filter(F.col("line_no") <= 101).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("line_no", start.alias("t")))).alias("_h"))
    head = F.substring(F.array_join(F.transform("_h", lambda r: r["t"]), "0A"), 1, 200)
    kind = F.when(head.rlike("^([0-9A-F]{2})*0C"), "form_feed").when(head.startswith("31"), "asa").otherwise("form_feed")
    return rows.select(*keys, kind.alias("format"))


def paginate(
    lines: DataFrame, mode: str | int = "dynamic", control: DataFrame | None = None, keys: Sequence[str] = ("file",)
) -> DataFrame:
    """Page number and line in page (0-based) of every line.

    ``dynamic`` counts page breaks (the first line never starts a second page); a number
    means that many lines per page, control characters ignored. A form feed inside a line
    starts a page there: the line belongs to the page on which it begins, the next line is the
    second of the new page. ``control``: per file ``asa`` flag, see ``detect_control``. The running count works in line blocks, so
    a file with very many lines is numbered by many tasks.
    """
    if mode != "dynamic":
        n = int(mode)
        first = F.col("line_no") - 1
        return lines.withColumn("page", (F.floor(first / n) + 1).cast("long")).withColumn("line_in_page", (first % n).cast("long"))
    flags = detect_control(lines, keys) if control is None else control
    marked = lines.join(flags.select(*keys, "asa"), list(keys))
    is_break = (F.col("line_no") > 1) & is_page_break(F.col("text"), F.col("asa"))
    start = F.when(is_break | (F.col("line_no") == 1), F.col("line_no"))
    text = F.coalesce("text", F.lit(""))
    inner = F.length(text) - F.length(F.replace(text, F.lit("\f"))) - text.startswith("\f").cast("int")
    values = {
        "_breaks": ("sum", is_break.cast("long")),
        "_start": ("max", start),
        "_inner": ("sum_before", inner.cast("long")),
        "_inner_start": ("max_before", F.when(inner > 0, F.col("line_no"))),
    }
    paged = running(marked, keys, ["line_no"], values, line_block())
    page, first = F.col("_breaks") + F.col("_inner") + 1, F.greatest("_start", "_inner_start")
    return paged.select(*lines.columns, page.alias("page"), (F.col("line_no") - first).alias("line_in_page"), "asa")


def search_lines(lines: DataFrame, term: str, case_sensitive: bool = False, text: str = "text") -> DataFrame:
    """Every non-overlapping hit of a literal term with its 0-based offset in the line.

    A substring test drops lines without a hit first; nothing is joined or shuffled.
    """
    needle = term.strip()
    if not needle:
        return lines.limit(0).withColumn("match_start", F.lit(0).cast("long")).withColumn("match_length", F.lit(0))
    literal = "\\Q" + needle.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    hit = F.col(text).contains(needle) if case_sensitive else F.col(text).rlike("(?iu)" + literal)
    pieces = F.split(F.col(text), literal if case_sensitive else "(?iu)" + literal, -1)
    rows = lines.filter(hit).withColumn("_pieces", F.transform(pieces, F.length))
    before = lambda i: F.aggregate(F.slice("_pieces", F.lit(1), i), F.lit(0), lambda a, n: a + n) + (i - 1) * len(needle)
    spots = F.transform(F.sequence(F.lit(1), F.size("_pieces") - 1), before)
    return (
        rows.filter(F.size("_pieces") > 1)
        .withColumn("match_start", F.explode(spots))
        .withColumn("match_start", F.col("match_start").cast("long"))
        .withColumn("match_length", F.lit(len(needle)))
        .drop("_pieces")
    )


def page_context(hits: DataFrame, paged: DataFrame, label: str = "BRANCH", keys: Sequence[str] = ("file",)) -> DataFrame:
    """Value after ``label:`` in the first 10 lines of each hit's page (first such line; at most
    five characters of it), NULL without one."""
    tail = F.substring(F.col("text"), F.locate(label, F.col("text")), F.lit(len(label) + 9))
    value = strip(F.substring(strip(F.regexp_extract(tail, r":(.*)$", 1)), 1, 5))
    heads = (
        paged.filter((F.col("line_in_page") < 10) & (F.col("text").contains(label + ":") | F.col("text").contains(label + " :")))
        .groupBy(*keys, "page")
        .agg(F.min_by(value, F.col("line_no")).alias("context"))
    )
    return hits.join(heads, [*keys, "page"], "left")


def _values_in(values: Sequence[str]):
    """Per text the list of the values that it holds; one automaton per task finds all of them in one pass."""

    @F.arrow_udf(ArrayType(StringType()))
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, value in enumerate(values):
            if value:
                automaton.add_word(value, i)
        automaton.make_automaton()
        everywhere = {i for i, value in enumerate(values) if not value}
        listed = pa.array(values, pa.string())
        for batch in texts:
            hits = [everywhere | {i for _, i in automaton.iter(t)} if t is not None else () for t in batch.to_pylist()]
            ends = np.append(0, np.cumsum([len(h) for h in hits]))
            which = np.fromiter((i for h in hits for i in sorted(h)), np.int64, int(ends[-1]))
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), listed.take(pa.array(which)))

    return once(found)


def values_in_text(values: Sequence[str], text: str = "text") -> Column:
    """The values that a text holds. A few are tested one by one inside the scan, many by an automaton (Aho and
    Corasick), whose time does not depend on their number; both give the same lists."""
    distinct = list(dict.fromkeys(values))
    if any(distinct) and len(distinct) > MANY_VALUES:
        return _values_in(distinct)(F.col(text))
    listed = F.array(*[F.lit(v) for v in distinct]) if distinct else F.array().cast("array<string>")
    return F.filter(listed, lambda v: F.col(text).contains(v))


def first_positions(
    placed: DataFrame, values: Sequence[str], keys: Sequence[str] = ("file",), places: Sequence[str] = ("page", "line_in_page", "byte_offset")
) -> DataFrame:
    """First line of each file that contains each value, with what the lines know of their ``places``; the minimum per
    (file, value) is taken map-side."""
    hits = placed.withColumn("_in", values_in_text(values)).withColumn("value", F.explode("_in"))
    first = F.min(F.struct("line_no", *places))
    return hits.groupBy(*keys, "value").agg(first.alias("f")).select(*keys, "value", "f.*")


def spool_positions(
    values: Sequence[str], paged: DataFrame, eol_bytes: int = 1, keys: Sequence[str] = ("file",)
) -> DataFrame:
    """First line that contains each value, per file: line, page, line in page, byte offset.

    ``values`` is the user's own list and is sent to the tasks; byte offsets use the line-block running sum.
    """
    size = F.octet_length("text") + eol_bytes
    placed = running_sum(paged.withColumn("_size", size), keys, ["line_no"], F.col("_size"), "_end", line_block())
    return first_positions(placed.withColumn("byte_offset", F.col("_end") - F.col("_size")), values, keys)


def prepared_template(template: Column) -> Column:
    """Active part of a template: trailing blanks and the closing ``*`` removed."""
    return F.rtrim(F.regexp_replace(F.rtrim(template), r"\*$", ""))


def _classes(lines: list[str], width: int) -> dict[str, np.ndarray]:
    """Character codes of the lines (padded with blanks) and their classes, decided once per distinct character."""
    block = np.array([s[:width].ljust(width) for s in lines], dtype=f"<U{width}")
    codes = block.view("<u4").reshape(len(lines), width)
    # numpy drops trailing NULs of fixed-width text; nothing else is lost
    distinct, inverse = np.unique(codes, return_inverse=True)
    chars = [chr(c) for c in distinct]
    kind = lambda test: np.array([test(c) for c in chars])[inverse.reshape(codes.shape)]
    alpha, digit, blank = kind(str.isalpha), kind(str.isdigit), codes == ord(" ")
    return {
        "codes": codes,
        "A": np.select([alpha, digit, kind(lambda c: c in ALPHA_SIGNS), blank], [SLOT, OTHER_CLASS, SIGN, BLANK], 0),
        "9": np.select([digit, alpha, kind(lambda c: c in DIGIT_SIGNS), blank], [SLOT, OTHER_CLASS, SIGN, BLANK], 0),
        " ": np.where(blank, SPACE, SPACE_MISMATCH),
    }


def _scores(lines: list[str], template: str, classes: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """Score of every line against one prepared template, in whole tenths until the final division."""
    width = len(template)
    if not width or not lines:
        return np.zeros(len(lines))
    c = _classes(lines, width) if classes is None else classes
    slots = np.array(list(template))
    weight = np.select([slots == "A", slots == "9", slots == " "], [SLOT, SLOT, SPACE], LITERAL)
    literal = c["codes"][:, :width] == slots.view("<u4")
    earned = np.select(
        [slots == "A", slots == "9", slots == " "],
        [c["A"][:, :width], c["9"][:, :width], c[" "][:, :width]],
        np.where(literal, LITERAL, 0),
    ).sum(axis=1)
    out = earned / weight.sum()
    if width > LONG_TEMPLATE:
        out[[not s.rstrip() for s in lines]] = 0.0
    return out


def _prepare(template: str | None) -> str:
    t = (template or "").rstrip()
    return t[:-1].rstrip() if t.endswith("*") else t


@F.pandas_udf(DoubleType())
def template_score(line: pd.Series, template: pd.Series) -> pd.Series:
    """How well a line fits a template, 0 to 1; vectorised over the lines of each template."""
    out = pd.Series(0.0, index=line.index)
    for t, part in line.groupby(template):
        out.loc[part.index] = _scores(list(part.fillna("")), _prepare(t))
    return out


def _best(lines: list[str], templates: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
    score, which = np.full(len(lines), MIN_SCORE), np.full(len(lines), -1)
    width = max((len(t) for _, t in templates), default=0)
    for at in range(0, len(lines) if width else 0, SCORE_CHUNK):
        part = lines[at : at + SCORE_CHUNK]
        classes = _classes(part, width)
        for i, (_, template) in enumerate(templates):
            s = _scores(part, template, classes)
            better = s > score[at : at + SCORE_CHUNK]
            score[at : at + SCORE_CHUNK][better] = s[better]
            which[at : at + SCORE_CHUNK][better] = i
    return score, which


@F.pandas_udf(
    ArrayType(
        StructType().add("line_no", LongType()).add("text", StringType()).add("line_id", LongType()).add("score", DoubleType())
    )
)
def _classify(structure: pd.Series, text: pd.Series, templates: pd.Series) -> pd.Series:
    out = pd.Series([None] * len(text), index=text.index, dtype=object)
    # a page without a structure has lines without a template, one without text a single empty line
    for _, rows in text.fillna("").groupby(structure, dropna=False):
        listed = templates.loc[rows.index[0]]
        known = [(t["line_id"], _prepare(t["template"])) for t in listed] if listed is not None else []
        known = [k for k in known if k[1]]
        split = [[s.rstrip("\r") for s in page.replace("\r\n", "\n").split("\n")] for page in rows]
        distinct = {s: None for page in split for s in page}
        score, which = _best(list(distinct), known)
        found = {s: (None, None) if w < 0 else (int(known[w][0]), float(v)) for s, v, w in zip(distinct, score, which)}
        for idx, page in zip(rows.index, split):
            out.at[idx] = [
                {"line_no": n, "text": s, "line_id": found[s][0], "score": found[s][1]} for n, s in enumerate(page, 1)
            ]
    return out


_classify = once(_classify)


def classify_lines(
    pages: DataFrame, line_def: DataFrame, keys: Sequence[str] = ("file", "page"), structure: str = "STRUCTURE_DEF_ID", text: str = "text"
) -> DataFrame:
    """Every line of every page with the template that fits best (score above 0.55; the lowest
    LINE_ID wins a tie), NULL when none does.

    The templates of a structure meet a *page* as one list, so line-template pairs are
    never rows: they exist only as numpy cells inside a task.
    """
    listed = F.sort_array(F.collect_list(F.struct(F.col("LINE_ID").cast("long").alias("line_id"), F.col("TEMPLATE").alias("template"))))
    templates = line_def.filter(prepared_template(F.col("TEMPLATE")) != "").groupBy(structure).agg(listed.alias("_templates"))
    done = pages.join(templates, structure, "left").select(
        *keys, structure, _classify(F.col(structure), F.col(text), F.col("_templates")).alias("_lines")
    )
    rows = done.select(*keys, structure, F.explode("_lines").alias("l"))
    return rows.select(*keys, structure, "l.line_no", "l.text", F.col("l.line_id").alias("LINE_ID"), "l.score")


def extract_fields(
    classified: DataFrame, field_def: DataFrame, line_def: DataFrame | None = None, keys: Sequence[str] = ("file", "page"), structure: str = "STRUCTURE_DEF_ID"
) -> DataFrame:
    """One row per (classified line, field): the characters at the field's columns, stripped."""
    fields = field_def.select(structure, "LINE_ID", "FIELD_ID", F.rtrim("NAME").alias("FIELD_NAME"), "START_COLUMN", "END_COLUMN")
    rows = classified.filter(F.col("LINE_ID").isNotNull()).join(fields, [structure, "LINE_ID"])
    if line_def is not None:
        rows = rows.join(line_def.select(structure, "LINE_ID", F.rtrim("NAME").alias("LINE_NAME")), [structure, "LINE_ID"], "left")
    extra = ["LINE_NAME"] if line_def is not None else []
    return rows.select(
        *keys, structure, "line_no", "LINE_ID", *extra, "FIELD_ID", "FIELD_NAME",
        cut_field(F.col("text"), F.col("START_COLUMN"), F.col("END_COLUMN")).alias("value"),
    )


def field_records(fields: DataFrame, keys: Sequence[str] = ("file", "page", "line_no", "LINE_ID")) -> DataFrame:
    """One JSON record per classified line; the fields of one line are a short list."""
    pairs = F.array_sort(F.collect_list(F.struct("FIELD_ID", F.struct(F.col("FIELD_NAME").alias("name"), "value").alias("f"))))
    return fields.groupBy(*keys).agg(F.to_json(F.transform(pairs, lambda p: p["f"])).alias("record"))
