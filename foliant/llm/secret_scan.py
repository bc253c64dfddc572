"""Secret scans: fixed patterns, and strings that a tokenizer can hardly compress."""

from __future__ import annotations

import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.byte_bpe import encoder
from foliant.llm.common import slices, small_batches

#: The patterns of the base, the least length of what they must find, and the order of the kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE, LEAST_ACCESS = 6, 20

#: Runs that may be random strings; their least length; characters per token below which one is taken for random.
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
LEAST_RATIO = 2.0
#: Lengths of hexadecimal digests in common use (MD5 to SHA-512).
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
UUID = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")
#: A name: words in one or both cases, with few digits behind a word or a sign. No part can be cut in two ways.
_NAME = "(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+)++[0-9]{0,4}+"
IDENTIFIER = re.compile(f"[-_/+=]*+{_NAME}(?:[-_/+=]++(?:{_NAME}|[0-9]{{1,4}}+))*+[-_/+=]*+")
_CLASSES = [re.compile(c) for c in ("[a-z]", "[A-Z]", "[0-9]")]


def is_known(run: str) -> bool:
    """A digest, a UUID, a plain number, or an identifier."""
    bare = run.strip("=-_/+")
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", bare) and len(bare) in DIGEST_LENGTHS:
        return True
    return bool(UUID.fullmatch(bare) or re.fullmatch(r"[0-9_/+=-]+", run) or IDENTIFIER.fullmatch(run))


def is_random(run: str, tokens, least_ratio: float = LEAST_RATIO) -> bool:
    """Two classes of characters, not known, and fewer than ``least_ratio`` characters for each token."""
    return sum(bool(c.search(run)) for c in _CLASSES) >= 2 and not is_known(run) and len(run) < least_ratio * len(tokens(run))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, each kind leftmost and non-overlapping, in code points."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return spans + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def _scan(path: str, least_ratio: float, out_col: str, text_col: str):
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path).whole.encode_ordinary
        for batch in batches:
            for part in slices(batch, text_col):
                found = []
                for text in part.column(text_col).to_pylist():
                    text = text or ""
                    spans = base_spans(text)
                    spans += [(m.start(), 3, m.end()) for m in RUN.finditer(text) if is_random(m[0], tokens, least_ratio)]
                    found.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(spans)])
                rest = [c for c in part.schema.names if c != "_text"]
                yield pa.record_batch([*[part.column(c) for c in rest], pa.array(found, span)], [*rest, out_col])

    return scan


SPANS = T.ArrayType(T.StructType().add("kind", T.StringType()).add("start", T.IntegerType()).add("end", T.IntegerType()))


def secrets(
    docs: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    path: str = public_tokenizers.path("byte_bpe_50k.tiktoken"),
    least_ratio: float = LEAST_RATIO,
    out_col: str = "spans",
) -> DataFrame:
    """The columns ``keep`` (all by default) of every row and ``out_col``: array of (kind, start, end) by start, then kind.

    Places are code points, the end exclusive. Kinds ``assign``, ``access`` and ``hex`` are the fixed patterns;
    ``random`` marks runs of 20 or more key characters that the tokenizer splits into pieces of under ``least_ratio``
    characters, unless they are digests of known length, UUIDs, numbers or identifiers. Spans of several kinds may
    overlap. Null and empty texts have no spans. A column that has the name
    of the result is replaced by it.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c != out_col]
    # a text that is kept anyway is not sent twice
    text = text_col if text_col in names else "_text"
    rows = small_batches(docs).select(*names, *([] if text in names else [F.col(text_col).alias("_text")]))
    return rows.mapInArrow(_scan(path, least_ratio, out_col, text), T.StructType([docs.schema[c] for c in names] + [T.StructField(out_col, SPANS)]))


def redacted(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", **options) -> DataFrame:
    """The rows with every secret of ``text_col`` replaced by ``mask``; overlapping spans become one. Null stays null."""
    merged = F.aggregate(
        "_spans",
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] < F.element_at(done, -1)["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    text = F.col(text_col)
    starts = F.concat(F.array(F.lit(0)), F.col("_cut.end"))
    ends = F.concat(F.col("_cut.start"), F.array(F.length(text)))
    pieces = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda p: F.substring(text, p["a"] + 1, p["b"] - p["a"]))
    masked = F.when(F.size("_spans") > 0, F.array_join(pieces, mask)).otherwise(text)
    found = secrets(docs, text_col, out_col="_spans", **options).withColumn("_cut", merged)
    return found.withColumn(text_col, masked).select(*docs.columns)
