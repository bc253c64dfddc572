"""Byte-level BPE by rank files: overlapping chunks are pre-tokenised in parallel and stitched where they agree again."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.common import per_process, slices, small_batches

#: Characters that a chunk owns, and those it shares with the next one.
CHUNK, OVERLAP = 16_384, 512
#: Between these two characters every scan has a boundary, wherever it began: no match of the pattern goes on after
#: a letter, digit or sign into white space, nor from a letter into anything but a letter, nor from a digit into
#: anything but a digit.
CERTAIN = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})")


class Encoder:
    """A rank file with its pattern, kept in a worker; each part is made when it is first asked for, so that a worker
    that only encodes or only decodes does not hold the other's tables."""

    def __init__(self, path: str):
        self.path = path

    def _read(self) -> dict[bytes, int]:
        with open(self.path, "rb") as f:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        return self._read()

    @cached_property
    def whole(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def pattern(self) -> regex.Pattern:
        return regex.compile(public_tokenizers.PATTERN)

    @cached_property
    def by_id(self) -> pa.Array:
        """Bytes of each id."""
        ranks = self._read()
        table: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            table[i] = token
        return pa.array(table, pa.large_binary())

    def piece(self, text: str) -> list[int]:
        """Ids of one match of the pattern."""
        i = self.ranks.get(text.encode())
        return self.whole.encode_ordinary(text) if i is None else [i]

    def pieces(self, text: str, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ends of the matches, number of ids of each, all ids); ``at``: place of the text in its document."""
        found = self.pattern.findall(text)
        ids = [self.piece(m) for m in found]
        ends = at + np.cumsum([len(m) for m in found], dtype=np.int64)
        return ends, np.array([len(x) for x in ids], np.int64), np.array([i for x in ids for i in x], np.int64)


def encoder(path: str) -> Encoder:
    return per_process(("ranks", path), lambda: Encoder(path))


def _whole(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path).whole
        for batch in batches:
            for part in slices(batch, "_text"):
                ids = [np.array(enc.encode_ordinary(t), np.int32) for t in part.column("_text").to_pylist()]
                yield pa.record_batch([part.column("_id"), pa.array(ids, pa.list_(pa.int32()))], ["_id", "ids"])

    return encode


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping windows of long texts."""
    for batch in batches:
        for part in slices(batch, "_text"):
            for row, text in enumerate(part.column("_text").to_pylist()):
                count = -(-len(text) // CHUNK)
                windows = [text[k * CHUNK : (k + 1) * CHUNK + OVERLAP] for k in range(count)]
                own = [part.column(c).slice(row, 1).take(pa.array([0] * count)) for c in ("_id", "_content")]
                yield pa.record_batch([*own, pa.array(range(count), pa.int32()), pa.array(windows)], ["_id", "_content", "_k", "_text"])


def _scan(path: str):
    """Boundaries and ids of each window; the window itself goes along only where an overlap has no certain boundary."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for part in slices(batch, "_text"):
                ends, counts, ids, texts = [], [], [], []
                for k, text in zip(part.column("_k").to_pylist(), part.column("_text").to_pylist()):
                    e, n, i = enc.pieces(text, k * CHUNK)
                    ends.append(e)
                    counts.append(n.astype(np.int32))
                    ids.append(i.astype(np.int32))
                    # the first and last characters of an overlap may be seen differently from its two sides
                    agreed = all(CERTAIN.search(text, at + 1, min(at + OVERLAP, len(text)) - 4) for at in ([0] if k else []) + ([CHUNK] if len(text) > CHUNK else []))
                    texts.append(None if agreed else text)
                columns = [pa.array(ends, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32())), pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                yield pa.record_batch([part.column(c) for c in ("_id", "_content", "_k", "_copies")] + columns, ["_id", "_content", "_k", "_copies", "ends", "counts", "ids", "text"])

    return scan


def stitch(enc: Encoder, chunks: list[dict]) -> np.ndarray:
    """Ids of one document from its scanned windows, given in order.

    Two neighbours are cut at their first common boundary in the overlap. Windows without one (a run longer than the
    overlap) are scanned again as one text.
    """
    runs: list[dict] = []
    for c in chunks:
        c = dict(c, start=c["_k"] * CHUNK)
        if runs:
            last = runs[-1]
            common = np.intersect1d(last["ends"][:-1], c["ends"][:-1] if c["_k"] < len(chunks) - 1 else c["ends"], assume_unique=True)
            common = common[common >= c["start"]]
            if len(common):
                last["to"] = c["from"] = int(common[0])
            else:
                begin = last.get("from", 0)
                text = last["text"][: c["start"] - last["start"]] + c["text"]
                ends, counts, ids = enc.pieces(text[begin - last["start"] :], begin)
                runs[-1] = last | {"text": text, "ends": ends, "counts": counts, "ids": ids}
                continue
        runs.append(c)
    parts = []
    for c in runs:
        low = np.searchsorted(c["ends"], c.get("from", 0), side="right")
        high = np.searchsorted(c["ends"], c["to"], side="right") if "to" in c else len(c["ends"])
        before = np.concatenate([[0], np.cumsum(c["counts"])])
        parts.append(c["ids"][before[low] : before[high]])
    return np.concatenate(parts)


def _stitched(path: str):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for row in range(batch.num_rows):
                chunks = sorted(batch.column("chunks")[row].as_py(), key=lambda c: c["_k"])
                for c in chunks:
                    c.update({n: np.array(c[n], np.int64) for n in ("ends", "counts", "ids")})
                ids = stitch(enc, chunks).astype(np.int32)
                for _ in range(chunks[0]["_copies"]):
                    yield pa.record_batch([batch.column("_id").slice(row, 1), pa.array([ids], pa.list_(pa.int32()))], ["_id", "ids"])

    return join


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
) -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of every row, as tiktoken's ``encode_ordinary`` gives them.

    A text of up to ``CHUNK`` characters is one chunk and never leaves its task. Longer ones are cut into overlapping
    windows that are dealt over all tasks, scanned there, and meet again as boundaries and ids. Null and empty texts
    have no ids; equal rows come back as often as they went in; rows that share an id but not a text stay apart.
    """
    kind = docs.schema[id_col].dataType
    rows = small_batches(docs).select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    out = T.StructType([T.StructField("_id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    short = rows.where(F.length("_text") <= CHUNK).mapInArrow(_whole(path), out)
    key = [T.StructField("_id", kind), T.StructField("_content", T.BinaryType()), T.StructField("_k", T.IntegerType())]
    windows = rows.where(F.length("_text") > CHUNK).withColumn("_content", F.unhex(F.sha2("_text", 256))).mapInArrow(_cut, T.StructType([*key, T.StructField("_text", T.StringType())]))
    dealt = windows.groupBy("_id", "_content", "_k").agg(F.count(F.lit(1)).alias("_copies"), F.first("_text").alias("_text"))
    found = "ends array<long>, counts array<int>, ids array<int>, text string"
    scanned = dealt.mapInArrow(_scan(path), T.StructType([*key, T.StructField("_copies", T.LongType()), *T.StructType.fromDDL(found).fields]))
    per_doc = scanned.groupBy("_id", "_content").agg(F.collect_list(F.struct("_k", "_copies", "ends", "counts", "ids", "text")).alias("chunks"))
    long = per_doc.select("_id", "chunks").mapInArrow(_stitched(path), out)
    return short.unionByName(long).select(F.col("_id").alias(id_col), "ids")


def decode(tokens: DataFrame, ids_col: str = "ids", out_col: str = "bytes", path: str = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")) -> DataFrame:
    """All columns and the raw bytes of the ids one after another; null and empty ids give no bytes.

    An id that the rank file does not have is an error.
    """

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = encoder(path).by_id
        for batch in batches:
            lists = batch.column(ids_col)
            lists = lists.fill_null([]) if lists.null_count else lists
            flat = lists.flatten()
            tokens = table.take(flat)
            if tokens.null_count:
                raise ValueError("ids without a token")
            # the data of the taken tokens are the decoded texts, one after another
            places = np.frombuffer(tokens.buffers()[1], np.int64)[tokens.offset :] if len(tokens) else np.zeros(1, np.int64)
            counts = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            ends = places[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
            data = tokens.buffers()[2] if len(tokens) else pa.py_buffer(b"")
            texts = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends.tobytes()), data])
            yield pa.record_batch([*batch.columns, texts.cast(pa.binary())], [*batch.schema.names, out_col])

    return tokens.mapInArrow(lookup, T.StructType([*tokens.schema.fields, T.StructField(out_col, T.BinaryType())]))
