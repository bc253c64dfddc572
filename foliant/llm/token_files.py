"""Token files: ids ranked by frequency, in one to four bytes each, with the lengths in separate control bytes.

A block holds the ids of consecutive documents: ``control`` has two bits for each id (its number of bytes less one,
four ids a byte, the first in the low bits), ``data`` the ranks in little-endian bytes. Blocks are rows of Parquet
files, written uncompressed in ascending order of documents; ``vocabulary`` beside them lists the id of each rank.
"""

from __future__ import annotations

import itertools
import os
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from foliant.llm.common import per_process, slices, small_batches, written

#: The id put after each document; ids of a block, at least (a block ends with a document).
END_ID, BLOCK_IDS = 0, 65_536
#: Fixed value: white space as the tokenizer's pattern sees it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space and the word after it. The pattern has a boundary between any other character and white space, so the
#: ids of a text are those of its units one after another.
UNIT = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
INNER = re.compile(f"[{_SPACE}].*[^{_SPACE}]", re.DOTALL)
#: Texts that are not cut by bytes: these have single spaces and line feeds only, none at the ends.
OTHERWISE = r"[ \n]{2}|^[ \n]|[ \n]$|[\t\x0b\x0c\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Their units end before white space, and between a Latin letter (of one or two bytes) and an ASCII sign, where the
#: pattern also has a boundary always.
BLANK, SIGN, LETTER = 1, 2, 4
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*b" \n"]] = BLANK
_CLASS[[*string.punctuation.encode()]] = SIGN
_CLASS[[*string.ascii_letters.encode()]] = LETTER
#: Units of up to this many bytes are told apart as two whole numbers, longer ones as bytes.
SHORT = 16
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Units that a worker remembers before it begins anew; bytes of text whose units are made distinct together.
REMEMBERED, TOGETHER_BYTES = 1_000_000, 4_000_000
#: Units encoded in one call.
TOGETHER = 2_000


def unit_starts(raw: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the units of plain texts begin; ``texts``: where these do."""
    kind = _CLASS[raw]
    blanks, signs = np.flatnonzero(kind == BLANK), np.flatnonzero(kind == SIGN)
    one, two = raw[np.maximum(signs - 1, 0)], raw[np.maximum(signs - 2, 0)]
    # U+00C0 to U+024F but for the two signs among them
    wide = (two >= 0xC3) & (two <= 0xC9) & ~((two == 0xC3) & ((one == 0x97) | (one == 0xB7))) & ~((two == 0xC9) & (one > 0x8F)) & (one >= 0x80)
    first = np.zeros(len(raw) + 1, bool)
    first[blanks] = True
    first[signs[(kind[np.maximum(signs - 1, 0)] == LETTER) | wide]] = True
    first[texts] = True
    return np.flatnonzero(first[:-1])


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the runs that begin at ``starts``, one run after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(where the values begin and the last one ends, all bytes) of strings or binaries without nulls."""
    held = values.cast(pa.large_binary())
    edges = np.frombuffer(held.buffers()[1], np.int64, len(held) + 1, held.offset * 8) if len(held) else np.zeros(1, np.int64)
    data = np.frombuffer(held.buffers()[2], np.uint8) if edges[-1] else np.zeros(0, np.uint8)
    return edges - edges[0], data[edges[0] : edges[-1]]


def _mixed(low: np.ndarray, high: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One number for each unit; different units seldom have the same one."""
    mixed = low * np.uint64(0x9E3779B97F4A7C15)
    mixed = ((mixed ^ mixed >> np.uint64(32)) + high) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed ^ mixed >> np.uint64(29)) + sizes.astype(np.uint64)


class UnitEncoder:
    """Ids of texts by the tokenizers library, each distinct unit encoded about once in a worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        # a byte-level token has one character for each byte
        self.lengths = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self._forget()

    def _forget(self) -> None:
        # rows of short units: mixed number (sorted, with its row), the two numbers, the size, and where its ids are
        self.mixed, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.low, self.high, self.size = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint8)
        self.at, self.count, self.ids = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint32)
        self.long: dict[bytes, np.ndarray] = {}

    def _direct(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where those of each unit begin, their number) from the library.

        ``inner`` units begin with white space and end without, and may follow one another in one call.
        """
        at, count = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        parts, held, alone = [np.zeros(0, np.uint32)], 0, [np.flatnonzero(~inner)]
        places = np.flatnonzero(inner)
        for group in (places[i : i + TOGETHER] for i in range(0, len(places), TOGETHER)):
            ids = self._direct([raw[_spread(starts[group], sizes[group])].tobytes().decode()])[0]
            ends, wanted = np.cumsum(self.lengths[ids]), np.cumsum(sizes[group])
            cuts = np.searchsorted(ends, wanted) + 1
            if len(ids) and (ends[np.minimum(cuts, len(ends)) - 1] == wanted).all():
                count[group] = np.diff(cuts, prepend=0)
                at[group] = held + cuts - count[group]
                parts.append(ids)
                held += len(ids)
            else:
                alone.append(group)
        rest = np.concatenate(alone)
        ids = self._direct([raw[a : a + n].tobytes().decode() for a, n in zip(starts[rest].tolist(), sizes[rest].tolist())])
        count[rest] = [len(x) for x in ids]
        at[rest] = held + np.cumsum(count[rest]) - count[rest]
        return np.concatenate(parts + ids), at, count

    def _learn(self, low: np.ndarray, high: np.ndarray, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """New rows of short units of plain texts."""
        ids, at, count = self._encoded(raw, starts, sizes, _CLASS[raw[starts]] == BLANK)
        rows = np.arange(len(self.low), len(self.low) + len(starts), dtype=np.int32)
        self.low, self.high = np.concatenate([self.low, low]), np.concatenate([self.high, high])
        self.size = np.concatenate([self.size, sizes.astype(np.uint8)])
        self.at, self.count = np.concatenate([self.at, (len(self.ids) + at).astype(np.int32)]), np.concatenate([self.count, count.astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids])
        return rows

    def _known(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, inner: np.ndarray) -> list[bytes]:
        """Ids, as bytes, of units of any size and kind."""
        names = [raw[a : a + n].tobytes() for a, n in zip(starts.tolist(), sizes.tolist())]
        if new := {name: i for i, name in enumerate(names) if name not in self.long}:
            chosen = np.fromiter(new.values(), np.int64)
            ids, at, count = self._encoded(raw, starts[chosen], sizes[chosen], inner[chosen])
            self.long.update((name, ids[a : a + n].tobytes()) for name, a, n in zip(new, at.tolist(), count.tolist()))
        return list(map(self.long.__getitem__, names))

    def _short(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Rows of units of up to ``SHORT`` bytes; ``raw`` goes on for as many bytes behind the last one."""
        words = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
        low, high = words[starts] & _LOW_BYTES[np.minimum(sizes, 8)], words[starts + 8] & _LOW_BYTES[np.maximum(sizes, 8) - 8]
        mixed = _mixed(low, high, sizes)
        coded = pa.array(mixed).dictionary_encode()
        codes, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        first = np.zeros(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]

        def rows() -> tuple[np.ndarray, np.ndarray]:
            places = np.searchsorted(self.mixed, distinct)
            known = np.zeros(len(distinct), bool)
            inside = places < len(self.mixed)
            known[inside] = self.mixed[places[inside]] == distinct[inside]
            return places, known

        places, known = rows()
        if not known.all():
            new = first[~known]
            row, order = self._learn(low[new], high[new], raw, starts[new], sizes[new]), np.argsort(mixed[new])
            at = np.searchsorted(self.mixed, mixed[new][order])
            self.mixed, self.row = np.insert(self.mixed, at, mixed[new][order]), np.insert(self.row, at, row[order])
            places, _ = rows()
        found = self.row[places][codes]
        # two units may have one mixed number: those that are not the remembered one get rows for this once
        other = np.flatnonzero((self.low[found] != low) | (self.high[found] != high) | (self.size[found] != sizes))
        if len(other):
            found[other] = self._learn(low[other], high[other], raw, starts[other], sizes[other])
        return found

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text) of plain texts."""
        edges, whole = _flat(texts)
        raw = np.concatenate([whole, np.zeros(2 * SHORT, np.uint8)])
        starts = unit_starts(whole, edges)
        sizes = np.diff(starts, append=edges[-1])
        short = sizes <= SHORT
        counts, at = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        rows = self._short(raw, starts[short], sizes[short])
        counts[short], at[short] = self.count[rows], self.at[rows]
        pool, long = self.ids, np.flatnonzero(~short)
        if len(long):
            ids = self._known(raw, starts[long], sizes[long], _CLASS[raw[starts[long]]] == BLANK)
            counts[long] = [len(x) // 4 for x in ids]
            at[long] = len(pool) + np.cumsum(counts[long]) - counts[long]
            pool = np.concatenate([pool, np.frombuffer(b"".join(ids), np.uint32)])
        ends = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, edges)]
        return pool[_spread(at, counts)], np.diff(ends)

    def _odd(self, text: str) -> np.ndarray:
        """Ids of any other text; one with a special token in it is encoded as a whole."""
        if any(s in text for s in self.special):
            return self._direct([text])[0]
        units = UNIT.findall(text)
        sizes = np.array([len(u.encode()) for u in units], np.int64)
        inner = np.array([INNER.fullmatch(u) is not None for u in units], bool)
        return np.frombuffer(b"".join(self._known(np.frombuffer(text.encode(), np.uint8), np.cumsum(sizes) - sizes, sizes, inner)), np.uint32)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self.low) > REMEMBERED or len(self.long) > REMEMBERED // 4:
            self._forget()
        odd = pa.compute.match_substring_regex(texts, OTHERWISE)
        for s in self.special:
            odd = pa.compute.or_(odd, pa.compute.match_substring(texts, s))
        flat, counts = self._pieces(texts.filter(pa.compute.invert(odd)))
        plain = iter(np.split(flat, np.cumsum(counts)[:-1]) if len(counts) else [])
        return [self._odd(t.as_py()) if o else next(plain) for o, t in zip(odd.to_pylist(), texts)]


def id_type(path: str) -> np.dtype:
    """How ids of a tokenizer are kept on the way: of one size, high byte first, so that bytes order as the ids do."""
    return np.dtype(">u2" if max(Tokenizer.from_file(path).get_vocab().values()) < 1 << 16 else ">u4")


def _ids(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(where the ids of each document begin and the last one's end, all ids)."""
    edges, data = _flat(column)
    return edges // kind.itemsize, data.view(kind)


def _encode(path: str, kind: np.dtype):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = per_process(("units", path), lambda: UnitEncoder(path))
        for batch in batches:
            for part in slices(batch, "_text", TOGETHER_BYTES):
                ids = [np.append(x, END_ID).astype(kind).tobytes() for x in enc.encode(part.column("_text"))]
                yield pa.record_batch([part.column("_id"), pa.array(ids, pa.binary())], ["_id", "ids"])

    return encode


def _counts(kind: np.dtype):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            seen = np.bincount(_ids(batch.column("ids"), kind)[1], minlength=len(total))
            seen[: len(total)] += total
            total = seen
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(total[used])], ["token", "n"])

    return count


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of whole numbers below 2**32."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    code = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    code[: len(ranks)] = size - 1
    control = code[::4] | code[1::4] << 2 | code[2::4] << 4 | code[3::4] << 6
    most = int(size.max(initial=1))
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[:, :most][np.arange(most) < size[:, None]].tobytes()


#: Bytes of each of the four numbers of a control byte.
SIZES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The first ``count`` numbers of a block."""
    size = SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    starts = np.cumsum(size) - size
    padded = np.frombuffer(data + bytes(3), np.uint8)
    out = np.zeros(count, np.uint32)
    for i in range(int(size.max(initial=0))):
        out |= np.where(size > i, padded[starts + i], 0).astype(np.uint32) << np.uint32(8 * i)
    return out


def _blocks(rank_of: np.ndarray, key_type: pa.DataType, kind: np.dtype):
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("ids", pa.list_(key_type)), ("counts", pa.list_(pa.int32())), ("control", pa.binary()), ("data", pa.binary())])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before, keys, tokens, held = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def closed() -> pa.RecordBatch:
            control, data = pack(rank_of[np.concatenate(tokens)])
            row = [part, number, before, keys, [len(t) for t in tokens], control, data]
            return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, schema)], schema)

        for batch in batches:
            edges, flat = _ids(batch.column("ids"), kind)
            for key, (a, b) in zip(batch.column("_id").to_pylist(), itertools.pairwise(edges.tolist())):
                keys.append(key)
                tokens.append(flat[a:b])
                held += b - a
                if held >= BLOCK_IDS:
                    yield closed()
                    number, before, keys, tokens, held = number + 1, before + held, [], [], 0
        if keys:
            yield closed()

    return block


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", model_path: str = public_tokenizers.path("byte_bpe_50k.json")) -> None:
    """Write the ids of all texts, each followed by ``END_ID``, to ``path`` in ascending order of ``id_col``.

    Null and empty texts have the end id only. Rows that share an id follow one another in the order of their ids of
    tokens; null ids come first. Frequencies are counted over the whole corpus, ties go to the lower id.
    """
    key, kind = docs.schema[id_col].dataType, id_type(model_path)
    rows = small_batches(docs).select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    encoded = written(rows.mapInArrow(_encode(model_path, kind), T.StructType([T.StructField("_id", key), T.StructField("ids", T.BinaryType())])), "ids")
    seen = encoded.select("ids").mapInArrow(_counts(kind), "token int, n long").groupBy("token").agg(F.sum("n").alias("n"))
    table = seen.toArrow().sort_by([("n", "descending"), ("token", "ascending")])  # at most one row for each id of the vocabulary
    by_rank = table["token"].to_numpy()
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    spark = docs.sparkSession
    spark.createDataFrame([(i, int(t)) for i, t in enumerate(by_rank)], "rank int, token int").coalesce(1).write.parquet(f"{path}/vocabulary")
    out = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("before", T.LongType()), T.StructField("ids", T.ArrayType(key)), T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("control", T.BinaryType()), T.StructField("data", T.BinaryType())])
    ordered = encoded.repartitionByRange("_id").sortWithinPartitions("_id", "ids")
    arrow_kind = pa.schema(docs.select(id_col).limit(0).toArrow().schema).field(0).type
    ordered.mapInArrow(_blocks(rank_of, arrow_kind, kind), out).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def _unblock(by_rank: np.ndarray):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                counts = row.column("counts").flatten().to_numpy()
                ends = np.cumsum(counts)
                tokens = by_rank[unpack(row.column("control")[0].as_py(), row.column("data")[0].as_py(), int(ends[-1]))]
                start = row.column("start")[0].as_py() + ends - counts
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(tokens, pa.int32()))
                yield pa.record_batch([row.column("ids").flatten(), pa.array(start), lists], ["_id", "start", "ids"])

    return read


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, ``start`` (ids of all documents before it) and ``ids`` (with the end id) of every document in the files."""
    blocks = spark.read.parquet(f"{path}/blocks")
    by_rank = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").toArrow()["token"].to_numpy()
    # one row for each part: as many as the writer had tasks
    size = F.aggregate("counts", F.lit(0).cast("long"), lambda n, c: n + c)
    sizes = blocks.groupBy("part").agg(F.sum(size).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    placed = blocks.join(F.broadcast(offsets), "part").withColumn("start", F.col("offset") + F.col("before"))
    out = T.StructType([T.StructField("_id", blocks.schema["ids"].dataType.elementType), T.StructField("start", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return placed.select("ids", "counts", "control", "data", "start").mapInArrow(_unblock(by_rank), out).withColumnRenamed("_id", id_col)


def checksums(tokens: DataFrame, ids_col: str = "ids", out_col: str = "ids_crc32") -> DataFrame:
    """All columns but ``ids_col``, and the crc32 of its numbers as little-endian unsigned 32-bit integers."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids_col)
            flat = lists.flatten().to_numpy().astype("<u4")
            ends = np.cumsum(pa.compute.list_value_length(lists).fill_null(0).to_numpy()).astype(np.int64)
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in itertools.pairwise([0, *ends.tolist()])]
            rest = [n for n in batch.schema.names if n != ids_col]
            yield pa.record_batch([*[batch.column(n) for n in rest], pa.array(sums, pa.int64())], [*rest, out_col])

    return tokens.mapInArrow(crc, T.StructType([f for f in tokens.schema.fields if f.name != ids_col] + [T.StructField(out_col, T.LongType())]))
