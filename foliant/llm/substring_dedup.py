"""Repeated passages: winnowed anchors are joined as seeds, seeds are extended to whole windows, windows to maximal repeats.

Every run of ``LENGTH`` words has one anchor: the smallest hash (the last of equal ones) among its runs of ``GRAM``
words. Equal runs have equal anchors at equal places, so a repeat of ``LENGTH`` words or more always has a common seed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.common import slices, small_batches, written
from foliant.llm.words import Words, text_bytes, whole_windows, windows
from foliant.scale import cut_lineage, small_side

#: Words of the shortest repeat that counts, and of an anchor.
LENGTH, GRAM = 35, 8
#: Ids, seeds and stretches that are sent to the texts if there are no more (8 to 16 bytes each, so up to 128 MB); else
#: the texts are shuffled to them.
MAX_IDS, MAX_SEEDS, MAX_SPANS = 4_000_000, 16_000_000, 4_000_000
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def content_of(text: bytes) -> bytes:
    """Digest of the words of a text, whatever stands between them."""
    return hashlib.sha256(b" ".join(text.split())).digest()


def _contents(texts: pa.Array) -> list[bytes]:
    data, offsets = text_bytes(texts)
    whole = data.tobytes()
    return [content_of(whole[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def _short(contents: list[bytes]) -> np.ndarray:
    """The first eight bytes as a number: it only picks candidates, texts are told apart by the whole digest or again from their words."""
    return np.frombuffer(b"".join(c[:8] for c in contents), ">i8").astype(np.int64)


def anchors(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word of each run of LENGTH words, place of its anchor, hashes of all runs of GRAM words)."""
    grams = windows(w.hashes, GRAM)
    starts = whole_windows(w.bounds, LENGTH, len(w.hashes))
    best, size, width = np.arange(len(grams)), 1, LENGTH - GRAM + 1

    def later(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(grams[right] <= grams[left], right, left)

    while 2 * size <= width:
        best = later(best[:-size], best[size:])
        size *= 2
    return starts, later(best[starts], best[starts + width - size]) if len(starts) else starts, grams


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Content, number of words and anchors of each text."""
    for batch in batches:
        for part in slices(batch, "_text"):
            w = Words(part.column("_text"))
            place, grams = anchors(w)[1:]
            place = np.unique(place)
            cuts = np.searchsorted(place, w.bounds)
            hashes = [grams[place[a:b]].view(np.int64) for a, b in zip(cuts[:-1], cuts[1:])]
            places = [(place[a:b] - at).astype(np.int32) for a, b, at in zip(cuts[:-1], cuts[1:], w.bounds)]
            columns = [pa.array(_contents(part.column("_text")), pa.binary()), pa.array(w.counts(), pa.int64()), pa.array(places, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64()))]
            yield pa.record_batch([part.column("_id"), *columns], ["_id", "content", "n", "places", "anchors"])


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All runs of LENGTH words around the seeds of each text: (text, first word, anchor, hash of the run)."""
    for batch in batches:
        for part in slices(batch, "_text"):
            w = Words(part.column("_text"))
            same = _short(_contents(part.column("_text"))) == part.column("short").to_numpy()
            starts, place, grams = anchors(w)
            seeded = np.zeros(len(w.hashes) + 1, bool)
            for at, chosen, ok in zip(w.bounds[:-1], part.column("places"), same):
                if ok:
                    chosen = at + chosen.values.to_numpy()
                    seeded[chosen[chosen < len(seeded)]] = True
            chosen = np.flatnonzero(seeded[place])
            runs = windows(w.hashes, LENGTH)[starts[chosen]]
            cuts = np.searchsorted(starts[chosen], w.bounds)
            first = [(starts[chosen[a:b]] - at).astype(np.int32) for a, b, at in zip(cuts[:-1], cuts[1:], w.bounds)]
            anchor = [grams[place[chosen[a:b]]].view(np.int64) for a, b in zip(cuts[:-1], cuts[1:])]
            hashes = [runs[a:b].view(np.int64) for a, b in zip(cuts[:-1], cuts[1:])]
            rows = pa.array(same)
            columns = [part.column("short"), pa.array(first, pa.list_(pa.int32())), pa.array(anchor, pa.list_(pa.int64())), pa.array(hashes, pa.list_(pa.int64()))]
            yield pa.record_batch([c.filter(rows) for c in columns], ["short", "first", "anchor", "run"])


def merged(starts: np.ndarray) -> list[dict]:
    """Maximal stretches covered by runs of LENGTH words that begin at ``starts``."""
    starts = np.unique(starts)
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > LENGTH)
    begins, ends = starts[np.append(0, breaks + 1)], starts[np.append(breaks, len(starts) - 1)] + LENGTH
    return [{"start": int(a), "end": int(b)} for a, b in zip(begins, ends)]


def _several(rows: DataFrame, keys: list[str], place: list[str]) -> DataFrame:
    """Keys that occur in two places or more; the least and the greatest hash of a place combine before the shuffle."""
    at = F.xxhash64(*place)
    return rows.groupBy(*keys).agg(F.min(at).alias("low"), F.max(at).alias("high")).where("low <> high").select(*keys)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maximal stretches of each text in place of its list of runs."""
    for batch in batches:
        found = [merged(x.values.to_numpy()) for x in batch.column("first")]
        yield pa.record_batch([batch.column("short"), pa.array(found, SPANS)], ["short", "spans"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words, repeats and kept words of each text."""
    for batch in batches:
        for part in slices(batch, "_text"):
            data, offsets = text_bytes(part.column("_text"))
            whole, counts, spans, kept = data.tobytes(), [], [], []
            for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                words = whole[a:b].split()
                entries = part.column("entries")[row]
                found = []
                if entries.is_valid and len(words) >= LENGTH:
                    short = int(_short([content_of(whole[a:b])])[0])
                    own = [e["spans"] for e in entries.as_py() if e["short"] == short]
                    # a copy goes as a whole
                    found = [{"start": 0, "end": len(words)}] if None in own else [s for spans_of in own for s in spans_of]
                counts.append(len(words))
                spans.append(found)
                edges = [0, *(x for s in found for x in (s["start"], s["end"])), len(words)]
                kept.append(b" ".join(w for i in range(0, len(edges), 2) for w in words[edges[i] : edges[i + 1]]).decode())
            columns = [pa.array(counts, pa.int64()), pa.array(spans, SPANS), pa.array(kept, pa.string())]
            yield pa.record_batch([part.column("_id"), *columns], ["_id", "n_words", "repeats", "kept_text"])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_words``, ``repeats`` (maximal stretches of words as array of (start, end)) and ``kept_text`` of every row.

    A word goes if it lies in a run of ``LENGTH`` words that also begins anywhere else, in the same text or another.
    All places of a run go, the first included; what is left is joined by single spaces.

    1. Texts with equal words are one content; a content of several rows is repeated as a whole.
    2. Anchors that occur in one place of all contents end there. The others are seeds; only the runs around them are
       hashed.
    3. A run is repeated if its (anchor, hash), 128 bits, has two different places. Keys are aggregated before the
       shuffle, places are never paired.
    4. Seeds and stretches are sent to the texts while they are few (counted), else the texts are shuffled to them.

    Null and empty texts have no words; texts shorter than ``LENGTH`` words stay whole, also copies of each other.
    Equal rows are copies of each other. Rows that share an id but not their words are different texts.
    """
    kind = docs.schema[id_col].dataType
    texts = small_batches(docs).select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = T.StructType([T.StructField("_id", kind), *T.StructType.fromDDL("content binary, n long, places array<int>, anchors array<long>").fields])
    rows = written(texts.mapInArrow(_seeds, schema).where(F.col("n") >= LENGTH), "anchors")
    short = F.conv(F.substring(F.hex("content"), 1, 16), 16, -10).cast("long")
    rows = rows.withColumn("short", short)
    classes = cut_lineage(rows.groupBy("content", "short").agg(F.count(F.lit(1)).alias("copies"), F.min("_id").alias("_of")))
    # copies give the same places again, which count once
    places = rows.select("short", F.explode(F.arrays_zip("anchors", "places")).alias("at")).select("short", F.col("at.anchors").alias("anchor"), F.col("at.places").alias("place"))
    seeds = cut_lineage(_several(places, ["anchor"], ["short", "place"]))
    seeded = places.join(seeds, "anchor").groupBy("short").agg(F.collect_set("place").alias("places"))
    seeded = seeded.join(classes.select("short", "_of"), "short")
    # null ids count as one id in these joins
    same = F.col("_id").eqNullSafe(F.col("_of"))
    seeded = cut_lineage(seeded)
    near = texts.join(small_side(seeded.select("_of").distinct(), max_rows=MAX_IDS), same, "left_semi")
    near = near.join(small_side(seeded, max_rows=MAX_SEEDS, weight=F.size("places") + 4), same).select("_text", "short", "places")
    extended = written(near.mapInArrow(_extend, "short long, first array<int>, anchor array<long>, run array<long>"), "runs")
    runs = extended.select("short", F.explode(F.arrays_zip("first", "anchor", "run")).alias("at")).select("short", "at.*")
    repeated = cut_lineage(_several(runs, ["anchor", "run"], ["short", "first"]))
    starts = runs.join(repeated, ["anchor", "run"]).groupBy("short").agg(F.collect_set("first").alias("first"))
    spans = starts.mapInArrow(_spans, "short long, spans array<struct<start:int,end:int>>")
    copied = rows.join(cut_lineage(classes.where("copies > 1").select("content")), "content").select(F.col("_id").alias("_of"), "short", F.lit(None).cast("array<struct<start:int,end:int>>").alias("spans"))
    single = classes.where("copies = 1").select("_of", "short").join(spans, "short").select("_of", "short", "spans")
    entries = copied.unionByName(single).groupBy("_of").agg(F.collect_set(F.struct("short", "spans")).alias("entries"))
    load = F.aggregate("entries", F.lit(2), lambda n, e: n + 2 + F.coalesce(F.size(e["spans"]), F.lit(0)))
    entries = small_side(entries, max_rows=MAX_SPANS, weight=load)
    out = T.StructType([T.StructField("_id", kind), *T.StructType.fromDDL("n_words long, repeats array<struct<start:int,end:int>>, kept_text string").fields])
    joined = texts.join(entries, same, "left").select("_id", "_text", "entries")
    return joined.mapInArrow(_cut, out).withColumnRenamed("_id", id_col)
