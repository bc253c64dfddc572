"""Quality rules: counts per document, and the n-gram likelihood of trusted text against the raw corpus.

The method: every text is a bag of hashed byte n-grams. One multinomial is estimated from trusted documents, one from
the whole corpus; a document's score is the mean log ratio of its n-grams under the two. The weights are whole numbers
(log ratios times ``SCALE``), so sums do not depend on order and every document's verdict is the same in every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.common import slices, small_batches
from foliant.llm.words import Words, mix, run_hashes, text_bytes, whole_windows, windows
from foliant.scale import small_side

#: Bytes of an n-gram; buckets of the multinomials; units of a log ratio of 1.
GRAM, BUCKETS, SCALE = 4, 65_536, 65_536
#: Share of the target distribution that is raw: an n-gram that no trusted text has weighs its logarithm, in a corpus
#: of any size.
SMOOTHING = 0.001
#: Trusted ids up to which they are sent to all tasks; with more of them the texts are shuffled once.
MAX_SENT_IDS = 2_000_000
#: Mean log ratio below which a document is rejected.
THRESHOLD = -1.0
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the flags of each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Which of the keys occur twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def _in_text(hashes: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Hashes that only meet inside one text."""
    return mix(hashes ^ mix(owners.astype(np.uint64) + np.uint64(1)))


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """``MEASURES`` of each text (null: no words)."""
    w = Words(texts)
    n = len(w.hashes)
    letters = np.zeros(len(w.data) + 1, np.int64)
    np.cumsum((w.data & 0xC0) != 0x80, out=letters[1:])
    word_letters = letters[w.ends] - letters[w.starts]
    # a line ends at the next line feed, or where its text ends
    feeds = np.flatnonzero(w.data == 10)
    begins = np.unique(np.concatenate([w.offsets[:-1], feeds + 1]))
    begins = begins[begins < len(w.data)]
    line_owner = np.searchsorted(w.offsets, begins, side="right") - 1
    stops = np.minimum(np.append(feeds, len(w.data))[np.searchsorted(feeds, begins)], w.offsets[1:][line_owner])
    worded = np.searchsorted(w.starts, stops) > np.searchsorted(w.starts, begins)
    begins, stops, line_owner = begins[worded], stops[worded], line_owner[worded]
    keys = _in_text(run_hashes(w.data, begins, stops), line_owner)
    distinct = np.unique(keys, return_index=True)[1]
    line_bounds = np.searchsorted(begins, w.offsets)
    first = np.zeros(len(keys), bool)
    first[distinct] = True
    five = windows(w.hashes, 5)
    inside = whole_windows(w.bounds, 5, n)
    twice = inside[_repeats(_in_text(five[inside], w.owners()[inside]))]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, twice, 1)
    np.add.at(change, twice + 5, -1)
    return {
        "n_words": w.counts(),
        "word_chars": _per_text(word_letters, w.bounds),
        "n_symbols": _per_text(_SYMBOL[w.data], w.offsets),
        "n_dup_lines": _per_text(~first, line_bounds),
        "n_repeat_words": _per_text(np.cumsum(change[:-1]) > 0, w.bounds),
    }


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each n-gram, text of each, number of n-grams of each text)."""
    data, offsets = text_bytes(texts)
    counts = np.maximum(np.diff(offsets) - (GRAM - 1), 0)
    if not counts.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    code = np.zeros(len(data) - GRAM + 1, np.uint32)
    for i in range(GRAM):
        code |= data[i : len(data) - GRAM + 1 + i].astype(np.uint32) << np.uint32(8 * i)
    bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int32)
    owner = np.repeat(np.arange(len(counts)), np.diff(offsets))[: len(bucket)]
    inside = np.arange(len(bucket)) + GRAM <= offsets[1:][owner]
    return bucket[inside], owner[inside], counts


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the buckets over all rows of the task, and over its trusted rows."""
    raw, trusted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part in slices(batch, "_text"):
            bucket, owner, _ = grams(part.column("_text"))
            raw += np.bincount(bucket, minlength=BUCKETS)
            flag = part.column("_trusted").to_numpy(zero_copy_only=False).astype(bool)
            if flag.any():
                trusted += np.bincount(bucket[flag[owner]], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    yield pa.record_batch([pa.array(used, pa.int32()), pa.array(raw[used]), pa.array(trusted[used])], ["bucket", "raw", "trusted"])


def log_ratios(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Whole-number log ratio of each bucket: trusted text against all of ``docs``.

    The raw counts cover every row, the target's every row of a trusted id. The target is mixed with ``SMOOTHING`` of
    the raw distribution. Without a trusted row, or without text, every ratio is 0.
    """
    ids = trusted_ids.select(F.col(id_col).alias("_id")).where("_id is not null").distinct()
    # checked by count; beyond it the texts and the ids are joined by a shuffle
    trusted_side = small_side(ids.withColumn("_trusted", F.lit(True)), max_rows=MAX_SENT_IDS)
    texts = small_batches(docs).select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    flagged = texts.join(trusted_side, "_id", "left").select("_text", F.coalesce("_trusted", F.lit(False)).alias("_trusted"))
    counts = flagged.mapInArrow(_count_grams, "bucket int, raw long, trusted long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))
    table = counts.toArrow()  # at most BUCKETS rows, whatever the corpus
    raw, trusted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    bucket = table["bucket"].to_numpy()
    raw[bucket], trusted[bucket] = table["raw"].to_numpy(), table["trusted"].to_numpy()
    if not trusted.sum():
        return np.zeros(BUCKETS, np.int64)
    p_raw = (raw + 1) / (raw.sum() + BUCKETS)
    p_trusted = (1 - SMOOTHING) * trusted / trusted.sum() + SMOOTHING * p_raw
    return np.rint(np.log(p_trusted / p_raw) * SCALE).astype(np.int64)


def _judge(weights: np.ndarray, threshold: float, text: str = "_text"):
    limit = int(round(threshold * SCALE))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                texts = part.column(text)
                m = measures(texts)
                bucket, owner, counts = grams(texts)
                total = _per_text(weights[bucket], np.concatenate([[0], np.cumsum(counts)]))
                failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"])
                kept = ~failed & (total >= limit * counts)
                score = total / np.maximum(counts, 1) / SCALE
                columns = [part.column(c) for c in part.schema.names if c != "_text"] + [pa.array(m[c], pa.int64()) for c in MEASURES]
                yield pa.record_batch([*columns, pa.array(failed), pa.array(score), pa.array(kept)], [c for c in part.schema.names if c != "_text"] + [*MEASURES, "base_failed", "score", "kept"])

    return judge


def judged(docs: DataFrame, weights: np.ndarray, text_col: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The columns ``keep`` (all by default) of every row with its measures, ``base_failed``, ``score`` and ``kept``.

    A document is kept if it has ten words, at most a fifth of its words lie in repeated five-word windows, and its
    mean log ratio is at least ``threshold`` (a score equal to it is kept; a text under four bytes scores 0). Null and
    empty texts have no words and fail. Columns of ``keep`` that have the name of a result are replaced by it.
    """
    results = {*MEASURES, "base_failed", "score", "kept"}
    names = [c for c in (docs.columns if keep is None else keep) if c not in results]
    # a text that is kept anyway is not sent twice
    text = text_col if text_col in names else "_text"
    rows = small_batches(docs).select(*names, *([] if text in names else [F.col(text_col).alias("_text")]))
    out = [docs.schema[c] for c in names] + [T.StructField(c, T.LongType()) for c in MEASURES]
    out += [T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    return rows.mapInArrow(_judge(weights, threshold, text), T.StructType(out))
