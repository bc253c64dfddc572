"""Quality classifier: ordinal cumulative-link regression on graded ratings.

All grades share one weight vector w over hashed text features; ordered thresholds t cut its scale into grades:
P(grade >= k) = 1 / (1 + exp(t_k - w.x)). The expected grade is the sum of these tails; the last one selects.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.common import slices, small_batches
from foliant.llm.words import Words, mix, run_hashes

#: Hash buckets of the features; grades are 0 .. GRADES - 1.
BUCKETS, GRADES = 1 << 17, 3
#: Rated ids that a model is fitted on at most, a row each: those with the lowest hash.
FIT_ROWS = 16_000
#: Steps of the fit, its absolute penalty on weights, weight of a shape's share beside a word's presence.
STEPS, PENALTY, SHAPE_WEIGHT = 400, 5e-4, 8.0
#: Features that fewer of the fitted rows have stay at weight 0.
LEAST_ROWS = 5
#: Tail probability of the best grade from which a document is kept.
LEAST_TAIL = 0.35

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_CLASS[128:] = ord("a")
#: What stands around a word proper.
_SIGN = np.zeros(256, bool)
_SIGN[[c for c in range(128) if not chr(c).isalnum()]] = True


def _shapes(w: Words) -> np.ndarray:
    """A hash of each word's shape: classes of its characters, runs of one class as one."""
    owner = np.repeat(np.arange(len(w.starts)), w.ends - w.starts)
    first = np.cumsum(w.ends - w.starts) - (w.ends - w.starts)
    kinds = _CLASS[w.data[np.arange(len(owner)) - first[owner] + w.starts[owner]]]
    keep = np.ones(len(kinds), bool)
    keep[1:] = (kinds[1:] != kinds[:-1]) | (owner[1:] != owner[:-1])
    ends = np.cumsum(np.bincount(owner[keep], minlength=len(w.starts)))
    return run_hashes(kinds[keep], np.concatenate([[0], ends[:-1]]) if len(ends) else ends, ends)


def _cores(w: Words) -> np.ndarray:
    """A hash of each word in lower case without the ASCII signs before and after it; of a bare sign, nothing."""
    letters = np.concatenate([[0], np.cumsum(~_SIGN[w.data])])
    places = np.append(np.flatnonzero(~_SIGN[w.data]), len(w.data))
    full = letters[w.ends] > letters[w.starts]
    starts = places[letters[w.starts[full]]]
    ends = places[letters[w.ends[full]] - 1] + 1
    lower = w.data.copy()
    upper = (lower >= 65) & (lower <= 90)
    lower[upper] += 32
    out = np.zeros(len(w.starts), np.uint64)
    out[full] = run_hashes(lower, starts, ends)
    return out


def features(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, values) of each text: presence of every word, share of every shape."""
    w = Words(texts)
    words = (_cores(w) >> np.uint64(20)) % np.uint64(BUCKETS)
    shapes = (mix(_shapes(w) + np.uint64(1)) >> np.uint64(20)) % np.uint64(BUCKETS)
    out = []
    for a, b in zip(w.bounds[:-1], w.bounds[1:]):
        present = np.unique(words[a:b])
        shape, times = np.unique(shapes[a:b], return_counts=True)
        out.append((np.concatenate([present, shape]).astype(np.int32), np.concatenate([np.ones(len(present)), SHAPE_WEIGHT * times / max(b - a, 1)]).astype(np.float32)))
    return out


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of least mean negative log-likelihood plus ``PENALTY`` times the sum of absolute weights.

    Accelerated proximal gradient: the penalty leaves features that tell nothing at 0, whatever their number. All
    grades weigh alike. The thresholds are a first one and positive gaps, so they stay in order. Without rows all
    weights are 0.
    """
    weights, raw = np.zeros(BUCKETS), np.zeros(GRADES - 1)
    if not len(rows):
        return weights, np.arange(GRADES - 1, dtype=float)
    owner = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    index, value = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]).astype(float)
    common = np.bincount(index, minlength=BUCKETS) >= LEAST_ROWS
    owner, value, index = owner[common[index]], value[common[index]], index[common[index]]
    used, index = np.unique(index, return_inverse=True)
    share = np.bincount(grades, minlength=GRADES)
    weight = 1 / (np.count_nonzero(share) * share[grades])

    def scores(w: np.ndarray) -> np.ndarray:
        return np.bincount(owner, w[index] * value, len(rows))

    def back(by_row: np.ndarray) -> np.ndarray:
        return np.bincount(index, value * by_row[owner], len(used))

    def gradient(w: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cuts = np.concatenate([[-np.inf], np.cumsum(np.concatenate([t[:1], np.exp(t[1:])])), [np.inf]])
        score = scores(w)
        below = 1 / (1 + np.exp(np.clip(score - cuts[grades], -500, 500)))
        upto = 1 / (1 + np.exp(np.clip(score - cuts[grades + 1], -500, 500)))
        chance = np.maximum(upto - below, 1e-12)
        up, low = upto * (1 - upto) / chance * weight, below * (1 - below) / chance * weight
        by_cut = np.bincount(grades, -up, GRADES)[:-1] + np.bincount(grades, low, GRADES)[1:]
        return back(up - low), np.cumsum(by_cut[::-1])[::-1] * np.concatenate([[1.0], np.exp(t[1:])])

    # the largest curvature, by power iteration
    direction = np.ones(len(used))
    for _ in range(20):
        direction = back(weight * scores(direction / max(np.linalg.norm(direction), 1e-12)))
    rate = 1 / (0.5 * (np.linalg.norm(direction) + 1))
    w = ahead_w = np.zeros(len(used))
    ahead_t, momentum = raw, 1.0
    for _ in range(STEPS):
        by_w, by_t = gradient(ahead_w, ahead_t)
        moved = ahead_w - rate * by_w
        next_w, next_t = np.sign(moved) * np.maximum(np.abs(moved) - rate * PENALTY, 0), ahead_t - rate * by_t
        next_momentum = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        push = (momentum - 1) / next_momentum
        ahead_w, ahead_t = next_w + push * (next_w - w), next_t + push * (next_t - raw)
        w, raw, momentum = next_w, next_t, next_momentum
    weights[used] = w
    return weights, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def tails(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k = 1 .. GRADES - 1, a column each."""
    return 1 / (1 + np.exp(np.clip(thresholds[None, :] - score[:, None], -500, 500)))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "_text"):
            rows = features(part.column("_text"))
            columns = [part.column("_grade"), pa.array([i for i, _ in rows], pa.list_(pa.int32())), pa.array([v for _, v in rows], pa.list_(pa.float32()))]
            yield pa.record_batch([part.column("_id").cast(pa.string()), *columns], ["_id", "grade", "index", "value"])


def rated_rows(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", rows: int = FIT_ROWS) -> DataFrame:
    """``_id``, ``_grade`` and ``_text`` of the ``rows`` rated ids of lowest hash that have a document: one row for each.

    Of an id's texts, the one with the smallest hash is taken; map tasks reduce their rows before the shuffle.
    """
    rated = ratings.where(F.col(grade_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.min(grade_col).cast("int").alias("_grade"))
    sample = F.broadcast(rated.orderBy(F.xxhash64("_id"), "_id").limit(rows))  # bounded by ``rows``
    texts = small_batches(docs).select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(sample, "_id")
    one = texts.groupBy("_id", "_grade").agg(F.min(F.struct(F.xxhash64("_text").alias("hash"), "_text")).alias("least"))
    return one.select("_id", "_grade", F.col("least._text").alias("_text"))


def trained(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) from the ``rows`` rated ids of lowest hash; features are made in parallel, one task fits.

    A null grade is no rating. An id rated twice counts with its lowest grade, an id with several rows with one of its
    texts. A rated id without a document is passed over.
    """
    made = rated_rows(docs, ratings, id_col, text_col, grade_col, rows).mapInArrow(_featured, "_id string, grade int, index array<int>, value array<float>")

    def learn(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["_id", "grade"], kind="stable")  # sums do not depend on the order of arrival
        weights, thresholds = fit(list(zip(batch["index"], batch["value"])), batch["grade"].to_numpy())
        return pd.DataFrame({"weights": [weights], "thresholds": [thresholds]})

    model = made.groupBy().applyInPandas(learn, "weights array<double>, thresholds array<double>").first()
    return (np.array(model["weights"]), np.array(model["thresholds"])) if model else fit([], np.zeros(0, np.int64))


def graded(
    docs: DataFrame, weights: np.ndarray, thresholds: np.ndarray, text_col: str = "text", keep: list[str] | None = None, least_tail: float = LEAST_TAIL
) -> DataFrame:
    """The columns ``keep`` (all by default) of every row with ``score``, ``expected_grade``, ``tail`` (probability of
    the best grade), ``grade`` (most likely) and ``kept`` (``tail`` of at least ``least_tail``).

    Null and empty texts have no features and score 0. Columns of ``keep`` with a result's name are replaced by it.
    """
    results = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("expected_grade", T.DoubleType()), T.StructField("tail", T.DoubleType()), T.StructField("grade", T.IntegerType()), T.StructField("kept", T.BooleanType())])
    names = [c for c in (docs.columns if keep is None else keep) if c not in results.names]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                score = np.array([float((weights[i] * v).sum()) for i, v in features(part.column("_text"))])
                over = tails(score, thresholds)
                each = -np.diff(np.hstack([np.ones((len(score), 1)), over, np.zeros((len(score), 1))]), axis=1)
                columns = [score, over.sum(axis=1), over[:, -1], each.argmax(axis=1).astype(np.int32), over[:, -1] >= least_tail]
                yield pa.record_batch([*[part.column(c) for c in names], *map(pa.array, columns)], [*names, *results.names])

    rows = small_batches(docs).select(*names, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return rows.mapInArrow(judge, T.StructType([docs.schema[c] for c in names] + results.fields))
