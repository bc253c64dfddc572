"""Near duplicates: SuperMinHash signatures, banding, exact confirmation on whole shingle sets, connected components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.common import passing, plain, release_memory, scratch_table, slices, small_batches, written
from foliant.llm.graph import components
from foliant.llm.words import Words, mix, whole_windows, windows
from foliant.scale import cut_lineage, small_side

#: Words of a shingle; percent of the union that two linked sets share.
SHINGLE, PERCENT = 5, 75
#: Slots of a signature, and rows of a band: 32 bands of 4 slots miss a pair at 75 % with 5 in a million.
SLOTS, BAND = 128, 4
#: Elements whose permutations are held at once (SLOTS bytes each).
BLOCK = 100_000
#: Shingles, and members, of a bucket that meet in one block; pairs of members whose counts are held at once.
BLOCK_SHINGLES, BLOCK_MEMBERS, STRIP_CELLS = 1 << 20, 4_096, 1 << 20


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word shingles; a text of fewer words is one shingle, one of none has no set."""
    w = Words(texts, lower=True)
    counts = w.counts()
    five = windows(w.hashes, SHINGLE)
    short = {n: windows(w.hashes, n) for n in range(1, SHINGLE)}
    out = []
    for begin, n in zip(w.bounds[:-1].tolist(), counts.tolist()):
        out.append(np.unique(five[begin : begin + n - SHINGLE + 1]) if n >= SHINGLE else short[n][begin : begin + 1] if n else np.zeros(0, np.uint64))
    return out


def superminhash(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures (a row for each set) of SuperMinHash.

    The elements' random permutations are correlated with their ranks: an element offers (rank, fraction) to the slot
    at each rank of its own permutation, so every slot of a large set is filled by low ranks. All elements take one
    rank after another together; a set stops at the rank that can no longer improve any of its slots.
    """
    out = np.full((len(sets), SLOTS), np.iinfo(np.uint64).max)
    if not len(sets):
        return out
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    cells = out.reshape(-1)
    for start in range(0, len(flat), BLOCK):
        element, doc = flat[start : start + BLOCK], owner[start : start + BLOCK]
        order = np.tile(np.arange(SLOTS, dtype=np.uint8), (len(element), 1))
        active = np.arange(len(element))
        for rank in range(SLOTS):
            bits = mix(element[active] + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 % 2**64))
            pick = rank + (((bits >> np.uint64(32)) * np.uint64(SLOTS - rank)) >> np.uint64(32)).astype(np.int64)
            slot = order[active, pick]
            order[active, pick] = order[active, rank]
            value = (np.uint64(rank) << np.uint64(32)) | (bits & np.uint64(0xFFFFFFFF))
            np.minimum.at(cells, doc[active] * SLOTS + slot, value)
            first, last = doc[active[0]], doc[active[-1]]
            worst = out[first : last + 1].max(axis=1) >> np.uint64(32)
            active = active[worst[doc[active] - first] > rank]
            if not len(active):
                break
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A hash of each band of each signature, different for equal slots of different bands."""
    bands = signatures.reshape(len(signatures), SLOTS // BAND, BAND)
    keys = np.broadcast_to(np.arange(SLOTS // BAND, dtype=np.uint64), bands.shape[:2])
    for i in range(BAND):
        keys = mix(keys * np.uint64(0xD1342543DE82EF95) + bands[:, :, i])
    return keys


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "_text"):
            sets = shingle_sets(part.column("_text"))
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            keys = band_keys(superminhash(sets)).view(np.int64)
            bands = [k if len(s) else None for k, s in zip(keys, sets)]
            columns = [pa.array(digests, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.record_batch([part.column("_id"), *columns], ["_id", "content", "n", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "_text"):
            sets = [s for s in shingle_sets(part.column("_text")) if len(s)]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pa.record_batch([pa.array(digests, pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["content", "shingles"])


def _sets_of(contents: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Whole shingle sets of the given contents."""
    needed = contents.distinct().join(classes, "content").select("rep").distinct()
    # checked by count; beyond it the texts are joined by a shuffle
    same = F.col("_id").eqNullSafe(F.col("rep"))  # a content that only rows without an id hold is among their texts
    chosen = texts.join(small_side(needed, max_rows=500_000), same, "left_semi")
    return written(chosen.select("_text").mapInArrow(_sets, "content binary, shingles array<long>").dropDuplicates(["content"]), "shingles")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (``a``, ``b`` of contents) that share enough of their whole sets."""
    left, right = sets.toDF("a", "_left"), sets.toDF("b", "_right")
    both = F.size(F.array_intersect("_left", "_right"))
    enough = F.lit(100) * both >= F.lit(PERCENT) * (F.size("_left") + F.size("_right") - both)
    return plain(pairs.join(left, "a").join(right, "b").where(enough).select("a", "b"), "links")


def _node(*more: str) -> Column:
    """What orders classes: those with an id first, by the smallest."""
    return F.struct(F.isnull("rep").alias("none"), "rep", "content", *more)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` (smallest id reachable over links) and ``kept`` of every row.

    1. Rows with equal shingle sets are one class, so copies cost one row each and are never paired.
    2. Classes that share a band of their SuperMinHash signature are candidates. Each bucket's members are confirmed
       against its smallest member, and components are formed. Only members of a bucket that still holds several
       components go on. Buckets of the same members (a group of near copies fills one in most bands) are united, so
       that a member meets the others once and not in each of them. Blocks of a union, bounded by shingles and by
       members, meet in tasks that count shared shingles by matrix products of a strip of members at a time and return
       the links that join components. Blocks of the union's largest component do not meet each other. So a large
       group of near copies costs a row for each member and partner block, and no task more than two blocks; pairs are
       never rows, and no two components that a link joins stay apart. Members of a union that are all components of
       their own meet in every pair of their blocks.
    3. A link is confirmed on the whole sets: 100 * shared >= 75 * union.

    Null, empty and blank texts have no set and are their own component. Equal rows come back as often as they went
    in, with one verdict. Rows that share an id but not a text are judged by their texts. A null id is never the
    smallest: rows without an id link others like any, and their component has no id if none of its rows has one.
    """
    kind = docs.schema[id_col].dataType
    with passing(docs.sparkSession):
        out = _classes(docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")), kind)
        out = out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", (F.col("_id") == F.col("component_id")).alias("kept"))
        return scratch_table(out, "verdicts")


def _classes(docs: DataFrame, kind: T.DataType) -> DataFrame:
    """``_id``, ``n`` and ``component_id`` of each row (``_id``, ``_text``)."""
    texts = small_batches(docs)
    schema = T.StructType([T.StructField("_id", kind), *T.StructType.fromDDL("content binary, n long, bands array<long>").fields])
    rows = written(texts.mapInArrow(_sketch, schema), "sketches")
    found = rows.where("content is not null").groupBy("content").agg(F.min("_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = written(found, "classes")
    buckets = classes.select("content", "rep", "n", F.explode("bands").alias("key"))
    pivots = buckets.groupBy("key").agg(F.min(_node("n")).alias("pivot"), F.count(F.lit(1)).alias("members")).where("members > 1")
    # written apart, here and below, so that the next join has a shuffle of its own on both sides and can split a hot key
    pivots = plain(pivots, "pivots")
    alike = F.lit(100) * F.least("n", "m") >= F.lit(PERCENT) * F.greatest("n", "m")
    # members of buckets with company; what the later steps need of the buckets
    shared = plain(buckets.join(pivots, "key").select("key", "content", "rep", "n", "pivot"), "buckets")
    star = shared.select(F.col("content").alias("a"), F.col("pivot.content").alias("b"), "n", F.col("pivot.n").alias("m")).where("a <> b").where(alike).select("a", "b").distinct()
    names = classes.select("content", _node().alias("node"))
    star = plain(star, "star")
    links = _confirmed(star, _sets_of(star.select(F.explode(F.array("a", "b")).alias("content")), classes, texts))
    roots = _roots(links, names)
    apart = _apart(shared.select("key", "content", "n", _node().alias("own")), roots)
    sets = _sets_of(apart.select("content"), classes, texts)
    found = apart.join(sets, "content").groupBy("key", "i", "j").applyInArrow(_block_links, "a binary, b binary")
    links = plain(links.unionByName(found.distinct()), "all-links")
    roots = plain(_roots(links, names), "roots")
    result = plain(classes.select("content", "rep").join(roots, "content", "left").select("content", F.coalesce("root.rep", "rep").alias("component_id")), "components")
    return rows.select("_id", "content", "n").join(result, "content", "left").withColumn("component_id", F.coalesce("component_id", "_id"))


def _united(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(``key``, ``content``, ``n``, ``root``): members of the buckets that hold several components, as what they meet in.

    Two members of a bucket are apart only after they were compared, so buckets of two are done. Every member takes the
    smallest member that it meets in any such bucket, then the smallest that one of those took. Buckets whose members
    agree are one unit, if their members then cross fewer times and meet in fewer pairs; all others are units of their own.
    """
    placed = plain(members.join(roots, "content", "left").withColumn("root", F.coalesce("root", "own").getField("content")).drop("own"), "placed")
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("members"), F.min("content").alias("least"))
    mixed = plain(mixed.where("low <> high and members > 2").select("key", "least"), "mixed")
    left = plain(placed.join(mixed, "key"), "unfinished")
    labels = plain(left.groupBy("content").agg(F.min("least").alias("label")), "labels")
    least = plain(left.drop("least").join(labels, "content").groupBy("key").agg(F.min("label").alias("least")), "least")
    labels = plain(left.drop("least").join(least, "key").groupBy("content").agg(F.min("least").alias("label")), "labels")
    named = plain(left.drop("least").join(labels, "content"), "labelled")

    def cost(n: Column, shingles: Column) -> list[Column]:
        return [(shingles * _blocks(n, shingles)).alias("sent"), (n * n).alias("pairs")]

    keys = named.groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("_other"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("s")).where("label = _other")
    keys = plain(keys.select("key", "label", *cost(F.col("m"), F.col("s"))), "agreed")
    apart = keys.groupBy("label").agg(F.sum("sent").alias("sent_apart"), F.sum("pairs").alias("pairs_apart"))
    whole = named.join(keys.select("key"), "key", "left_semi").select("label", "content", "n").distinct()
    whole = whole.groupBy("label").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s")).select("label", *cost(F.col("m"), F.col("s")))
    better = whole.join(apart, "label").where("sent < sent_apart and pairs <= pairs_apart").select("label")
    united = plain(keys.join(better, "label").select("key", F.col("label").alias("_unit")), "united")
    alone = F.concat(F.lit("key "), F.col("key").cast("string")).cast("binary")
    units = named.join(united, "key", "left").select(F.coalesce("_unit", alone).alias("key"), "content", "n", "root")
    return plain(units.distinct(), "units")


def _blocks(members: Column, total: Column) -> Column:
    return F.greatest(F.ceil(total / BLOCK_SHINGLES), F.ceil(members / BLOCK_MEMBERS))


def _apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the units (see ``_united``) once for each pair of blocks (``i``, ``j``) of their unit that they are in."""
    placed = _united(members, roots)
    parts = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("total"))
    units = parts.groupBy("key").agg(F.sum("members").alias("members"), F.sum("total").alias("total"), F.max(F.struct("members", "root", "total")).alias("top"))
    rest = _blocks(F.col("members") - F.col("top.members"), F.col("total") - F.col("top.total"))
    sized = units.select("key", F.col("top.root").alias("top"), rest.alias("rest"), _blocks(F.col("top.members"), F.col("top.total")).alias("tops"))
    # blocks of the largest component come after those of the rest, and meet those alone
    dealt = placed.join(plain(sized, "sized"), "key").withColumn("_top", F.col("root") == F.col("top"))
    own = F.when(F.col("_top"), F.col("rest") + F.pmod(F.xxhash64("content"), F.col("tops"))).otherwise(F.pmod(F.xxhash64("content"), F.col("rest")))
    met = F.when(F.col("_top"), F.col("rest")).otherwise(F.col("rest") + F.col("tops"))
    dealt = dealt.withColumn("block", own).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), met - 1)))
    return cut_lineage(dealt.select("key", "content", "root", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j")))


def _shared(owner: np.ndarray, shingle: np.ndarray, rows: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
    """Number of shingles that each member of ``rows`` shares with each of ``columns``; ``owner`` of ``n`` members, by ``shingle``."""
    row_of, column_of = np.full(n, -1), np.full(n, -1)
    row_of[rows], column_of[columns] = np.arange(len(rows)), np.arange(len(columns))
    row, column = row_of[owner], column_of[owner]
    in_rows, in_columns = (np.bincount(shingle[x >= 0], minlength=shingle[-1] + 1 if len(shingle) else 0) > 0 for x in (row, column))
    both = in_rows & in_columns
    held = both[shingle]
    row, column, shingle = row[held], column[held], (np.cumsum(both) - 1)[shingle[held]]
    shared = np.zeros((len(rows), len(columns)), np.float32)
    step = max(64, 4_000_000 // max(n, 1))
    for low in range(0, int(both.sum()), step):
        width = min(step, int(both.sum()) - low)
        a, b = np.searchsorted(shingle, [low, low + width])
        r, c, what = row[a:b], column[a:b], shingle[a:b] - low
        one, two = np.zeros((len(rows), width), np.float32), np.zeros((len(columns), width), np.float32)
        one[r[r >= 0], what[r >= 0]] = 1
        two[c[c >= 0], what[c >= 0]] = 1
        shared += one @ two.T
    return shared


def _block_links(members: pa.Table) -> pa.Table:
    """Links that join all components which those between the members of two blocks of a bucket, or of one, join."""
    members = members.combine_chunks()
    content, root, block = (np.array(members[c].to_pylist(), object) for c in ("content", "root", "block"))
    lists = members["shingles"].combine_chunks()
    sizes = pa.compute.list_value_length(lists).to_numpy()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, shingle, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    common = times[shingle] > 1
    order = np.argsort(shingle[common], kind="stable")
    owner, shingle = owner[common][order], np.unique(shingle[common][order], return_inverse=True)[1]
    component = np.unique(root.astype("S"), return_inverse=True)[1] if len(root) else np.zeros(0, int)
    # members of the largest component need no comparison among themselves
    top = component == np.bincount(component).argmax()
    if members["i"][0].as_py() == members["j"][0].as_py():
        sides = [(np.flatnonzero(~top), np.arange(len(sizes)))]
    else:
        left, right = block == members["i"][0].as_py(), block == members["j"][0].as_py()
        sides = [(np.flatnonzero(left & ~top), np.flatnonzero(right)), (np.flatnonzero(left & top), np.flatnonzero(right & ~top))]
    links = []
    for left, right in sides:
        strip = max(1, STRIP_CELLS // max(len(right), 1))
        for start in range(0, len(left) if len(right) else 0, strip):
            rows = left[start : start + strip]
            shared = _shared(owner, shingle, rows, right, len(sizes)).astype(np.int64)
            union = sizes[rows][:, None] + sizes[right][None, :] - shared
            x, y = np.nonzero((100 * shared >= PERCENT * union) & (component[rows][:, None] != component[right][None, :]))
            if len(x):
                component = _joined(component, rows[x], right[y], links)
    del lists, owner, shingle, sizes
    release_memory()
    return pa.table({"a": pa.array([content[i] for i, _ in links], pa.binary()), "b": pa.array([content[i] for _, i in links], pa.binary())})


def _joined(component: np.ndarray, x: np.ndarray, y: np.ndarray, links: list[tuple[int, int]]) -> np.ndarray:
    """Components after the links between ``x`` and ``y``; those that join two are appended to ``links``."""
    root = np.arange(len(component)).tolist()

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    # of all links between two components, the first
    first = np.unique(component[x] * len(component) + component[y], return_index=True)[1]
    for i, j in zip(x[first].tolist(), y[first].tolist()):
        a, b = find(component[i]), find(component[j])
        if a != b:
            root[b] = a
            links.append((i, j))
    return np.array([find(c) for c in range(len(root))])[component]


def _roots(links: DataFrame, names: DataFrame) -> DataFrame:
    """(``content``, ``root``) of all linked classes; a node is (no id, smallest id, content), so the root has the smallest id."""
    a, b = names.toDF("a", "na"), names.toDF("b", "nb")
    edges = links.join(a, "a").join(b, "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    return components(edges).select(F.col("node.content").alias("content"), "root")
