"""Merkle manifest of a table: every second level is stored, proofs are made by building the levels between again."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import positions, small_batches, written

#: Nodes that become one node of the next level; levels from one stored level to the next, and nodes below one of its nodes.
FANOUT, EVERY = 16, 2
SUBTREE = FANOUT**EVERY

_UP = "array<struct<before: string, after: string>>"


@dataclass
class Manifest:
    """Stored levels: leaves and every second level above them, of each group, and the same over the groups' roots.

    A stored node has ``key``, ``i`` (its place), ``n`` (nodes of its level), ``hash`` and what a leaf carries.
    """

    groups: list[DataFrame]
    top: list[DataFrame]
    carried: list[str]


def field(value: Column) -> Column:
    """What a value adds to its row's digest: ``-`` if null, else its length in bytes, ``:`` and itself."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*values: Column) -> Column:
    """Digest of a row of these values."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def build(rows: DataFrame, group: str, order: Sequence[str], carried: Sequence[str] = ()) -> Manifest:
    """The manifest of ``rows`` (``leaf`` and the named columns).

    Each ``group`` (null is one) has a tree over its leaves in ``order``, equal ones by ``leaf``; a tree over the groups'
    roots, ordered by group, ends in the root. ``FANOUT`` consecutive nodes, the last run maybe fewer, become one until
    one is left. Tasks hold ``SUBTREE`` digests. No rows, no nodes.
    """
    named = small_batches(rows).select(field(F.col(group)).alias("key"), F.struct(group, *carried).alias("more"), F.struct(*order).alias("place"), F.col("leaf").alias("hash"))
    groups = _stored(named, ["place", "hash"])
    roots = _tops(groups).select(F.lit("").alias("key"), F.struct(F.col("key").alias("of")).alias("more"), F.struct(f"more.{group}").alias("place"), "hash")
    return Manifest(groups, _stored(roots, ["place"]), [group, *carried])


def _stored(leaves: DataFrame, order: list[str]) -> list[DataFrame]:
    """The leaves and every second level above them, until each key has one node."""
    placed = positions(leaves, "key", order)
    levels = [written(placed.select("key", F.col("_pos").alias("i"), F.col("_n").alias("n"), "hash", "more"), "level")]
    while not levels[-1].where("n > 1").isEmpty():
        below = levels[-1]
        built = _subtrees(below).mapInArrow(_climb, "key string, i long, n long, hash string").withColumn("more", F.lit(None).cast(below.schema["more"].dataType))
        # what a group's leaves share goes up with its first node
        first = below.where("n > 1 and i = 0").select("key", F.col("more").alias("_more"), F.lit(0).cast("long").alias("i"))
        levels.append(written(built.join(first, ["key", "i"], "left").withColumn("more", F.coalesce("more", "_more")).drop("_more"), "level"))
    return levels


def _subtrees(level: DataFrame) -> DataFrame:
    """The nodes below each node of the next stored level, in order, for keys that have one."""
    below = F.sort_array(F.collect_list(F.struct("i", "hash", "more"))).alias("nodes")
    return level.where("n > 1").groupBy("key", "n", F.floor(F.col("i") / SUBTREE).alias("above")).agg(below)


def _tops(levels: list[DataFrame]) -> DataFrame:
    """The last node of each key."""
    found = [level.where("n = 1") for level in levels]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _levels(hashes: list[str], n: int) -> list[list[str]]:
    """``hashes`` and the levels that are built from them up to the next stored one; ``n`` nodes are in their whole level."""
    levels = [hashes]
    for _ in range(EVERY):
        if n == 1:
            break
        last = levels[-1]
        levels.append([hashlib.sha256("".join(last[j : j + FANOUT]).encode()).hexdigest() for j in range(0, len(last), FANOUT)])
        n = -(-n // FANOUT)
    return levels


def _climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, numbers, places, nodes = (batch.column(c) for c in ("key", "n", "above", "nodes"))
        hashes = [_levels(nodes[j].values.field("hash").to_pylist(), n)[-1][0] for j, n in enumerate(numbers.to_pylist())]
        counts = [-(-n // SUBTREE) for n in numbers.to_pylist()]
        yield pa.record_batch([keys, places, pa.array(counts, pa.int64()), pa.array(hashes, pa.string())], ["key", "i", "n", "hash"])


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The way up from each node of a subtree: its siblings, level by level, then the way up from the subtree's top."""
    for batch in batches:
        for j in range(batch.num_rows):
            nodes, upper = batch.column("nodes")[j].values, batch.column("up")[j].as_py()
            levels = _levels(nodes.field("hash").to_pylist(), batch.column("n")[j].as_py())
            # the siblings of every node that was built again, once
            around = []
            for level in levels[:-1]:
                runs = [level[a : a + FANOUT] for a in range(0, len(level), FANOUT)]
                around.append([{"before": "".join(run[:b]), "after": "".join(run[b + 1 :])} for run in runs for b in range(len(run))])
            up = [[level[i // FANOUT**depth] for depth, level in enumerate(around)] + upper for i in range(len(nodes))]
            size = len(nodes)
            ups = pa.array(up, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))
            shared = [pa.repeat(batch.column(c)[j], size) for c in ("key", "subroot", "root")]
            yield pa.record_batch([shared[0], nodes.field("i"), nodes.field("hash"), nodes.field("more"), ups, *shared[1:]], ["key", "i", "hash", "more", "up", "subroot", "root"])


def _ways(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The way up (``up``) from each leaf, given those from the tops (``key``, ``up``, ``subroot``, ``root``).

    Going down, each stored level is built from the one above: the levels between are made again from the nodes of one
    subtree at a time and are not kept.
    """
    above = None
    for depth, level in reversed(list(enumerate(levels))):
        columns = ["key", "i", "hash", "more", "up", "subroot", "root"]
        here = level.where("n = 1").join(tops, "key").select(*columns)
        if above is not None:
            more = level.schema["more"].dataType.simpleString()
            joined = _subtrees(level).join(above.select("key", F.col("i").alias("above"), "up", "subroot", "root"), ["key", "above"])
            here = here.unionByName(joined.mapInArrow(_descend, f"key string, i long, hash string, more {more}, up {_UP}, subroot string, root string"))
        above = written(here, "ways") if depth else here
    return above


def proofs(manifest: Manifest) -> DataFrame:
    """Each leaf with what it carries, ``subroot``, ``root`` and ``up``: for every level the digests of the run's other
    nodes before and after it, joined."""
    # of the one tree over the groups, its last node is the root; its way up is empty
    start = _tops(manifest.top).select("key", F.array().cast(_UP).alias("up"), F.col("hash").alias("subroot"), F.col("hash").alias("root"))
    groups = written(_ways(manifest.top, start).select(F.col("more.of").alias("key"), "up", F.col("hash").alias("subroot"), "root"), "ways")
    return _ways(manifest.groups, groups).select(*[F.col(f"more.{c}").alias(c) for c in manifest.carried], F.col("hash").alias("leaf"), "subroot", "root", "up")


def folded(leaf: Column, up: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(up, leaf, lambda h, run: F.sha2(F.concat(run["before"], h, run["after"]), 256))


def siblings_digest(up: Column) -> Column:
    """Digest of all siblings, level by level."""
    return F.sha2(F.array_join(F.transform(up, lambda run: F.concat(run["before"], run["after"])), ""), 256)


def verified(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id", group: str = "source", tampered: Column | None = None) -> DataFrame:
    """``id_col``, ``group``, ``leaf``, ``subroot``, ``root``, ``up``, ``proof_sha256``, ``folded_root`` and ``verified`` of each row.

    ``tampered``: the digest that a row is checked with instead of its own (null: its own), as of a copy that may have
    changed. Leaves go by id in their group, null first, then by digest. Null fields and a null group are values of
    their own; repeated rows are as many leaves; other columns are left out; no rows give no rows.
    """
    leaf = digest(*[F.col(f) for f in fields])
    check = leaf if tampered is None else F.coalesce(tampered, leaf)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(group).alias("_group"), leaf.alias("leaf"), check.alias("_check"))
    found = proofs(build(rows, "_group", ["_id"], ["_id", "_check"])).withColumn("folded_root", folded(F.col("_check"), F.col("up")))
    return found.select(
        F.col("_id").alias(id_col), F.col("_group").alias(group), "leaf", "subroot", "root", "up", siblings_digest(F.col("up")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
