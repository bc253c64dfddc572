"""Prefix trie of conversations: blocks of turns are grouped first, turns only inside blocks whose siblings differ."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import positions, small_batches, written

#: Turns of a block; blocks of a span, within which one task adds up a conversation.
BLOCK, SPAN = 8, 4_096
#: Words of 60 bits in the digest of a run of blocks.
LANES = 3
#: Conversation ids are written out in stretches of 2**ID_BITS ids.
ID_BITS = 12

_LANES = [f"l{j}" for j in range(LANES)]
#: Digest of no block, that of the root.
_NONE = "X'" + "0" * 16 * LANES + "'"


def turns(conversations: DataFrame) -> DataFrame:
    """(``c``, ``pos``, ``n``, ``d``, ``chars``): each turn's place in its conversation of ``n`` turns, digest and code points.

    Turns go by ``turn``, null first, then by role and digest. Null roles and texts are empty; rows without a
    conversation belong to none and are left out. Texts stay where they are read.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("_turn"), role.alias("_role"), turn_digest(role, text).alias("d"), F.char_length(text).cast("long").alias("chars")
    )
    placed = positions(rows, "c", ["_turn", "_role", "d"])
    return written(placed.select("c", F.col("_pos").alias("pos"), F.col("_n").alias("n"), "d", "chars"), "turns")


def turn_digest(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def spliced(rows: DataFrame, head: Column, shared: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``head`` turns (of column ``c``) are those of conversation ``shared``.

    Returns (``c``, ``length``) of all, turnless ones too, and their turns (``c``, ``pos``, ``d``, ``chars``). ``head`` must
    have a small bound, as must the number of conversations that share one; a conversation's own turns after its
    first ``head`` follow. Own turns meet their conversation by stretches, so a long one is not one task's.
    """
    own = rows.where("pos = 0").select("c", "n", head.cast("long").alias("head"), shared.alias("of"))
    known = own.join(own.select(F.col("c").alias("of"), F.col("n").alias("_of_n")), "of", "left").withColumn("shift", F.least("head", F.coalesce("_of_n", F.lit(0))))
    convs = written(known.select("c", "of", "n", "head", "shift", (F.col("shift") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("length")), "conversations")
    stretches = convs.where("n > head").withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, 16)))).select("c", "_at", "head", "shift")
    rest = rows.withColumn("_at", F.shiftright("pos", 16)).join(stretches, ["c", "_at"]).where("pos >= head")
    rest = rest.select("c", (F.col("pos") - F.col("head") + F.col("shift")).alias("pos"), "d", "chars")
    most = convs.agg(F.max("head").alias("m")).first()["m"] or 0
    heads = rows.where(F.col("pos") < most).select(F.col("c").alias("of"), "pos", "d", "chars").join(convs.select("c", "of", "head"), "of").where("pos < head")
    return convs.select("c", "length"), rest.unionByName(heads.select("c", "pos", "d", "chars"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Blocks of each conversation: digests of what is ``before`` and of what ends with the block (``own``), its turns,
    code points before it (``pre``) and whether it is the ``last``.

    The digest of a run of blocks is the exclusive or of 180 bits of each block's and its number's SHA-256, so that
    spans of a long conversation are added up apart.
    """
    dealt = rows.withColumn("span", F.floor(F.col("pos") / (BLOCK * SPAN))).withColumn("k", F.floor(F.col("pos") / BLOCK)).repartition("c", "span")
    blocks = dealt.groupBy("c", "span", "k").agg(F.sort_array(F.collect_list(F.struct("pos", "d", "chars"))).alias("turns"))
    whole = F.aggregate("turns", F.col("k").cast("string").cast("binary"), lambda a, t: F.concat(a, t["d"]))
    blocks = blocks.withColumn("_sha", F.sha2(whole, 256)).withColumn("chars", F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["chars"]))
    blocks = blocks.withColumns({lane: F.conv(F.substring("_sha", 1 + 15 * j, 15), 16, 10).cast("long") for j, lane in enumerate(_LANES)})
    spans = blocks.groupBy("c", "span").agg(*[F.bit_xor(lane).alias(f"_{lane}") for lane in _LANES], F.sum("chars").alias("_chars"))
    along = Window.partitionBy("c").orderBy("span")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.bit_xor(f"_{lane}").over(earlier), F.lit(0)).alias(f"c_{lane}") for lane in _LANES]
    spans = spans.select("c", "span", *carried, F.coalesce(F.sum("_chars").over(earlier), F.lit(0)).alias("c_chars"), F.lead("span").over(along).isNull().alias("_final"))
    inside = Window.partitionBy("c", "span").orderBy("k")
    here = inside.rowsBetween(Window.unboundedPreceding, -1)
    before = {lane: F.coalesce(F.bit_xor(lane).over(here), F.lit(0)) for lane in _LANES}
    blocks = blocks.select(
        "c", "span", "k", "turns", *_LANES, *[v.alias(f"b_{lane}") for lane, v in before.items()],
        F.coalesce(F.sum("chars").over(here), F.lit(0)).alias("b_chars"), F.lead("k").over(inside).isNull().alias("_end"),
    ).join(spans, ["c", "span"])

    def key(words: list[Column]) -> Column:
        return F.unhex(F.concat(*[F.lpad(F.hex(w), 16, "0") for w in words]))

    earlier = [F.col(f"b_{lane}").bitwiseXOR(F.col(f"c_{lane}")) for lane in _LANES]
    return blocks.select(
        "c", "span", "k", "turns", key(earlier).alias("before"), key([w.bitwiseXOR(F.col(lane)) for w, lane in zip(earlier, _LANES)]).alias("own"),
        (F.col("b_chars") + F.col("c_chars")).alias("pre"), (F.col("_end") & F.col("_final")).alias("last"),
    )


def _key_at(j: Column) -> Column:
    """Digest of a block's first ``j`` turns and all before; that of whole blocks is ``own``, that of none ``before``."""
    some = F.unhex(F.sha2(F.aggregate(F.slice("turns", 1, j), F.col("before"), lambda a, t: F.concat(a, t["d"])), 256))
    return F.when(j == 0, F.col("before")).when(j == BLOCK, F.col("own")).otherwise(some)


def _boundaries(classes: DataFrame, *sums: str) -> DataFrame:
    """A row for each turn of each block: its node, with the block's ``sums``."""

    def node(j: Column) -> Column:
        turn = F.element_at("turns", j)
        pre = F.aggregate(F.slice("turns", 1, j - 1), F.col("pre"), lambda a, t: a + t["chars"])
        return F.struct(_key_at(j).alias("key"), _key_at(j - 1).alias("parent"), (F.col("k") * BLOCK + j).alias("depth"), turn["d"].alias("d"), pre.alias("pre"))

    places = F.sequence(F.lit(1), F.size("turns"))
    return classes.select(F.explode(F.transform(places, node)).alias("node"), *sums).select("node.*", *sums)


def _nodes(alone: DataFrame, rest: DataFrame, aggregates: dict[str, Column]) -> DataFrame:
    """Nodes of blocks without siblings as they are, those of the others grouped by turn."""
    sums = list(aggregates)
    grouped = _boundaries(rest, *sums).groupBy("key").agg(*[F.first(c).alias(c) for c in ("parent", "depth", "d", "pre")], *[v.alias(c) for c, v in aggregates.items()])
    columns = ["key", "parent", "depth", "d", "pre", *sums]
    return _boundaries(alone, *sums).select(*columns).unionByName(grouped.select(*columns))


def trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """Nodes of the trie of conversations (``c``, ``length``) with turns (``c``, ``pos``, ``d``, ``chars``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256`` (of the decimal ids, numerically ascending, of the conversations that end there) and ``d`` (digest of
    the last turn; the root has none). Conversations without a turn end at the root. No conversations, no nodes.

    1. Conversations are grouped by the digests of their blocks of ``BLOCK`` turns. Where all that reach a block boundary go
       on with one block, the nodes inside it are that block's. Only blocks with siblings are cut at each turn, one row
       for each turn of each different block, and grouped again.
    2. A conversation owns the nodes whose smallest member it is: all of its nodes from one depth on. With the code points
       before that depth (``w``: of nodes owned by others), the subtree of a node saves the ``w`` of its members but its
       smallest, less the code points before the node for each of these; its leaves are members that own their last
       node, if it has no child. So subtrees are sums over members, by blocks again, and need no rounds.
    """
    blocks = written(_blocks(rows), "blocks")
    grouped = blocks.groupBy("own").agg(*[F.first(c).alias(c) for c in ("k", "before", "turns", "pre")], F.count(F.lit(1)).alias("n"), F.min("c").alias("rep"))
    classes = written(grouped, "classes")
    siblings = classes.groupBy("before").agg(F.count(F.lit(1)).alias("m"), F.first(F.struct(*classes.columns)).alias("block"))
    alone = written(siblings.where("m = 1").select("block.*"), "alone")
    rest = written(classes.join(alone.select("own"), "own", "left_anti"), "siblings")

    nodes = written(_nodes(alone, rest, {"n": F.sum("n"), "rep": F.min("rep")}), "nodes")
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, "key", "left").fillna(0, "n_children"), "nodes")
    # the first node that each conversation owns
    tops = written(nodes.groupBy("rep").agg(F.min(F.struct("depth", "key", "parent", "pre")).alias("top")).select("rep", "top.*"), "tops")

    last = blocks.where("last").select("c", _key_at(F.size("turns")).alias("key"), F.aggregate("turns", F.col("pre"), lambda a, t: a + t["chars"]).alias("total"), "span")
    last = written(last, "ends")
    leaves = nodes.where("n_children = 0").select(F.col("rep").alias("c"), F.lit(1).cast("long").alias("leaf"))
    owned = last.join(tops.select(F.col("rep").alias("c"), F.col("pre").alias("_pre")), "c", "left").join(leaves, "c", "left")
    weights = written(owned.select("c", "span", F.coalesce("_pre", "total").alias("w"), F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf")), "weights")
    spans = weights.select("c", F.explode(F.sequence(F.lit(0).cast("long"), "span")).alias("span"), "w", "leaf")
    sums = blocks.select("c", "span", "own").join(spans, ["c", "span"]).groupBy("own").agg(F.sum("w").alias("w"), F.sum("leaf").alias("leaf"), F.min(F.struct("c", "w")).alias("least"))
    sums = written(sums, "sums")
    totals = {"w": F.sum("w"), "leaf": F.sum("leaf"), "least": F.min("least")}
    below = _nodes(*[part.join(sums, "own") for part in (alone, rest)], totals).select("key", "leaf", (F.col("w") - F.col("least.w")).alias("w"))

    # written, so that the next join has a shuffle of its own on both sides and can split a parent of many
    parents = written(tops.where("depth > 1").select("key", "parent").join(nodes.select(F.col("key").alias("parent"), F.col("rep").alias("above")), "parent").select("key", "above"), "parents")
    ends = _end_digests(last.select("key", "c").unionByName(convs.where("length = 0").select(F.expr(_NONE).alias("key"), "c")))
    root = convs.agg(F.min("c").alias("rep"), F.count(F.lit(1)).alias("n"))
    least = root.select(F.col("rep").alias("_first"))
    roots = root.where("n > 0").crossJoin(weights.agg(F.coalesce(F.sum("w"), F.lit(0)).alias("w"), F.sum("leaf").alias("leaf"))).crossJoin(nodes.where("depth = 1").agg(F.count(F.lit(1)).alias("n_children")))  # one row each
    nothing = F.lit(None).cast("long")
    roots = roots.select(
        F.expr(_NONE).alias("key"), F.col("rep").alias("conv_id"), F.lit(0).cast("long").alias("depth"), nothing.alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        F.coalesce("leaf", F.lit(1)).cast("long").alias("n_leaves"), F.col("w").cast("long").alias("saved_tokens"), F.lit(None).cast("binary").alias("d"),
    )
    found = nodes.join(below, "key").join(parents, "key", "left").crossJoin(F.broadcast(least))  # one row
    above = F.when(F.col("depth") == 1, F.col("_first")).otherwise(F.coalesce("above", "rep"))
    found = found.select(
        "key", F.col("rep").alias("conv_id"), F.col("depth").cast("long").alias("depth"), above.alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        F.col("leaf").alias("n_leaves"), (F.col("w") - (F.col("n") - 1) * F.col("pre")).alias("saved_tokens"), "d",
    )
    return found.unionByName(roots).join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))).drop("key")


def _end_digests(ends: DataFrame) -> DataFrame:
    """``ends_sha256`` of the ids ``c`` of each ``key``.

    Ids are sorted and joined by stretches of ids; keys of one stretch are done then, the stretches of the others are
    read in order through one digest, a batch at a time.
    """
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda c: c.cast("string")), ",")
    parts = written(small_batches(ends).groupBy("key", F.shiftright("c", ID_BITS).alias("at")).agg(joined.alias("ids")), "end-parts")
    whole = written(parts.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.first("ids").alias("ids")), "end-keys")
    long = parts.join(whole.where("m > 1").select("key"), "key", "left_semi").repartition("key").sortWithinPartitions("key", "at")
    schema = "key binary, ends_sha256 string"
    return whole.where("m = 1").select("key", F.sha2("ids", 256).alias("ends_sha256")).unionByName(long.mapInArrow(_streamed, schema))


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key = state = None
    for batch in batches:
        keys, digests = [], []
        for now, ids in zip(batch.column("key").to_pylist(), batch.column("ids")):
            if now != key:
                if state is not None:
                    keys.append(key)
                    digests.append(state.hexdigest())
                key, state = now, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_buffer())
        yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])
    if state is not None:
        yield pa.record_batch([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["key", "ends_sha256"])


def with_texts(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes with ``role`` and ``text`` of their last turn."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    said = conversations.select(turn_digest(role, text).alias("d"), role.alias("role"), text.alias("text")).dropDuplicates(["d"])
    return nodes.join(said, "d", "left")
