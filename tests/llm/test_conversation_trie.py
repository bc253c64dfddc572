"""Conversation trie against one that is built turn by turn."""

import hashlib
import random
import zlib

import pytest

from foliant.llm import conversation_trie
from foliant.llm.queries import op12_conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def brute(rows):
    talks = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            talks.setdefault(c, []).append(((turn is not None, turn or 0, role.encode(), digest), (role, text)))
    talks = {c: [t for _, t in sorted(v)] for c, v in talks.items()}
    rebuilt = {}
    for c in talks:
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(talks.get(c - c % 100, [])[:h] + talks[c][h:])
    members = {}
    for c, talk in sorted(rebuilt.items()):
        for d in range(len(talk) + 1):
            members.setdefault(talk[:d], []).append(c)
    children, leaves, saved = {k: 0 for k in members}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in m if len(rebuilt[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.append((m[0], len(node), parent, len(m), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(spark, tmp_path, rows):
    spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    return sorted((tuple(r) for r in op12_conversation_trie(spark, str(tmp_path)).select(*COLUMNS).collect()), key=repr)


def talks(seed):
    """Few different turns, so that conversations part at every depth, in and between blocks; copies; long ones."""
    rng = random.Random(seed)
    rows = []
    for c in range(150):
        for turn in range(rng.choice([1, 2, 7, 8, 9, 16, 17, 30])):
            rows.append((c, turn, ("user", "assistant")[turn % 2], "same" if rng.random() < 0.93 else f"é{rng.randrange(2)}"))
    for c in range(1_000, 1_030):  # copies of one conversation of three blocks, and one that goes on
        rows += [(c, turn, "user", f"copied {turn}") for turn in range(24 + 9 * (c == 1_020))]
    return rows


def test_equals_plain_trie(spark, tmp_path):
    rows = talks(1)
    assert found(spark, tmp_path, rows) == brute(rows)


def test_long_conversations_in_spans(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(conversation_trie, "SPAN", 2)
    monkeypatch.setattr(conversation_trie, "ID_BITS", 2)
    rows = talks(2) + [(c, turn, "user", f"long {turn % 7}") for c in (2_000, 2_300) for turn in range(32 + c % 64)]
    assert found(spark, tmp_path, rows) == brute(rows)


def test_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, None, "user", "b"), (1, None, "user", "a"), (None, 1, "user", "lost")]  # nulls, ties
    rows += [(7, 3, "user", "twice"), (7, 3, "user", "twice"), (7, 3, "a", "twice"), (8, 1, "user", "x" * 3_000_000)]  # repeated rows, a very long text
    rows += [(c, 0, "user", "only") for c in range(200, 260)]  # some of them lose their one turn
    rows += [(300, t, "user", f"t{t}") for t in range(2)] + [(c, t, "user", f"t{t}") for c in range(301, 340) for t in range(7)]  # a head of fewer turns
    rows += [(-5, 0, "user", "below"), (-105, 0, "user", "below"), (2**60, 0, "user", "above")]
    assert found(spark, tmp_path, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(1, 0, "user", "x")]])
def test_hardly_any_rows(spark, tmp_path, rows):
    assert found(spark, tmp_path, rows) == brute(rows)


def test_texts_of_nodes(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, None, "b"), (2, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    turns = conversation_trie.turns(rows)
    convs, whole = conversation_trie.spliced(turns, conversation_trie.F.lit(0), conversation_trie.F.col("c"))
    nodes = conversation_trie.with_texts(conversation_trie.trie(convs, whole), rows).select("depth", "role", "text", "n_convs").collect()
    assert sorted(map(tuple, nodes), key=repr) == [(0, None, None, 2), (1, "user", "a", 2), (2, "", "b", 1)]
