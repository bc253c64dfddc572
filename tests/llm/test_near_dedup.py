"""Near duplicates against all pairs compared on whole sets."""

import random
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from foliant.llm import near_dedup
from foliant.llm.near_dedup import near_duplicates


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    """{(id, number of shingles, component id, kept)} as a sorted list."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    postings, first = defaultdict(list), {}
    for i, s in enumerate(sets):
        if s in first and s:
            root[find(i)] = find(first[s])
            continue
        first[s] = i
        for g in s:
            postings[g].append(i)
    shared = defaultdict(int)
    for group in postings.values():
        for x, i in enumerate(group):
            for j in group[x + 1 :]:
                shared[i, j] += 1
    for (i, j), n in shared.items():
        if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
            root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return sorted((key, len(sets[i]), least[find(i)], key == least[find(i)]) for i, (key, _) in enumerate(rows))


def found(spark, rows):
    docs = spark.createDataFrame([(k, t, "x", 0) for k, t in rows], "doc_id long, text string, n string, content int")
    return sorted(tuple(r) for r in near_duplicates(docs).collect())


def variants(rng, base, n, edits):
    """Copies of a word list, each with a few words changed."""
    for _ in range(n):
        words = list(base)
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        yield " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n\t", "one", "One", "two words", "a b c d", "A B C D", "a b c d e"]
    for size, edits in ((40, 1), (60, 2), (120, 4), (300, 8), (9, 1), (7, 1)):
        base = [f"v{rng.randrange(5000)}" for _ in range(size)]
        texts += [" ".join(base)] * 3 + list(variants(rng, base, 12, edits))
        chain = base
        for _ in range(10):  # each close to the one before, the ends far apart
            chain = next(variants(rng, chain, 1, edits)).split(" ")
            texts.append(" ".join(chain))
    rng.shuffle(texts)
    return list(enumerate(texts)) + [(3, texts[3]), (4, "an id twice with another text here")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == brute(rows)


def test_blocks_of_a_bucket(spark, monkeypatch):
    """Groups of near copies around the threshold, in blocks of few members."""
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 300)
    rng = random.Random(9)
    base = [f"v{rng.randrange(5000)}" for _ in range(80)]
    texts = [t for edits in (1, 2, 3, 4) for t in variants(rng, base, 25, edits)]
    half = next(variants(rng, base, 1, 5)).split(" ")
    rows = list(enumerate(texts + list(variants(rng, half, 30, 2))))
    assert found(spark, rows) == brute(rows)


def templated(n):
    """Texts of 20 words that differ in the middle one: 16 shingles, 11 of them in all texts."""
    words = [f"t{i}" for i in range(20)]
    return [" ".join([*words[:10], f"own{i}", *words[11:]]) for i in range(n)]


def block_table(texts, roots, blocks=None):
    sets = near_dedup.shingle_sets(pa.array(texts))
    blocks = [0] * len(texts) if blocks is None else blocks
    names = [str(i).encode() for i in range(len(texts))]
    columns = [names, [str(r).encode() for r in roots], blocks, [0] * len(texts), [max(blocks)] * len(texts), [s.view(np.int64) for s in sets]]
    return pa.table(dict(zip(["content", "root", "block", "i", "j", "shingles"], columns)))


def test_many_short_texts_of_one_template(spark, monkeypatch):
    """None is linked to another but for one pair, so every member is a component of its own in buckets of hundreds."""
    most = 40
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", most)
    seen = []
    held = near_dedup._apart
    monkeypatch.setattr(near_dedup, "_apart", lambda *a: seen.append(held(*a)) or seen[-1])
    texts = templated(600)
    rows = list(enumerate(texts + [texts[7] + " end"]))
    assert found(spark, rows) == brute(rows)
    tasks = [r["count"] for r in seen[0].groupBy("key", "i", "j").count().collect()]
    assert len(tasks) > 32 and max(tasks) < 4 * most


def test_a_block_takes_memory_for_a_strip():
    """3,000 members without a link: nine million pairs, of which a strip is held."""
    table = block_table(templated(3_000), range(3_000))
    tracemalloc.start()
    assert near_dedup._block_links(table).num_rows == 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6


def test_a_block_returns_no_link_twice():
    """All members of two blocks are linked, also in strips of a few: links that join them, not all pairs."""
    texts = [" ".join([*(f"t{i}" for i in range(200)), f"own{k}"]) for k in range(60)]
    for roots, joins in ((range(60), 59), ([0] * 30 + [*range(30)], 29), ([0] * 60, 0)):
        for blocks in (None, [k % 2 for k in range(60)]):
            assert near_dedup._block_links(block_table(texts, roots, blocks)).num_rows == joins


def test_blocks_of_the_largest_component_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 10)
    nodes = [(b"k", str(i).encode(), 16, (i, str(i).encode()), (0, b"0") if i < 95 else None) for i in range(100)]
    node = "struct<rep: long, content: binary>"
    rows = spark.createDataFrame(nodes, f"key binary, content binary, n long, own {node}, root {node}")
    dealt = near_dedup._apart(rows.drop("root"), rows.where("root is not null").select("content", "root"))
    assert dealt.count() == 95 + 5 * 11
    pairs = {(r.i, r.j) for r in dealt.select("i", "j").collect()}
    assert pairs == {(0, j) for j in range(11)}


def test_members_of_a_group_meet_once(spark, monkeypatch):
    """Near copies of one text share most of their buckets; each of them is sent to its task once, not once for each band."""
    seen = []
    held = near_dedup._apart
    monkeypatch.setattr(near_dedup, "_apart", lambda *a: seen.append(held(*a)) or seen[-1])
    rng = random.Random(7)
    base = [f"g{i}" for i in range(100)]
    rows = list(enumerate(t for edits in (1, 2, 3, 4) for t in variants(rng, base, 200, edits)))
    assert found(spark, rows) == brute(rows)
    sent = seen[0].groupBy("content").count()
    assert sent.count() > 100 and sent.agg({"count": "avg"}).first()[0] <= 2


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in near_duplicates(docs).collect()) == brute(rows)


def test_empty_table_and_null_id(spark):
    assert found(spark, []) == []
    rows = near_duplicates(spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (None, None)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in rows) == [(-1, -1, None), (-1, 7, None), (7, 7, True)]


def test_near_copies_without_an_id(spark):
    """A third of the rows of all groups, the bridge between two, and groups that have no id at all."""
    rng = random.Random(12)
    base = [f"b{i}" for i in range(60)]
    end = base[:57] + ["x", "y", "z"]
    bridge = [(10, " ".join(["p", "q", "r", *base[3:]])), (None, " ".join(base)), (20, " ".join(end))]
    lonely = [f"c{i}" for i in range(60)]
    nobody = [(None, t) for t in variants(rng, lonely, 4, 1)]
    rows = bridge + nobody + [(None if i % 3 == 0 else i + 100, t) for i, (_, t) in enumerate(corpus(3))]
    named = [(10**6 + i if k is None else k, t) for i, (k, t) in enumerate(rows)]
    expected = [(None if k >= 10**6 else k, n, None if c >= 10**6 else c, None if k >= 10**6 else kept) for k, n, c, kept in brute(named)]
    got = sorted((tuple(r) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted(expected, key=repr)
    assert {(10, 56, 10, True), (None, 56, 10, None), (20, 56, 10, False)} <= set(got)
    assert sum(c is None and n > 0 for _, n, c, _ in got) >= 4


def test_very_long_text(spark):
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(150_000))
    assert found(spark, [(1, long), (2, long + " end"), (3, "x " * 200_000)]) == [(1, 149_996, 1, True), (2, 149_997, 1, False), (3, 1, 3, True)]


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    for n in (4, 40, 400):
        error = []
        for _ in range(100):
            pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
            a, b = np.unique(pool[: n + n // 2]), np.unique(pool[n // 2 :])
            s = near_dedup.superminhash([a, b])
            error.append((s[0] == s[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(error)) < 0.02 and np.std(error) < 1 / np.sqrt(near_dedup.SLOTS) / 2


def test_blocks_give_the_same_signature(monkeypatch):
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 700, 5, 90)]
    whole = near_dedup.superminhash(sets)
    monkeypatch.setattr(near_dedup, "BLOCK", 64)
    assert (near_dedup.superminhash(sets) == whole).all()
