"""Contamination against a search of every window, and the plan of the main path."""

import random
import re

import pytest

from foliant.llm.decontaminate import contamination

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for key, text in items:
        w = words(text)
        for i in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(key))
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if owners := windows.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= owners
        out.append((key, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def found(spark, docs, items):
    d = spark.createDataFrame([(k, t, 1, "s") for k, t in docs], "doc_id long, text string, place int, shingle string")
    b = spark.createDataFrame([(k, t, 2) for k, t in items], "item_id long, text string, doc_id int")
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in contamination(d, b).collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)

    def new(n):
        return [rng.choice(["the", "of", "and"]) if rng.random() < 0.5 else f"W{rng.randrange(60)}é" for _ in range(n)]

    items = [(i, new(rng.choice([10, 11, 14, 30]))) for i in range(12)] + [(12, new(1)), (13, new(2)), (14, new(3)), (15, new(9)), (3, new(12)), (16, []), (17, ["the"] * 12)]
    docs = [(0, None), (1, ""), (2, "?! \x7f"), (3, "the " * 40)]
    for i in range(4, 60):
        w = new(rng.randrange(30))
        for _ in range(rng.randrange(3)):
            piece = rng.choice(items)[1]
            cut = rng.randrange(2)
            w += piece[cut:] + new(rng.randrange(8))
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w)))
    docs += [docs[20], docs[20], (20, docs[21][1]), (None, " ".join(items[0][1]))]
    return docs, [(k, " ".join(w)) for k, w in items] + [(18, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs, items = corpus(seed)
    assert found(spark, docs, items) == brute(docs, items)


def test_items_too_many_to_send(spark, monkeypatch):
    monkeypatch.setattr("foliant.llm.decontaminate.MAX_SENT", 3)
    docs, items = corpus(3)
    assert found(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b c")]) == []
    assert found(spark, [(1, "a b c")], []) == [(1, 3, 0, [])]


def test_very_long_text(spark):
    rng = random.Random(4)
    w = [f"x{rng.randrange(1000)}" for _ in range(60_000)]
    docs, items = [(1, " ".join(w)), (2, "x " * 50_000)], [(1, " ".join(w[50_000:50_020])), (2, " ".join(["x"] * 10))]
    assert found(spark, docs, items) == brute(docs, items)


def test_no_python_in_the_plan(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = contamination(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
