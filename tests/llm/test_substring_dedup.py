"""Repeated passages against a count of all runs of 35 words."""

import random
import re
from collections import Counter

import pytest

from foliant.llm.substring_dedup import LENGTH, without_repeats


def brute(rows):
    """[(id, number of words, kept words, stretches that go)] in order."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    runs = Counter(tuple(w[i : i + LENGTH]) for w in words for i in range(len(w) - LENGTH + 1))
    out = []
    for (key, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - LENGTH + 1):
            if runs[tuple(w[i : i + LENGTH])] > 1:
                gone.update(range(i, i + LENGTH))
        out.append((key, len(w), " ".join(x for i, x in enumerate(w) if i not in gone), len(gone)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.kept_text, sum(s.end - s.start for s in r.repeats)) for r in df.collect()), key=repr)


def found(spark, rows):
    return result(without_repeats(spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, places int")))


def corpus(seed):
    rng = random.Random(seed)

    def new(n):
        return [f"w{rng.randrange(400)}" for _ in range(n)]

    passages = [new(n) for n in (20, 34, 35, 36, 50, 90, 200)]
    texts = [None, "", " \n", "a b c", " ".join(["x"] * 34), " ".join(["x"] * 36), " ".join(["y"] * 35), " ".join(["a", "b"] * 30)]
    for _ in range(60):
        words = new(rng.randrange(40))
        for p in rng.sample(passages, rng.randrange(4)):
            cut = rng.randrange(0, 6)
            words += p[cut:] + new(rng.randrange(30))
        texts.append((" " if rng.random() < 0.5 else "\n").join(words))
    texts += [texts[20], texts[20], texts[21] + " "]  # copies, one of them with another white space
    twice = new(60)
    texts.append(" ".join(twice + new(5) + twice))  # a repeat in one text
    return list(enumerate(texts)) + [(9, "other text with an id used twice"), (9, " ".join(passages[6])), (9, " ".join(passages[6])), (None, " ".join(passages[5] + ["z"]))]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == brute(rows)


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert result(without_repeats(docs)) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_empty_table(spark):
    assert found(spark, []) == []


def test_very_long_text(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**6)}" for _ in range(120_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[60_000:60_100]))]
    assert found(spark, rows) == brute(rows)
