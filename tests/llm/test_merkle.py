"""Merkle manifest against a plain construction, and against tampering."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from foliant.llm import merkle
from foliant.llm.queries import op11_merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, root string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Root, and the siblings of each node on its way up with the place among them."""
    ways, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        runs = [level[a : a + 16] for a in range(0, len(level), 16)]
        for way, i in zip(ways, at):
            way.append((runs[i // 16][: i % 16], runs[i // 16][i % 16 + 1 :]))
        at, level = [i // 16 for i in at], [h("".join(r)) for r in runs]
    return level[0], ways


def brute(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each of the rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    ordered = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in ordered:
        members = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        made[s] = (members, *climb([leaf_of(r) for r in members]))
    root, ups = climb([made[s][1] for s in ordered])
    out = []
    for s, up in zip(ordered, ups):
        members, subroot, ways = made[s]
        for r, way in zip(members, ways):
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now = leaf_of((*r[:4], text))
            for before, after in way + up:
                now = h("".join(before) + now + "".join(after))
            proof = h("".join(x for before, after in way + up for x in before + after))
            out.append((r[0], leaf_of(r), subroot, root, proof, now, now == root))
    return sorted(out, key=repr)


def found(spark, tmp_path, rows):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA).write.parquet(path)
    return sorted((tuple(r) for r in op11_merkle_manifest(spark, str(tmp_path)).collect()), key=repr)


def sized(name, n):
    return [(i, name, "en" if i % 3 else None, i, f"Text {i} of {name}") for i in range(n)]


@pytest.mark.parametrize("sizes", [[1], [257, 17, 16, 2], [600, 256] + [1] * 16])
def test_equals_plain_construction(spark, tmp_path, sizes):
    rows = [r for k, n in enumerate(sizes) for r in sized(f"s{k}", n)]
    assert found(spark, tmp_path, rows) == brute(rows)


def test_odd_rows(spark, tmp_path):
    rows = sized("b", 20) + sized("é", 3) + sized("", 2) + sized(None, 18)
    rows += [(None, "b", None, None, None), (None, "b", None, None, "X"), (None, None, None, None, None)]  # nulls everywhere
    rows += [(4, "b", "en", 1, "Other text with an id used twice"), rows[0], rows[0]]  # ties and repeated rows
    rows += [(5, "b", "en", 0, ""), (7, "b", "de", 2_000_000, "Ä B" * 700_000), (-3, "b", "-", 1, "1:A")]
    result = found(spark, tmp_path, rows)
    assert result == brute(rows)
    assert {r[6] for r in result} == {True, False}


def test_no_rows(spark, tmp_path):
    assert found(spark, tmp_path, []) == []


def test_given_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted((tuple(r) for r in op11_merkle_manifest(spark, sf_dir).collect()), key=repr) == brute(rows)


def test_stored_levels(spark):
    """Every second level is stored, the ones between are not."""
    rows = spark.range(5_000).select(F.lit("one").alias("of"), "id", F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    manifest = merkle.build(rows, "of", ["id"], ["id"])
    assert [level.count() for level in manifest.groups] == [5_000, 20, 1]
    proof = merkle.proofs(manifest).where("id = 4999").first()
    assert [len(run.before + run.after) // 64 for run in proof.up] == [7, 8, 3, 1]
