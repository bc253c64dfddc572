"""Token files against the tokenizers library, and the coding by itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from foliant.llm import token_files
from foliant.llm.token_files import UnitEncoder, checksums, pack, read_token_files, unpack, write_token_files

MODEL = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300)))
def test_coding_round_trip(numbers):
    control, data = pack(np.array(numbers, np.uint32))
    assert unpack(control, data, len(numbers)).tolist() == numbers
    assert len(control) == -(-len(numbers) // 4)


def test_small_ranks_take_one_byte():
    assert [len(pack(np.array([n]))[1]) for n in (0, 255, 256, 65535, 65536, 2**24, 2**32 - 1)] == [1, 1, 2, 2, 3, 4, 4]


def strange_texts(n):
    rng = random.Random(n)
    parts = [" ", "  ", "\n", "\t", "\x1c", "\x85", " ", "　", "​", "a", "Bc", "'ll", "'s", "9", "!", "\xe9", "中", "<|endoftext|>", "word", "\x00", "\U0001f642"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_units_give_the_ids_of_whole_texts():
    direct, units = Tokenizer.from_file(MODEL), UnitEncoder(MODEL)
    for _ in range(2):  # the second time from memory
        texts = strange_texts(3000)
        assert [x.tolist() for x in units.encode(pa.array(texts))] == [direct.encode(t, add_special_tokens=False).ids for t in texts]


def test_plain_texts_give_the_ids_of_whole_texts(sf_dir):
    direct, units = Tokenizer.from_file(MODEL), UnitEncoder(MODEL)
    rng = random.Random(8)
    parts = ["a", "Bc", "'s", "'", "9", "!", "_", "\xe9", "中", "word", ", ", " ", "\n", "²", "б"]
    texts = ["x".join(["", *(rng.choice(parts) for _ in range(rng.randrange(30))), ""]).replace("x", rng.choice(["", "x"])) for _ in range(3000)] + [""]
    for _ in range(2):
        assert [x.tolist() for x in units.encode(pa.array(texts))] == [direct.encode(t, add_special_tokens=False).ids for t in texts]


def test_units_that_look_alike_keep_their_own_ids(monkeypatch):
    """Units with one mixed number, units of the greatest size and one more, units that end in zero bytes."""
    monkeypatch.setattr(token_files, "_mixed", lambda low, high, sizes: low % np.uint64(3))
    direct, units = Tokenizer.from_file(MODEL), UnitEncoder(MODEL)
    texts = ["a b\x00 b b\x00\x00", "x" + " " + "y" * 15 + " " + "y" * 16 + " " + "y" * 17, "é-É-ɏ-ɐ-×-÷-", "it's 'tis", "", "b\x00"]
    for _ in range(2):
        assert [x.tolist() for x in units.encode(pa.array(texts))] == [direct.encode(t, add_special_tokens=False).ids for t in texts]


def test_many_units_are_remembered():
    """More units than fit one call or two hundred thousand: the second time the library is not asked again."""
    units = UnitEncoder(MODEL)
    texts = pa.array([" ".join(f"{chr(97 + i % 26)}{i}" for i in range(k, k + 1000)) for k in range(0, 400_000, 1000)])
    first = [x.tolist() for x in units.encode(texts)]
    for k in range(0, 400, 50):
        units.encode(texts.slice(k, 50))
    asked = []
    units._direct = lambda t: asked.extend(t) or []
    again = [x.tolist() for k in range(0, 400, 50) for x in units.encode(texts.slice(k, 50))]
    assert again == first and not asked


def test_a_full_memory_begins_anew(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 40)
    direct, units = Tokenizer.from_file(MODEL), UnitEncoder(MODEL)
    for _ in range(20):
        texts = strange_texts(30) + ["one two three", "a-b c"]
        assert [x.tolist() for x in units.encode(pa.array(texts))] == [direct.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(units.low) < 400 and len(units.long) < 400


def test_ids_wait_for_their_files_in_two_bytes_each(spark, tmp_path, monkeypatch):
    kept = []
    monkeypatch.setattr(token_files, "written", lambda df, label: kept.append(df) or df)
    write_token_files(spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string"), str(tmp_path / "files"))
    ids = Tokenizer.from_file(MODEL).encode("some words", add_special_tokens=False).ids
    assert sorted((r._id, bytes(r.ids)) for r in kept[0].collect()) == [(1, np.array([*ids, 0], ">u2").tobytes()), (2, b"\0\0")]


def test_rows_of_one_id_follow_the_order_of_their_ids(spark, tmp_path):
    rows = [(k % 3, t) for k, t in enumerate(strange_texts(90) + ["", "a", "a b", "a b c", "中", "中 a"] * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(spark, docs, str(tmp_path / "files")) == expected(rows)


def expected(rows):
    direct, start, out = Tokenizer.from_file(MODEL), 0, []
    for key, ids in sorted((k, direct.encode(t or "", add_special_tokens=False).ids + [0]) for k, t in rows):
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def found(spark, docs, path):
    write_token_files(docs, path)
    return sorted((r.doc_id, r.start, r.n, r.ids_crc32) for r in checksums(read_token_files(spark, path).selectExpr("*", "size(ids) AS n")).collect())


def test_files_give_everything_back(spark, tmp_path):
    rows = [(7 - i, t) for i, t in enumerate(strange_texts(300))] + [(1000, None), (1001, ""), (5, "twice"), (5, "twice"), (2000, "x " * 100_000)]
    docs = spark.createDataFrame([(k, t, 1, "n") for k, t in rows], "doc_id long, text string, ids int, start string").repartition(7)
    assert found(spark, docs, str(tmp_path / "files")) == expected(rows)


def test_given_documents(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert found(spark, docs, str(tmp_path / "files")) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark, tmp_path):
    assert found(spark, spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "files")) == []
