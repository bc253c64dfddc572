"""The pipeline against its stages done one by one in plain Python."""

import hashlib

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from foliant.llm import byte_bpe, secret_scan
from foliant.llm.queries import op4_quality_rules
from tests.llm.test_decontaminate import brute as brute_windows
from tests.llm.test_near_dedup import brute as brute_groups


def masked(text, tokens):
    spans = [(s, e) for s, _, e in secret_scan.base_spans(text)]
    spans += [m.span() for m in secret_scan.RUN.finditer(text) if secret_scan.is_random(m[0], tokens)]
    out, done = "", 0
    for start, end in sorted(spans):
        if start >= done:
            out += text[done:start] + "[SECRET]"
        done = max(done, end)
    return out + text[done:]


def test_pipeline_equals_its_stages(spark, sf_dir):
    kept = {r.doc_id for r in op4_quality_rules(spark, sf_dir).where("kept").collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.doc_id in kept]
    keep = {k for k, _, _, first in brute_groups(docs) if first}
    docs = [(k, t) for k, t in docs if k in keep]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {k for k, _, hit, _ in brute_windows(docs, items) if not hit}
    assert 0 < len(clean) < len(keep) <= len(kept)
    tokens = byte_bpe.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken")).whole.encode_ordinary
    encode = byte_bpe.encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).whole.encode_ordinary
    expected = []
    for k, t in docs:
        if k in clean:
            text = masked(t, tokens)
            ids = encode(text)
            expected.append((k, ids, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, list(r["ids"]), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(expected)


def test_encoders_and_decoders_do_not_share_a_task(spark, sf_dir, capsys):
    """Two Python operators in one task are two Python workers for each core of an executor."""
    corpus_pipeline.encode(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir).explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1


def test_stages_keep_the_columns_and_take_edges(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "x"), (None, "x"), (4, "good words " * 3 + "in a line of text that is long enough")]
    odd = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    for frame in (odd, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, sf_dir)
            assert frame.columns == docs.columns and dict(frame.dtypes) == dict(docs.dtypes)
            frame.collect()
    left = corpus_pipeline.deduplicate(spark, odd, sf_dir).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in left) == [(0, "x"), (1, ""), (2, ""), (3, "one two"), (4, rows[-1][1])]
