"""Token counts through a digest cache: only texts whose count is not stored yet are encoded."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import per_process, slices, small_batches
from foliant.scale import cut_lineage

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"


def tokenizer_version(model_path: str) -> str:
    """Digest of the model file: a changed file never meets counts of another one."""
    with open(model_path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def normalised(text: str):
    """Column of the text as far as its count depends on it: null is empty, and the model's own sign for a space is a space."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), "▁", " ")


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; a cache that was never written is empty."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def _counter(model_path: str, version: str):
    schema = pa.schema([("content", pa.binary()), ("tokenizer", pa.string()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = per_process(("sentencepiece", model_path), lambda: sentencepiece.SentencePieceProcessor(model_file=model_path))
        for batch in batches:
            for part in slices(batch, "_text"):
                lengths = [len(ids) for ids in model.encode(part.column("_text").to_pylist(), num_threads=1)]
                columns = [part.column("content"), [version] * len(lengths), lengths]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema)

    return count


def token_counts(
    docs: DataFrame,
    cache_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_path: str = public_tokenizers.path("piece_bpe_32k.model"),
) -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row, by the sentencepiece model.

    The cache is Parquet at ``cache_path``: (content digest, tokenizer digest, count). Contents are made distinct
    before they are shuffled, so many copies of one text cost one encoding; misses are encoded and appended before
    this returns. Null and empty texts have no tokens, equal rows come back as often as they went in, other columns
    (whatever their names) are not read.
    """
    spark, version = docs.sparkSession, tokenizer_version(model_path)
    rows = small_batches(docs).select(F.col(id_col).alias("_id"), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"), normalised(text_col).alias("_text"))
    rows = rows.withColumn("content", F.unhex(F.sha2("_text", 256)))

    def stored() -> DataFrame:
        return read_cache(spark, cache_path).where(F.col("tokenizer") == version)

    distinct = rows.groupBy("content").agg(F.first("_text").alias("_text"))
    misses = distinct.join(stored(), "content", "left_anti")
    misses.mapInArrow(_counter(model_path, version), CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    # two runs that append at the same time may both store a count, always the same one
    # checkpointed, so that the join has a shuffle of its own on both sides and can split the copies of one text
    counts = cut_lineage(stored().groupBy("content").agg(F.max("n_tokens").alias("n_tokens")))
    return rows.select("_id", "n_bytes", "content").join(counts, "content", "left").select(F.col("_id").alias(id_col), "n_bytes", "n_tokens")
