"""From raw documents to token ids, one written stage after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import byte_bpe, decontaminate, near_dedup, secret_scan
from foliant.llm.common import table, written
from foliant.llm.queries import digests_of_ids, judged_documents
from foliant.scale import small_side


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return judged_documents(spark, docs, sf_dir).where("kept").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Rows that share id and text are one document. An id with several texts stays if one of them does; rows without an
    id stay, one of each text.
    """
    verdicts = near_dedup.near_duplicates(docs).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    gone = verdicts.where(~F.col("kept")).select("doc_id")
    marked = docs.withColumn("_content", F.xxhash64("text"))
    # only rows that may be repeated are compared by text; the texts of the others stay where they are
    counted = marked.groupBy("doc_id", "_content").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = small_side(counted.select(F.col("doc_id").alias("_of"), F.col("_content").alias("_same")), max_rows=1_000_000)
    same = F.col("doc_id").eqNullSafe(F.col("_of")) & (F.col("_content") == F.col("_same"))
    once = marked.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "_content"])
    left = marked.join(repeated, same, "left_anti").unionByName(once)
    return left.join(small_side(gone, max_rows=4_000_000), "doc_id", "left_anti").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where("n_hit > 0")
    gone = found.select(F.col("doc_id").alias("_of"), F.col("content").alias("_content")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_of")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_content"))
    return docs.join(small_side(gone, max_rows=1_000_000), same, "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and ``n_chars`` counted anew."""
    masked = secret_scan.redacted(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of what is left, and the digests of them and of the bytes they decode to.

    The ids are written in between: encoders and decoders in one task would be two Python workers for each core, and
    executors keep all of them.
    """
    return digests_of_ids(written(byte_bpe.encode(docs), "ids"))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", deduplicate),
    ("decontamination", decontaminated),
    ("secret scans", mask_secrets),
    ("byte-level BPE", encode),
]

#: The quality rules and the BPE stage cannot be said in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's rows are written and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
