"""From raw documents to packed sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import decontamination, line_dedup, near_dedup, packing, toxicity
from tierflow.llm.queries import vocabulary
from tierflow.sinks.scratch import scratch_path

#: No SQL can express the learned scores of the first stage.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from labels of these documents, accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.clean(docs, labels)


def without_repeated_lines(
    spark: SparkSession, docs: DataFrame, sf_dir: str
) -> DataFrame:
    """Documents less the line blocks that an earlier one has; ``n_chars`` follows.

    A document of which nothing but white space is left goes.
    """
    edited = line_dedup.line_dedup(docs)
    changed = F.col("n_deleted") > 0
    emptied = changed & (F.btrim("text", F.lit(" \t\r\n\x0b\f")) == "")
    n_chars = F.when(changed, F.char_length("text")).otherwise(F.col("n_chars"))
    return (
        edited.filter(~F.coalesce(emptied, F.lit(False)))
        .withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
        .select(*docs.columns)
    )


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return near_dedup.representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test items, or few words of them."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean(docs, benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the documents in sequences of 1024 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), 1024, 0)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
