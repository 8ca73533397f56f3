"""From raw documents to packed training sequences.

Every stage works on all documents that the stage before has kept, and is written as Parquet and
read again. Documents that the line classifier rejects go, then those that the quality rules or
their host's record reject, then all but one of each class of near-duplicates; what stays is
packed into sequences.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chromaloom.llm import host_rules, line_crf, near_copies, packing, tokens
from chromaloom.llm.support import own_tables, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Bytes of an Arrow batch. By rows alone ten thousand long texts make one, of which the JVM and a
# Python worker hold several each.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field over their lines predicts good."""
    small_batches(spark)
    model = line_crf.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return line_crf.good_documents(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose source is not rejected."""
    small_batches(spark)
    return host_rules.kept_documents(docs, F.col("source"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts that share 0.8 of their shingles of five words."""
    small_batches(spark)
    return near_copies.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences."""
    small_batches(spark)
    return packing.pack(docs, tokens.default_vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("packing", packed),
]

# the classifier and the tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages one after another; the tables that a stage works on are deleted when it is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        with own_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
