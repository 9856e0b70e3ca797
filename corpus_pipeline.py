"""A training-data pipeline over `documents`: classify, remove near copies, redact secrets, mix sources, pack.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; all but the last return the
columns of documents. run() writes each stage's result as Parquet in the shared folder and reads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexstrata.llm import mixing, ngram_join, packing, quality_classifier, secret_scan
from lexstrata.llm.common import Tables


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score of at least 0.3). Null and empty texts are scored by the
    model's bias alone; rows that repeat an id are scored each for itself."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.accepted(docs, labels)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more. The smallest id stays (of rows
    without ids or with the same id, one); texts without words, null ones too, are copies of nothing and stay."""
    return ngram_join.keep_one_of_each(docs, k=5, num=4, den=5)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced. Null and empty texts stay as they are; every row is scanned."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row of a document for every time it is taken, cut where its source's target ends. The null source is
    one; documents without words are not taken; rows that repeat id, source and size share what is taken of them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch, slot and text of every piece of every row; (bucket_len, batch, slot) tells pieces apart, also those of a
    document that is there more than once. Null and empty texts are an empty piece; no rows give none."""
    return packing.pack_texts(docs)


STAGES = [("quality", quality), ("near_copies", near_copies), ("secrets", secrets), ("mix", mix), ("pack", pack)]

#: Neither the classifier nor hashed sets can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = tables.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
