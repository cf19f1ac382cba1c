"""A training-corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input.

All stages but the last return the columns of documents, whatever these are. Other columns never
decide anything, and may have any names. Null texts count as empty, except that they stay null.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import ensure_checkpoint_dir, table
from linkloom.llm.decontamination import drop_contaminated
from linkloom.llm.ngram_join import near_duplicates
from linkloom.llm.packing import packed_documents
from linkloom.llm.pii import mask_pii
from linkloom.llm.quality_gam import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    It is fitted to the labels of these documents; without any, all are accepted. Each row is
    judged by its text alone: repeated rows alike, null doc_ids as any others, null texts as
    empty ones. Of no documents none are kept.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id.

    A group is what links lead to, over other documents too. Rows with the same doc_id are one
    document, which stays or goes with all of its rows. Documents without a word, null texts
    and null doc_ids match nothing, so they stay. Of no documents none are kept.
    """
    found = near_duplicates(docs)
    gone = found.where(F.col("id") != F.col("group")).select(F.col("id").alias("__gone"))
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a leaked benchmark item.

    Each row is judged by its text alone: repeated rows alike, null doc_ids as any others; empty
    and null texts hold nothing, so they stay. Without items all documents stay.
    """
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in text replaced by its kind and n_chars counted again. No row is added or dropped; null and empty texts stay."""
    return mask_pii(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``pieces``, the places of their tokens in the training sequences. Empty and null texts take a separator; repeated rows a place each."""
    return packed_documents(docs)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", deduplicate), ("benchmark decontamination", decontaminate), ("PII", mask), ("best-fit packing", pack)]

#: Classifiers that are trained on the way can't be expressed in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents. What a stage has written is deleted once the next one has been written; the last one reads what is left."""
    docs = table(spark, sf_dir, "documents")
    root = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            schema = docs.schema
            docs.write.parquet(f"{root}/{k}")
            docs = spark.read.schema(schema).parquet(f"{root}/{k}")
            before = files.Path(f"{root}/{k - 1}")
            before.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(before, True)
    return docs
