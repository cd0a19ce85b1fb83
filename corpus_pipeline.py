"""A corpus from documents to training batches, stage by stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from barloom.llm.common import table
from barloom.llm.entropy_mixing import take_copies
from barloom.llm.exact_dedup import drop_copies
from barloom.llm.length_packing import packed
from barloom.llm.quality_classifier import drop_rejected
from barloom.llm.simhash import drop_near_duplicates
from barloom.work import work_root


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels of `sf_dir`, doesn't reject."""
    return drop_rejected(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of the documents whose texts are equal but for white space."""
    return drop_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints link: four-word shingles, four bits."""
    return drop_near_duplicates(docs, shingle=4, distance=4)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return take_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: bucket, batch and slot."""
    return packed(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

#: The classifier's weights can't be had in SQL; tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again by the next.

    They lie with the intermediate tables, which `discard_work` deletes once the rows of the last
    stage have been written elsewhere.
    """
    folder = f"{work_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
