"""One registered query for each operator: its production settings over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.byte_bpe import decode, encode
from barloom.llm.centroids import cluster, with_inertia
from barloom.llm.chat_format import format_chats
from barloom.llm.common import table
from barloom.llm.entropy_mixing import mix
from barloom.llm.exact_dedup import decisions
from barloom.llm.filter_audit import filter_audit
from barloom.llm.language_id import language_id
from barloom.llm.length_packing import packed
from barloom.llm.quality_classifier import quality_classifier
from barloom.llm.quality_rules import quality_rules
from barloom.llm.simhash import near_duplicates
from barloom.llm.token_scan import token_counts
from barloom.llm.toxicity import toxicity
from barloom.work import work_root

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


@register
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted documents are those labelled 1 for quality."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality_rules(docs, trusted).drop("text")


@register
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_classifier(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "held_out", "score", "predicted")


@register
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = toxicity(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "held_out", "score", "predicted", "lang_threshold", "flagged")


@register
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id(docs).select("doc_id", "held_out", "lang_pred", "score")


@register
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents arrive first and are the snapshot that screens the other half."""
    return decisions(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@register
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


@register
def op7_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


@register
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register
def op9_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


@register
def op10_token_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents are written to flat files and counted there."""
    folder = f"{work_root(spark)}/flat-{uuid.uuid4().hex}"
    return token_counts(table(spark, sf_dir, "documents"), folder)


@register
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_inertia(*cluster(table(spark, sf_dir, "embeddings")))


@register
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit(docs, table(spark, sf_dir, "labels"))


@register
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text, and of the bytes they decode to."""
    decoded = decode(encode(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
