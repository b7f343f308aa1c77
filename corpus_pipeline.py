"""A corpus pipeline: stages that each take the table the one before wrote.

Null ids, repeated ids and repeated rows are rows like any other in every stage; null and empty texts
and texts without letters go in the first; an empty table gives none; extra columns are carried.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfind.llm import byte_bpe, exact_dedup, language_id, mixing, near_copies
from wayfind.llm.common import id_crc
from wayfind.sources.scratch import discard, materialise, step

#: A document stays if one language has this share of its letters.
LEAST_SHARE = 0.35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose main language has LEAST_SHARE of them, under a model of the rows that carry a language."""
    model = language_id.train(docs.filter(id_crc() % 5 != 0), order_by=F.col("doc_id"))
    return language_id.keep_languages(docs, model, LEAST_SHARE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, white space aside: the longest, then the smallest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group linked by a similarity of 0.8 or more of their five-word shingles: fingerprints linked as in op4 and, for pairs further apart, minimum hashes give the candidates."""
    return near_copies.drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them, with op2's weights and share."""
    return mixing.take_by_source(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the byte-level BPE ids of every document and of what they decode to."""
    return byte_bpe.digest_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language", language), ("exact dedup", exact), ("near dedup", near), ("mixture", mixture), ("tokens", tokens)]

#: Languages, fingerprints, hashes of the mixture and BPE have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again; what a stage leaves behind goes as soon as its result is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with step(spark) as keep:
            docs, path = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
            keep(path)
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
