"""The corpus pipeline: toxic documents out, copies out, near copies out, then packing.

Every stage takes what the one before it kept, as a written table, and all but the
last return rows of ``documents`` with all its columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import exact_dedup, packing, simhash, toxicity
from tillroll.llm.common import keep_rows, table
from tillroll.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger does not call toxic; it learns from labels of the given documents."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return keep_rows(docs, exact_dedup.kept_keys(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash (three words, two bits) the document with the smallest id."""
    return keep_rows(docs, simhash.representatives(docs, shingle=3, distance=2))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("SimHash near-dedup", drop_near_copies),
          ("packing", pack_documents)]

#: SQL cannot express the stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
