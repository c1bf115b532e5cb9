"""Corpus pipeline: language ID, SimHash near-dedup, mixing to target weights, best-fit packing.

Each stage gets what its predecessor kept, written as Parquet and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from coverloom.llm import langid, mixing, packing, simhash
from coverloom.llm.common import prepare, table
from coverloom.llm.queries import CAPACITY, WEIGHTS, tokenizer_file
from coverloom.session import scratch_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (null text, no letter) go."""
    prepare(spark)
    return langid.keep_known(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of op6 stays: three-word shingles, fingerprints within three bits."""
    prepare(spark)
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    prepare(spark)
    return mixing.mixed(docs, WEIGHTS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    prepare(spark)
    return packing.pack_documents(docs, tokenizer_file(), CAPACITY)


STAGES = [("language ID", language), ("SimHash near-dedup", dedup), ("mixing to target weights", mix), ("best-fit packing", pack)]

#: Languages, fingerprints and ids of tokenizers can't be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), f"{scratch_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
