"""The corpus pipeline: quality, near duplicates, benchmark leaks, source mixture, token blocks."""

from __future__ import annotations

import os
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickloom.llm import decontam, minhash, mixture, quality, tokens  # noqa: E402
from tickloom.llm.common import table  # noqa: E402
from tickloom.session import shared_root  # noqa: E402


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest doc_id; rows of one doc_id stay together."""
    out = minhash.near_duplicates(docs).where("not kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(out.hint("shuffle_hash"), "doc_id", "left_anti")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def weighted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy that the mixture takes."""
    return mixture.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token blocks written and read back: doc_id, start, n_tokens, ids_crc32."""
    return tokens.tokenized(spark, docs)


STAGES = [("quality", good_quality), ("near_duplicates", one_of_each), ("decontamination", without_benchmark),
          ("mixture", weighted), ("tokens", encoded)]

#: Classifier, components and tokenizer are not SQL; the operators have tests of their own, the stages as a chain have none yet.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    root = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
