"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm import bpe, exact_dedup, language_id, mixing, ngram_join
from palimpsest.llm.common import shared_folder


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay."""
    return language_id.keep_identified(spark, docs, sf_dir)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.keep_last(spark, docs, sf_dir)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that 5-word n-gram links of similarity 0.8 or more connect, the least doc_id stays."""
    return ngram_join.keep_one_of_each(spark, docs, sf_dir)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.keep_mixed(spark, docs, sf_dir)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token counts and digests of what is left."""
    return bpe.tokenized(spark, docs, sf_dir)


STAGES = [
    ("language_id", identify),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]
#: Stages fit a model and hash with functions that SQL doesn't have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage returns lies in the folder that the cluster shares until the next one is written."""
    folder = posixpath.join(shared_folder(spark), f"corpus-{uuid.uuid4().hex}")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (name, stage) in enumerate(STAGES):
        path = posixpath.join(folder, f"{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            _delete(spark, before)
        before = path
    return docs


def _delete(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)
