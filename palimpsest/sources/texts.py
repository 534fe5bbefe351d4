"""Readers: whole text files as ordered lines, companion lists, n-gram tables, versions, and directory listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.lines import lines


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, wherever Spark's file systems reach."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def read_texts(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """(doc_id, text) of each file, without a byte-order mark; line ends become \\n."""
    found = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True).select(stem(F.col("_metadata.file_path")).alias("doc_id"), "value")
    return found.select("doc_id", F.regexp_replace(F.regexp_replace("value", "^﻿", ""), r"\r\n|\r", "\n").alias("text"))


def read_lines(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    return lines(read_texts(spark, path, glob))


def companions(texts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, idx, entry): entries stand between blank lines; empty ones don't count."""
    entries = F.filter(F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n\n"), strip), lambda x: x != "")
    return texts.select(F.col(id_col).alias("doc_id"), F.posexplode(entries).alias("idx", "entry"))


def ngram_table(texts: DataFrame) -> DataFrame:
    """(n, gram, cnt) of JSON texts {"1": {gram: count}}; no row, no n-gram."""
    parsed = texts.select(F.from_json("text", "map<string,map<string,bigint>>").alias("m"))
    return parsed.select(F.explode("m").alias("n", "grams")).select(F.col("n").cast("int").alias("n"), F.explode("grams").alias("gram", "cnt"))


def read_ngrams(spark: SparkSession, path: str) -> DataFrame:
    """(n, gram, cnt) of a JSON file; a file that isn't there has no n-grams."""
    if not exists(spark, path):
        return spark.createDataFrame([], "n int, gram string, cnt bigint")
    return ngram_table(spark.read.text(path, wholetext=True).withColumnRenamed("value", "text"))


def ngram_json(table: DataFrame) -> DataFrame:
    """One text of a small n-gram table, as `ngram_table` reads it."""
    by_n = table.groupBy("n").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("gram", "cnt")))).alias("grams"))
    return by_n.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("n").cast("string"), "grams")))).alias("text"))


def versions(texts: DataFrame) -> DataFrame:
    find = lambda key: F.regexp_extract("text", key + r'\s*=\s*"([^"]+)"', 1)
    return texts.select(find("__data_version__").alias("data_version"), find("__bundle_version__").alias("bundle_version"))


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(stem, extension, bytes) of a folder's files; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(stem(F.col("path")).alias("stem"), F.regexp_extract("path", r"(\.[^./]*)$", 1).alias("extension"), F.col("length").alias("bytes"))
