"""Writers: documents one folder each, XML files, reports beside each other, versions, and what is stale goes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sources.texts import stem

DECLARATION = "<?xml version='1.0' encoding='UTF-8'?>\n"
NAMESPACE = "http://www.tei-c.org/ns/1.0"


def tei(header: Column, body: Column, prettier: bool = False) -> Column:
    """A whole XML document; either half may be null. `prettier` ends the tags of lines, paragraphs and breaks with a line end."""
    out = F.concat(F.lit(f'<TEI xmlns="{NAMESPACE}">'), F.coalesce(header, F.lit("")), F.coalesce(F.concat(F.lit("<text>"), body, F.lit("</text>")), F.lit("")), F.lit("</TEI>\n"))
    if prettier:
        out = F.regexp_replace(out, r"(</?[lp][bg]?[^>]*?>)(?!\n)", "$1\n")
        out = F.regexp_replace(out, r"(?m)^ +?([^<])", "$1")
    return F.concat(F.lit(DECLARATION), out)


def write_documents(docs: DataFrame, folder: str, text_col: str, id_col: str = "doc_id", mode: str = "overwrite") -> None:
    """One folder `stem=<id>` for each document with a text, whole, as Spark's text writer lays it out."""
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("stem"), F.col(text_col).alias("value"))
    rows.write.mode(mode).partitionBy("stem").text(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text) of what `write_documents` wrote."""
    found = spark.read.option("basePath", folder).text(folder, wholetext=True)
    return found.select(F.col("stem").cast("string").alias("doc_id"), F.regexp_replace("value", "\n$", "").alias("text"))


def write_with_companions(docs: DataFrame, folder: str, text_col: str = "markup", glosses: str = "glosses", id_col: str = "doc_id") -> None:
    """Texts, and a companion list beside those that have glosses, parted by blank lines."""
    write_documents(docs, folder, text_col, id_col)
    listed = docs.where(F.size(glosses) > 0).withColumn("companion", F.concat(F.array_join(glosses, "\n\n"), F.lit("\n")))
    write_documents(listed, f"{folder}-companions", "companion", id_col)


def write_comparison(compared: DataFrame, folder: str) -> None:
    """What only the left report has, only the right one, and both, as CSV beside each other."""
    for side in ("left", "right", "both"):
        rows = compared.where(F.col("side") == side).drop("side").orderBy("svrl_file", "status", "message")
        rows.write.mode("overwrite").csv(f"{folder}/{side}", header=True, escape='"')


def versioned(text: str, key: str, value: str) -> str | None:
    """A version file's text with one key's value exchanged, or None if that changes nothing."""
    made = re.sub(rf'({re.escape(key)}\s*=\s*")[^"]*(")', lambda m: m[1] + value + m[2], text)
    return made if made != text else None


def tab_separated(found: DataFrame) -> DataFrame:
    """Unfamiliar n-grams as lines: n-gram, code points, count; the most frequent first."""
    return found.orderBy(F.desc("cnt"), "gram").select(F.concat_ws("\t", "gram", "points", F.col("cnt").cast("string")).alias("value"))


def _folders(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def delete_stale(spark: SparkSession, folder: str, sources: DataFrame, id_col: str = "doc_id") -> int:
    """Removes the folders of documents whose source is gone; gives back their number.

    Names of folders alone come to the driver, and are tested against the sources in a join.
    """
    system, path = _folders(spark, folder)
    if not system.exists(path):
        return 0
    names = [s.getPath().getName() for s in system.listStatus(path) if s.isDirectory()]
    have = spark.createDataFrame([(n[len("stem=") :],) for n in names if n.startswith("stem=")], "stem string")
    gone = have.join(sources.select(F.col(id_col).cast("string").alias("stem")), "stem", "left_anti").collect()
    for row in gone:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(path, f"stem={row.stem}"), True)
    return len(gone)


def listed(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Stems of a folder's files in the order of their names."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select(stem(F.col("path")).alias("stem")).orderBy("stem")
