"""Validation reports: Schematron XML, grammar-validator logs, editor logs, and CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import report_file
from ..operators.diffing import COLUMNS

_SCHEMA = ", ".join(f"{c} string" for c in COLUMNS)


def _row(**known) -> list:
    return [known.get(c, F.lit("")).alias(c) for c in COLUMNS]


def schematron_failures(reports: DataFrame) -> DataFrame:
    """(file, xml) -> one row for each failed assertion with a text."""
    path = "//*[local-name()='failed-assert']"
    text = F.expr(f"xpath(xml, \"{path}/*[local-name()='text']/text()\")")
    found = reports.select("file", F.explode(text).alias("message")).withColumn("message", F.trim("message")).where("message <> ''")
    return found.select(*_row(svrl_file=F.col("file"), status=F.lit("SCH FAIL"), message=F.col("message")))


def grammar_log(log: DataFrame) -> DataFrame:
    """(value) lines `path.xml:LINE:COL: message` -> rows; other lines drop out."""
    pattern = r"^(.*?\.xml):(\d+):(\d+):\s*(.+)$"
    line = F.trim("value")
    part = lambda k: F.regexp_extract(line, pattern, k)
    name = F.replace(F.element_at(F.split(part(1), "/"), -1), F.lit(".xml"), F.lit(".svrl.xml"))
    return log.where(line.rlike(pattern)).select(*_row(svrl_file=name, status=F.lit("RNG FAIL"), line=part(2), message=F.trim(part(4))))


def editor_log(texts: DataFrame) -> DataFrame:
    """(value) whole logs of blocks of `Key: Value` lines, parted by blank lines -> rows. A key's last value counts."""
    blocks = texts.select(F.explode(F.split(F.trim("value"), "\n\n")).alias("block"))
    keys = F.transform(F.regexp_extract_all("block", F.lit(r"(?m)^(.*?):\s*(.*)$"), F.lit(1)), lambda x: F.trim(x))
    values = F.transform(F.regexp_extract_all("block", F.lit(r"(?m)^(.*?):\s*(.*)$"), F.lit(2)), lambda x: F.trim(x))
    parsed = blocks.select(F.arrays_zip(keys.alias("k"), values.alias("v")).alias("pairs"))

    def get(name: str):
        return F.element_at(F.filter("pairs", lambda x: x["k"] == name), -1)["v"]

    def safe(name: str):
        return F.when(F.exists("pairs", lambda x: x["k"] == name), get(name))

    engine = F.lower(F.coalesce(safe("Engine name"), F.lit("")))
    path = F.coalesce(F.nullif(safe("Main validation file"), F.lit("")), safe("System ID"))
    status = F.when(engine.contains("schematron"), "SCH FAIL").when(engine.contains("jing"), "RNG FAIL").otherwise(F.upper(F.coalesce(F.nullif(safe("Severity"), F.lit("")), F.lit("error"))))
    name = F.when(F.endswith(path, F.lit(".svrl.xml")), report_file(path)).otherwise(F.concat(report_file(path), F.lit(".svrl.xml")))
    line = F.coalesce(F.element_at(F.split(safe("Start location"), ":"), 1), F.lit(""))
    return parsed.where(path.isNotNull() & (path != "")).select(*_row(svrl_file=name, status=status, line=line, message=F.coalesce(safe("Description"), F.lit(""))))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=_SCHEMA, multiLine=True, escape='"')


def write_report(rows: DataFrame, path: str) -> None:
    rows.select(*COLUMNS).write.mode("overwrite").csv(path, header=True, escape='"')
