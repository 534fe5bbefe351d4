"""Comparison of two validation reports as multisets, and readers for what reports are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import report_file, report_message, report_status

COLUMNS = ["svrl_file", "status", "line", "test", "role", "message"]


def report_counts(report: DataFrame) -> DataFrame:
    """Rows of a report by file, status and message in one spelling; rows without file or message drop out."""
    keyed = report.select(report_file(F.col("svrl_file")).alias("svrl_file"), report_status(F.col("status"), F.col("message")).alias("status"), report_message(F.col("message")).alias("message"))
    return keyed.where("svrl_file <> '' AND message <> ''").groupBy("svrl_file", "status", "message").agg(F.count(F.lit(1)).alias("cnt"))


def compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """(svrl_file, status, message, left_count, right_count, side): side is left, right or both.

    One aggregation over both, so that no key has to meet its match in a join.
    """
    sides = report_counts(left).withColumn("_left", F.lit(True)).unionByName(report_counts(right).withColumn("_left", F.lit(False)))
    n = sides.groupBy("svrl_file", "status", "message").agg(
        F.coalesce(F.sum(F.when(F.col("_left"), F.col("cnt"))), F.lit(0).cast("long")).alias("left_count"),
        F.coalesce(F.sum(F.when(~F.col("_left"), F.col("cnt"))), F.lit(0).cast("long")).alias("right_count"),
    )
    side = F.when(F.col("right_count") == 0, "left").when(F.col("left_count") == 0, "right").otherwise("both")
    return n.withColumn("side", side)
