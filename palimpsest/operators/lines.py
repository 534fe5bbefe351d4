"""Ordered lines of documents, and what windows over them say. Order is a column, never implied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line_no from 0, line); a null text has one empty line."""
    parts = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    found = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(parts).alias("line_no", "line"))
    return found.withColumn("line_no", F.col("line_no").cast("long"))


def in_order(doc: str = "doc_id", *order: str):
    return Window.partitionBy(doc).orderBy(*(order or ("line_no",)))


def so_far(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def fill_forward(value: Column, w) -> Column:
    """The latest value that isn't null, this row's included."""
    return F.last(value, ignorenulls=True).over(so_far(w))


def island(starts: Column, w) -> Column:
    """Number of the run that a row lies in; starts says where a new one begins."""
    return F.sum(F.when(starts, 1).otherwise(0)).over(so_far(w)).cast("long")


def with_page_lines(marked: DataFrame, count_structural: bool = False) -> DataFrame:
    """Lines with page and number, and bare [] filled with them.

    Numbers start again at each page mark; the first content line after it is 2. A bare [] before content has the
    number reached so far.
    """
    w = in_order()
    stripped = F.regexp_replace(F.col("line"), r"(?U)^\s+|\s+$", "")
    is_page = stripped.rlike(r"^<\d+>$")
    structural = F.lit(False) if count_structural else stripped.rlike(r"^\{[^}]+\}$")
    content = (stripped != "") & ~(stripped.rlike("^<[^>]+>$") | structural | stripped.rlike(r"^\[\d+(?:,\d*)?\]$") | stripped.rlike(r"^\[\]$"))
    numbered = (
        marked.withColumn("page", fill_forward(F.when(is_page, F.regexp_extract(stripped, r"\d+", 0).cast("long")), w))
        .withColumn("_run", island(is_page, w))
        .withColumn("_content", content & ~is_page)
    )
    number = 1 + F.sum(F.when(F.col("_content"), 1).otherwise(0)).over(so_far(Window.partitionBy("doc_id", "_run").orderBy("line_no")))
    label = F.concat(F.lit("["), F.coalesce(F.col("page").cast("string"), F.lit("None")), F.lit(","), F.col("number").cast("string"), F.lit("]"))
    filled = F.when(is_page, F.col("line")).otherwise(F.replace(F.col("line"), F.lit("[]"), label))
    return numbered.withColumn("number", number.cast("long")).withColumn("filled", filled).drop("_run", "_content")


def runs(rows: DataFrame, doc: str, order: list[str], key: Column, text: Column) -> DataFrame:
    """Neighbouring rows with one key as one row: run, key, first and last place, rows and joined text."""
    w = in_order(doc, *order)
    marked = rows.withColumn("_key", key).withColumn("_text", text).withColumn("_place", F.row_number().over(w).cast("long"))
    marked = marked.withColumn("_before", F.lag("_key").over(w)).withColumn("run", island(~F.col("_key").eqNullSafe(F.col("_before")) | (F.col("_place") == 1), w))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("_place", "_text"))), lambda x: x["_text"])
    return marked.groupBy(doc, "run").agg(F.first("_key").alias("key"), F.min("_place").alias("first_place"), F.max("_place").alias("last_place"), F.count(F.lit(1)).alias("rows"), F.array_join(pieces, " ").alias("text"))
