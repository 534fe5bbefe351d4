"""Exact deduplication by progressive refinement: length, then hash of a prefix, then hash of the whole text.

Each level counts the keys of the rows that the level before left over, in one aggregation with partial sums, and passes
on the keys of two rows or more as a bit table of bounded size. Rows are tested against it where they lie, so no text
moves to be refined, and a whole text is hashed only if another row has its length and its prefix. The table may let
a row through that it shouldn't; the full hash decides. Rows meet their group by that hash, hot groups apart; of the
texts only those of groups of two rows or more move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType
from pyspark.sql.window import Window

from .common import cut, join_groups, marked, marks, numbered, table

#: Characters of the prefix that the second level hashes.
PREFIX_CHARS = 64
ADDED = ["keep_id", "group_size", "kept"]


def _several(rows: DataFrame, key: Column) -> DataFrame:
    """Marks of the keys that two rows or more have."""
    return marks(rows.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "key")


def _refined(docs: DataFrame, text: Column, prefix_chars: int) -> DataFrame:
    """docs with the hash of the whole text, `sha`; null if no other row has the text's length and prefix."""
    length = F.xxhash64(F.octet_length(text))
    prefix = F.xxhash64(F.octet_length(text), F.substring(text, 1, prefix_chars))
    again = marked(docs, length, _several(docs, length), "same").where("same")
    return marked(docs, prefix, _several(again, prefix), "same").withColumn("sha", F.when(F.col("same"), F.sha2(text, 256))).drop("same")


def _marked(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int = PREFIX_CHARS) -> tuple[DataFrame, list[str]]:
    """docs with numbered columns, and keep, size and kept; the numbered columns."""
    plain, (row, text) = numbered(docs, id_col, text_col)
    refined = _refined(plain, F.coalesce(text, F.lit("")), prefix_chars)
    hashed = refined.where("sha IS NOT NULL")
    by_id = hashed.groupBy("sha", F.col(row).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    groups = cut(by_id.groupBy("sha").agg(F.max(F.struct("id", "n")).alias("top"), F.sum("n").alias("size")).where("size > 1"))
    keyed = marked(refined, F.xxhash64("sha"), marks(groups.select(F.xxhash64("sha").alias("key")), "key"), "again").withColumn("again", F.col("again") & F.col("sha").isNotNull())
    alone = keyed.where("NOT again").select("*", F.col(row).alias("keep"), F.lit(1).cast("long").alias("size"), F.lit(True).alias("kept"))
    several = join_groups(keyed.where("again"), groups, "sha", "size", F.col(row))
    one = F.col("size").isNull()
    several = several.withColumn("keep", F.when(one, F.col(row)).otherwise(F.col("top.id"))).withColumn("size", F.coalesce("size", F.lit(1).cast("long")))
    several = several.withColumn("kept", one | F.col(row).eqNullSafe(F.col("keep")))
    columns, out = plain.columns, [*plain.columns, "keep", "size", "kept"]
    if groups.where("top.n > 1").isEmpty():
        return alone.select(*out).unionByName(several.select(*out)), columns
    # rows that share the id that stays and the text: one of them stays
    repeated = several.where(F.col("kept") & (F.col("top.n") > 1))
    several = several.where(~(F.col("kept") & (F.coalesce("top.n", F.lit(1)) > 1)))
    if all(isinstance(f.dataType, AtomicType) for f in plain.schema):  # rows that agree in everything move as one and a count
        variants = repeated.groupBy(*columns, "sha", "keep", "size").agg(F.count(F.lit(1)).alias("n"))
        first = F.row_number().over(Window.partitionBy("sha").orderBy(*columns)) == 1
        repeated = variants.withColumn("first", first).withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).withColumn("kept", F.col("first") & (F.col("k") == 1))
    else:
        repeated = repeated.withColumn("kept", F.row_number().over(Window.partitionBy("sha").orderBy("sha")) == 1)
    return alone.select(*out).unionByName(several.select(*out)).unionByName(repeated.select(*out)), columns


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of docs, with keep_id, group_size and kept added (columns of these names are replaced).

    Of equal texts one row stays, one with the largest id. Null texts equal empty ones; of very long texts only the hash
    moves. A null id never wins against others; where all ids of a group are null, one of its rows stays. Of rows that
    share id and text, too, one stays: the first by the values of all columns, or any if these can't be ordered. An
    empty table gives no rows. Other columns don't matter, whatever their names.
    """
    docs = docs.drop(*ADDED)
    rows, columns = _marked(docs, id_col, text_col)
    return rows.select(*columns, "keep", "size", "kept").toDF(*docs.columns, *ADDED)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # the digest of every row is a column of the contract; it rides along in place of the text
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    return exact_dedup(docs.select("*", digest)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def keep_last(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of equal texts the row with the largest doc_id stays."""
    rows, columns = _marked(docs, "doc_id", "text")
    return rows.where("kept").select(*columns).toDF(*docs.columns)


OP5_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY t) AND row_number() OVER (PARTITION BY t, doc_id) = 1 AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""
