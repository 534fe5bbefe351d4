"""Character n-gram tables: counts, unfamiliar n-grams, residuals, and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import code_points, ngrams, residual


def counts(docs: DataFrame, n: int, text_col: str = "text", *by: str) -> DataFrame:
    """(by..., gram, cnt) over all texts; partial sums run before the shuffle."""
    found = docs.select(*by, F.explode(ngrams(F.coalesce(F.col(text_col), F.lit("")), n)).alias("gram"))
    return found.groupBy(*by, "gram").agg(F.count(F.lit(1)).alias("cnt"))


def unfamiliar(new: DataFrame, reference: DataFrame) -> DataFrame:
    """New n-grams that the reference lacks, with their code points."""
    return new.join(reference.select("gram"), "gram", "left_anti").withColumn("points", code_points(F.col("gram")))


def residuals(new: DataFrame, reference: DataFrame, *by: str) -> DataFrame:
    """For every n-gram of the reference: expected and observed counts of each group, and the standardized residual.

    The result has a row for each n-gram of the reference and group, so it is as large by contract; the total is one row.
    N-grams of the reference that a group lacks count 0 there.
    """
    total = reference.agg(F.sum("cnt").alias("_all"))
    groups = new.groupBy(*by).agg(F.sum("cnt").alias("_new"))
    expected = reference.select("gram", F.col("cnt").alias("ref_cnt")).crossJoin(F.broadcast(total)).crossJoin(groups)
    # a group may have a null key, which meets its counts too
    counted = new.select(F.struct(*by).alias("_by"), F.col("gram").alias("_gram"), "cnt")
    meets = F.struct(*by).eqNullSafe(F.col("_by")) & (F.col("gram") == F.col("_gram"))
    joined = expected.join(counted, meets, "left").withColumn("observed", F.coalesce("cnt", F.lit(0).cast("long")))
    joined = joined.withColumn("expected", F.col("ref_cnt") / F.col("_all") * F.col("_new")).where("expected > 0")
    return joined.select(*by, "gram", "observed", F.col("expected"), residual(F.col("observed"), F.col("expected")).alias("residual"))


def outliers(found: DataFrame, k: int = 10, threshold: float = 100, *by: str) -> DataFrame:
    """Of each group's k largest residuals by size, those above the threshold."""
    order = Window.partitionBy(*by).orderBy(F.desc(F.abs("residual")), "gram")
    return found.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= k) & (F.col("residual") > threshold))


def upsert(reference: DataFrame, new: DataFrame) -> DataFrame:
    """Counts added up; n-grams of either side stay."""
    return reference.select("gram", "cnt").unionByName(new.select("gram", "cnt")).groupBy("gram").agg(F.sum("cnt").alias("cnt"))
