"""Incremental n-gram counts: each batch of new texts is added to a versioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ngrams import counts, upsert


def current(spark: SparkSession, folder: str, below: int | None = None) -> DataFrame:
    """The table's latest version (below a number, if one is given), or an empty table."""
    try:
        every = spark.read.parquet(folder)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return spark.createDataFrame([], "gram string, cnt bigint")
    every = every if below is None else every.where(F.col("version") < below)
    last = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == F.lit(last)).select("gram", "cnt")


def count_stream(texts: DataFrame, folder: str, checkpoint: str, n: int = 2, text_col: str = "text"):
    """A query that keeps `folder` up to date with a stream of texts. A batch that is run again overwrites its own version."""

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = current(spark, folder, number) if number else spark.createDataFrame([], "gram string, cnt bigint")
        upsert(before, counts(batch, n, text_col)).write.mode("overwrite").parquet(f"{folder}/version={number}")
        # the version before stays, for a batch that is run again; what is older goes
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for old in system.listStatus(path):
            name = old.getPath().getName()
            if name.startswith("version=") and int(name[len("version=") :]) < number - 1:
                system.delete(old.getPath(), True)

    return texts.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
