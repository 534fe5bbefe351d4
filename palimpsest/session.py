"""A session with the settings that the engine is written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "palimpsest", **settings: str) -> SparkSession:
    """UTC times, adaptive plans; settings add to or replace these. Cluster settings such as the master stay as they are."""
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    return SparkSession.builder.appName(name).config(map=base | settings).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path in the checkpoint folder that the cluster names; only on one machine is there one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp()
    return f"{named}/{name}-{uuid.uuid4().hex}"
