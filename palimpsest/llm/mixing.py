"""Mixing sources to target weights with Sainte-Lague apportionment.

Words of a source lie in shards; a shard's words, in a seeded order of its documents, are cut into blocks of equally
many words. Blocks are given to sources by highest quotients target / (2k + 1), and a source's blocks to its shards by
highest quotients words / (2k + 1), so that each shard has an integer quota. A shard takes as many blocks, from a seeded
place on, each at most twice; most documents are so taken whole or not at all.

What a shard takes is a run of its order, so one row a shard says it all: the order's bounds, and the documents at the
ends that are taken in part. Documents meet that row where they lie; only (source, order, size) of each ever moves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, cut, numbered, table

#: Words in a block, documents in a shard of the whole table (about), and seed.
BLOCK_WORDS, SHARD_DOCS, SEED = 16, 1024, 20
#: Shards of all sources together, at most, unless there are more sources: a row of about 200 bytes each goes to all tasks.
MOST_SHARDS = 1 << 16
WEIGHTS = (5, 2, 1)


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray | None = None) -> np.ndarray:
    """Integer seats by highest quotients votes / (2k + 1), at most `most` each; ties go to earlier rows.

    A common divisor is found by bisection, so the time doesn't follow the number of seats.
    """
    votes = np.asarray(votes, float)
    most = np.full(len(votes), 1 << 60) if most is None else np.asarray(most, np.int64)
    most = np.where(votes > 0, most, 0)
    seats = int(min(seats, most.sum()))
    if seats <= 0:
        return np.zeros(len(votes), np.int64)

    def given(divisor: float) -> np.ndarray:
        return np.minimum(np.floor(votes / divisor + 0.5), most).astype(np.int64)

    low, high = votes[votes > 0].min() / (4.0 * seats + 4), votes.max() * 4
    while given(low).sum() < seats:
        low /= 2
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if given(middle).sum() >= seats:
            low = middle
        else:
            high = middle
    out = given(high)
    rest = seats - int(out.sum())
    while rest > 0:  # quotients that tie at the divisor
        quotient = np.where(out < most, votes / (2 * out + 1), -1.0)
        for i in np.argsort(-quotient, kind="stable")[:rest]:
            if quotient[i] > 0:
                out[i] += 1
                rest -= 1
    return out


def with_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """sizes (source, source_size; one row a source) with the target words of each source, exactly until the last division.

    Weights repeat over sources by code point, null last. Targets share 150 % of all sizes; one stops at twice its
    source's size, and the excess is shared again. Sorted by size for a unit of weight, a source is at its limit if
    what is left of the total, shared over the weights left, would exceed it.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(number, F.lit(len(weights))).cast("int") + 1)
    big = "decimal(38,0)"
    ranked = sizes.withColumn("_weight", weight.cast(big)).withColumn("_size", F.col("source_size").cast(big))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("source_size") / F.col("_weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast(big)
    left_doubled = F.sum("_size").over(everything) * 3 - F.coalesce(F.sum("_size").over(before), none) * 4
    left_weight = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), none)
    marked = ranked.withColumn("_left", left_doubled).withColumn("_left_weight", left_weight).withColumn("_full", F.col("_size") * 4 * F.col("_left_weight") <= F.col("_weight") * F.col("_left"))
    open_left = F.max(F.when(~F.col("_full"), F.struct("_left_weight", "_left"))).over(everything)
    shared = marked.withColumn("_open", open_left)
    target = F.when(F.col("_full"), (F.col("_size") * 2).cast("double")).otherwise((F.col("_weight") * F.col("_open._left")).cast("double") / (F.col("_open._left_weight") * 2).cast("double"))
    return shared.select("source", "source_size", target.alias("target"))


def _seats_of_sources(block_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True)
        if len(rows):
            rows = rows.sort_values("source", na_position="last", ignore_index=True)
            targets = rows["target"].to_numpy(float)
            rows["seats"] = sainte_lague(targets, round(targets.sum() / block_words))
            yield rows

    return run


def _quotas_of_shards(block_words: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shard", ignore_index=True)
        words = rows["words"].to_numpy(np.int64)
        rows["quota"] = sainte_lague(words, int(rows["seats"].iloc[0]), 2 * (-(-words // block_words)))
        return rows[["source_key", "shard", "words", "quota", "source_size", "target"]]

    return run


def _shares(light: DataFrame, shards: int, by_source: DataFrame, block_words: int, seed: int) -> DataFrame:
    """One row for each source_key and shard: how often all of it is taken, and what run of its order once more."""
    shard = F.pmod("order", F.lit(shards)).alias("shard")
    units = light.groupBy("source_key", shard, "order").agg(F.sum("size").alias("unit"))
    by_shard = light.groupBy("source_key", shard).agg(F.sum("size").alias("words"))
    named = by_source.select(F.when(F.col("source_key").startswith("s"), F.expr("substring(source_key, 2)")).alias("source"), "source_size")
    seats = with_targets(named).coalesce(1).mapInPandas(_seats_of_sources(block_words), "source string, source_size bigint, target double, seats bigint")
    seats = seats.withColumn("source_key", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))).drop("source")
    schema = "source_key string, shard bigint, words bigint, quota bigint, source_size bigint, target double"
    quotas = by_shard.join(seats, "source_key").groupBy("source_key").applyInPandas(_quotas_of_shards(block_words), schema)
    place = Window.partitionBy("source_key", "shard").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    placed = units.join(quotas, ["source_key", "shard"]).withColumn("start", F.coalesce(F.sum("unit").over(place), F.lit(0).cast("long")))
    blocks = F.greatest(F.ceil(F.col("words") / block_words), F.lit(1)).cast("long")
    placed = placed.withColumn("end", F.col("start") + F.col("unit")).withColumn("blocks", blocks)
    low = F.pmod(F.xxhash64(F.lit(seed), "source_key", "shard"), F.col("blocks")) * block_words
    high = F.col("low") + F.pmod(F.col("quota"), F.col("blocks")) * block_words
    placed = placed.withColumn("low", low).withColumn("high", high).withColumn("wrapped", F.col("high") - F.col("blocks") * block_words)
    none = F.lit(0).cast("long")
    once = F.greatest(none, F.least("end", "high") - F.greatest("start", "low"))
    again = F.greatest(none, F.least("end", "wrapped") - F.col("start"))
    placed = placed.withColumn("once", once).withColumn("again", again)
    first, second = (F.when((F.col("unit") > 0) & (F.col(c) == F.col("unit")), F.col("order")) for c in ("once", "again"))
    part = F.col("once") + F.col("again")
    ends = F.when((part > 0) & (part < F.col("unit")), F.struct("order", part.alias("part"), "unit"))
    of_shard = [F.first(c).alias(c) for c in ("source_size", "target")]
    passes = F.first(F.floor(F.col("quota") / F.col("blocks")).cast("long")).alias("passes")
    return placed.groupBy("source_key", "shard").agg(passes, *of_shard, F.min(first).alias("from_1"), F.max(first).alias("to_1"), F.min(second).alias("from_2"), F.max(second).alias("to_2"), F.collect_list(ends).alias("ends"))


def _mixed(docs: DataFrame, id_col: str, text_col: str, source_col: str, block_words: int, seed: int) -> tuple[DataFrame, list[str]]:
    """docs with numbered columns, and size, source_size, target and taken; the numbered columns."""
    plain, (row, text, source) = numbered(docs, id_col, text_col, source_col)
    # a null source has a key of its own, so that joins find it
    keyed = plain.withColumn("source_key", F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))).withColumn("order", F.xxhash64(F.lit(seed), F.col(row)))
    sized = keyed.withColumn("size", F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long"))
    light = cut(sized.select("source_key", "order", "size"))
    by_source = cut(light.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")))
    n, sources = by_source.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.count(F.lit(1))).first()
    shards = max(1, min(-(-n // SHARD_DOCS), MOST_SHARDS // max(sources, 1)))
    shares = cut(_shares(light, shards, by_source, block_words, seed))
    if shards * sources <= MOST_SHARDS:
        shares = F.broadcast(shares)
    met = sized.withColumn("shard", F.pmod("order", F.lit(shards))).join(shares, ["source_key", "shard"])
    order, size = F.col("order"), F.col("size")
    inside = F.coalesce(order.between(F.col("from_1"), F.col("to_1")), F.lit(False)) | F.coalesce(order.between(F.col("from_2"), F.col("to_2")), F.lit(False))
    end = F.get(F.filter("ends", lambda x: x["order"] == order), 0)
    at_end = F.floor(size.cast("decimal(38,0)") * end["part"] / end["unit"]).cast("long")
    more = F.coalesce(at_end, F.when(inside, size), F.lit(0).cast("long"))
    return met.select(*plain.columns, "size", "source_size", "target", (size * F.col("passes") + more).alias("taken")), plain.columns


ADDED = ["size", "source_size", "target", "taken"]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """docs with size, source_size, target and taken (words the mix takes of the document, repeats counted).

    Each source's words come within a few blocks a shard of its target, and no document gives more than twice its size.
    Null and empty texts have no words and give none; rows without a source are a source of their own. Rows with one id,
    repeated rows and null ids stand at one place of the order and share what is taken there. A very long text is one
    document, of which a part may be taken. An empty table gives an empty result. Columns of the added names are replaced;
    others stay as they are, whatever their names.

    What is gathered: one row a source for the targets, and the shards of one source for their quotas (MOST_SHARDS at most).
    """
    docs = docs.drop(*ADDED)
    rows, _ = _mixed(docs, id_col, text_col, source_col, block_words, seed)
    return rows.toDF(*docs.columns, *ADDED)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def keep_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document stands as often as the mix takes it, to the nearest whole number (0, 1 or 2)."""
    rows, columns = _mixed(docs, "doc_id", "text", "source", BLOCK_WORDS, SEED)
    times = F.when(F.col("taken") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    found = rows.withColumn("times", times).where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "times")))
    return found.select(*columns).toDF(*docs.columns)
