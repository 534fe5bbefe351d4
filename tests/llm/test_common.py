"""Tables of marks, hot groups, hashes."""

import random

import numpy as np
from pyspark.sql import functions as F

from palimpsest.llm import common


def test_marks_hold_what_they_were_given(spark):
    keys = spark.range(500).select(F.xxhash64("id").alias("key"))
    rows = spark.range(5000).withColumn("seen", F.lit("x"))
    found = common.marked(rows, F.xxhash64("id"), common.marks(keys, "key"), "again")
    got = {r.id for r in found.where("again").collect()}
    assert set(range(500)) <= got and len(got) < 600 and found.count() == 5000
    nothing = common.marks(keys.where("false"), "key")
    assert common.marked(rows, F.xxhash64("id"), nothing, "again").where("again").count() == 0
    nulls = spark.createDataFrame([(None,), (1,)], "key bigint")
    assert common.marked(nulls, F.col("key"), common.marks(nulls, "key"), "again").count() == 2


def test_join_groups_meets_hot_and_cold(spark):
    r = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else f"k{r.randrange(4000)}") for i in range(6000)] + [(9000, None), (9001, "none")]
    df = spark.createDataFrame(rows, "id bigint, key string")
    groups = df.where("key IS NOT NULL AND key <> 'none'").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = {x.id: (x.n, x.top) for x in common.join_groups(df, common.cut(groups), "key", "n", F.col("id")).collect()}
    want: dict = {}
    for i, k in rows:
        if k not in (None, "none"):
            want.setdefault(k, []).append(i)
    assert got == {i: (len(want[k]), max(want[k])) if k in want else (None, None) for i, k in rows}


def test_window_hashes():
    raw = np.frombuffer(b"abcabcabcabcabcabcxabcabcabc" * 3, np.uint8)
    for size in (8, 9, 15, 16, 20):
        h = common.window_hash(raw, size)
        names = [raw[i : i + size].tobytes() for i in range(len(raw) - size + 1)]
        assert len(h) == len(names) and len(set(h.tolist())) == len(set(names))
        assert len(set(zip(names, h.tolist()))) == len(set(names))
    assert len(common.window_hash(raw[:5], 8)) == 0


def test_patterned_windows_differ():
    """Strings that a polynomial hash modulo 2**64 confuses."""
    one, other = (np.frombuffer("".join("ab"[(i.bit_count() + k) % 2] for i in range(2048)).encode(), np.uint8) for k in (0, 1))
    assert common.window_hash(one, 2048)[0] != common.window_hash(other, 2048)[0]
