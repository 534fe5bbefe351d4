"""Quotas against the definition, and a mix's promises."""

import random
import re
from fractions import Fraction

import numpy as np

from palimpsest.llm import mixing


def by_quotients(votes, seats, most):
    out = [0] * len(votes)
    for _ in range(min(seats, sum(m for v, m in zip(votes, most, strict=True) if v > 0))):
        best = max((i for i in range(len(votes)) if votes[i] > 0 and out[i] < most[i]), key=lambda i: (Fraction(votes[i], 2 * out[i] + 1), -i))
        out[best] += 1
    return out


def test_sainte_lague():
    r = random.Random(4)
    for _ in range(200):
        n = r.randint(1, 9)
        votes = [r.choice([0, 1, 2, 5, 10, r.randint(0, 1000)]) for _ in range(n)]
        most = [r.randint(0, 40) for _ in range(n)]
        seats = r.randint(0, 120)
        assert mixing.sainte_lague(np.array(votes), seats, np.array(most)).tolist() == by_quotients(votes, seats, most)


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, full = Fraction(3 * sum(sizes.values()), 2), {}
    while True:
        free = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return {s: float(v) for s, v in {**share, **full}.items()}
        for s in over:
            full[s] = Fraction(2 * sizes[s])
            left -= full[s]


def test_mix(spark):
    r = random.Random(8)
    rows = []
    for i in range(900):
        source = r.choice(["a", "a", "a", "a", "b", "c", "Z", "é", None])
        rows.append((i, " ".join("w" * r.randint(1, 5) for _ in range(r.choice([0, 3, 40, 90]))), source, 1))
    rows += [(1000, None, "a", 1), (1001, "one " * 4000, "b", 1), (1002, "", "empty", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int").repartition(4)
    got = {x.doc_id: x for x in mixing.mix(df).collect()}
    assert set(got) == {x[0] for x in rows}
    sizes, taken = {}, {}
    for i, t, s, _ in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        assert got[i].size == n and 0 <= got[i].taken <= 2 * n
        sizes[s] = sizes.get(s, 0) + n
        taken[s] = taken.get(s, 0) + got[i].taken
    want = targets(sizes)
    for x in got.values():
        assert x.source_size == sizes[x.source] and abs(x.target - want[x.source]) < 1e-6 * max(1, want[x.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * mixing.BLOCK_WORDS
    again = {x.doc_id: x.taken for x in mixing.mix(df.repartition(7)).collect()}
    assert again == {i: x.taken for i, x in got.items()}


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id bigint, text string, source string")).collect() == []


def test_names_and_repeats(spark, clashing):
    rows = [(1, "one two three"), (1, "one two three"), (1, "one two three"), (None, "a b c d"), (None, "a b"), (2, None), (3, "word " * 50), (3, "word " * 50)]
    df = clashing(rows).withColumnRenamed("id", "source")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
    assert all(r.words == "words" and r.shard == "shard" and r.quota == "quota" for r in got)
    stage = mixing.keep_mixed(spark, df, "")
    assert stage.columns == df.columns
    assert all(r.score == "score" and r.size == "size" and r.target == "target" for r in stage.collect())
    assert mixing.keep_mixed(spark, df.where("false"), "").collect() == []


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_DOCS", 20)
    df = spark.createDataFrame([(i, "w " * (i % 37), "ab"[i % 5 == 0]) for i in range(2000)], "doc_id bigint, text string, source string")
    got = mixing.mix(df).groupBy("source").agg({"taken": "sum", "target": "max", "source_size": "max"}).collect()
    for r in got:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 100 * 2 * mixing.BLOCK_WORDS and r["sum(taken)"] <= 2 * r["max(source_size)"]
