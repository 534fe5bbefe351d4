"""The curve, and search against brute force."""

import numpy as np
from pyspark.sql import functions as F

from palimpsest.llm import hilbert_search as search


def test_curve_visits_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3).astype(np.uint64)
    at = search.hilbert_index(cells, 3)
    assert sorted(at.tolist()) == list(range(512))
    assert np.abs(np.diff(cells[np.argsort(at)].astype(int), axis=0)).sum(1).max() == 1


def brute(rows, size, k=10):
    good = [(i, np.array([np.float32(x) for x in [*v, *[0] * (size - len(v))]], float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    ids, points = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for i, v in good:
        if i % 100 == 0:
            d = np.sqrt(np.square(points - v).sum(1))
            out[i] = [(int(ids[j]), d[j]) for j in np.lexsort((ids, d)) if ids[j] != i][:k]
    return out


def run(spark, rows, size):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<float>, rank int").repartition(3)
    got = {}
    for r in search.hilbert_search(df, F.pmod("vec_id", F.lit(100)) == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    want = brute(rows, size)
    assert set(got) == set(want)
    hit = 0
    for q, found in got.items():
        listed = [found[k] for k in sorted(found)]
        assert sorted(found) == list(range(1, len(want[q]) + 1)) and listed == sorted(listed, key=lambda x: (x[1], x[0]))
        hit += len({i for i, _ in listed} & {i for i, _ in want[q]})
    return hit / max(1, sum(map(len, want.values())))


def test_copies_and_odd_vectors(spark):
    points = np.random.default_rng(1).normal(size=(300, 5)).round(3)
    rows = [(i, points[i if i < 300 else 3].tolist()) for i in range(700)]
    odd = [None, [0.0] * 5, [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf"), 1.0, 1.0, 1.0, 1.0], [1.0, 2.0], []]
    rows += [(800 + 100 * k, v) for k, v in enumerate(odd)] + [(None, [1.0] * 5)]
    assert run(spark, rows, 5) == 1


def test_few_and_none(spark):
    assert run(spark, [(0, [1.0, 2.0]), (100, [1.0, 3.0]), (7, [2.0, 2.0])], 2) == 1
    assert run(spark, [(0, None)], 2) == 0


def test_recall(spark):
    """Vectors without any neighbourhood structure, windows of a third of them."""
    points = np.random.default_rng(8).normal(size=(12_000, 64))
    rows = [(i, (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(points)]
    assert run(spark, rows, 64) >= 0.9


def test_recall_of_windows_that_are_a_small_part(spark, monkeypatch):
    """Vectors near a surface of few dimensions: ranges of 64 ranks of 6,000."""
    monkeypatch.setattr(search, "RANGE_ROWS", 64)
    rng = np.random.default_rng(2)
    points = np.tanh(rng.normal(size=(6000, 4)) @ rng.normal(size=(4, 64))) + 1e-3 * rng.normal(size=(6000, 64))
    assert run(spark, [(i, v.tolist()) for i, v in enumerate(points)], 64) >= 0.9


def test_recall_in_a_tight_cluster(spark, monkeypatch):
    monkeypatch.setattr(search, "RANGE_ROWS", 256)
    rng = np.random.default_rng(4)
    points = rng.normal(size=(6000, 64))
    points /= np.linalg.norm(points, axis=1)[:, None]
    centre = points[0].copy()
    for noise in (1e-4, 1e-2):
        # a third of the rows, and all queries, lie in the cluster
        inside = np.arange(6000) % 100 < 34
        near = rng.normal(size=(int(inside.sum()), 64))
        points[inside] = centre + noise * near / np.linalg.norm(near, axis=1)[:, None]
        assert run(spark, [(i, v.tolist()) for i, v in enumerate(points)], 64) >= 0.9
