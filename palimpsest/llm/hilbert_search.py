"""Approximate nearest neighbours by several shifted Hilbert orderings of projected vectors.

Each ordering projects vectors at random to a few dimensions, shifts the grid, and orders cells along a Hilbert curve.
The grid's lines follow the quantiles of each dimension, so that a dense cluster is cut as finely as its share of vectors.
Spark range-partitions the keys of all orderings; a vector's rank in an ordering follows from its place in its partition
and the partitions' sizes. Ranges of RANGE_ROWS ranks hold the vectors. A query meets its own range and the one on each
side in each ordering; the nearest of all ranges merge, and exact distances rank them. So a query is compared with
3 * RANGE_ROWS * ORDERINGS vectors at most, and copied 3 * ORDERINGS times, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, join_groups, mix, table

ORDERINGS, DIMENSIONS, BITS, SEED = 16, 8, 5, 7
#: Bits below a cell's place on the curve: a hash of ordering and id, so that a cell with very many vectors spreads over
#: ranges, in each ordering otherwise.
TIE_BITS = 22
#: Vectors in a range, and ranges on each side of its own that a query meets.
RANGE_ROWS, REACH = 1536, 1
#: Vectors beyond the nearest k of a range that are ranked exactly too.
SPARE = 8
#: Keys in a partition while they are ranked, about.
SORT_ROWS = 1 << 20
#: Vectors that the grid is fitted on, at most, and the quantiles that are kept of a dimension.
FIT_ROWS, KNOTS = 4096, 257


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell coordinates (uint64, below 2**bits each), by Skilling's transform."""
    x = [c.copy() for c in cells.T]
    n = len(x)
    for b in range(bits - 1, 0, -1):
        q, p = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(n):
            set_bit = (x[i] & q) != 0
            swap = np.where(set_bit, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(set_bit, x[0] ^ p, x[0]) ^ swap
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> np.uint64(b)) & np.uint64(1) != 0, np.uint64((1 << b) - 1), np.uint64(0))
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << np.uint64(1) | ((x[i] ^ turn) >> np.uint64(b)) & np.uint64(1)
    return out


@dataclass
class Grid:
    """Projections, quantiles and shifts of all orderings; of a size that the vectors' dimension sets."""

    projection: np.ndarray
    knots: np.ndarray
    shift: np.ndarray

    @classmethod
    def fit(cls, vectors: list[np.ndarray], orderings: int = ORDERINGS, dimensions: int = DIMENSIONS, seed: int = SEED) -> Grid:
        rng = np.random.default_rng(seed)
        size = int(np.median([len(v) for v in vectors]))
        sample = cut_to(vectors, size)
        m = min(dimensions, size)
        projection = np.stack([np.linalg.qr(rng.normal(size=(size, m)))[0] for _ in range(orderings)])
        at = np.einsum("nd,cdm->cnm", sample, projection)
        return cls(projection, np.quantile(at, np.linspace(0, 1, KNOTS), axis=1), rng.random((orderings, m)))

    def codes(self, ids: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
        """One row an ordering: the curve place of each vector, then its id's hash. The grid knows the first components only."""
        vectors = cut_to(rows, self.projection.shape[1])
        levels = np.linspace(0, 1, KNOTS)
        out = []
        for c, (projection, shift) in enumerate(zip(self.projection, self.shift, strict=True)):
            at = vectors @ projection
            level = np.stack([np.interp(at[:, j], self.knots[:, c, j], levels) for j in range(at.shape[1])], 1)
            cells = (np.clip((level + shift) / 2, 0, 1 - 1e-9) * (1 << BITS)).astype(np.uint64)
            tie = mix(mix(ids.astype(np.int64).view(np.uint64)) + np.uint64(c)) >> np.uint64(64 - TIE_BITS)
            out.append((hilbert_index(cells, BITS) << np.uint64(TIE_BITS) | tie).view(np.int64))
        return np.stack(out)


def cut_to(vectors: list[np.ndarray], size: int) -> np.ndarray:
    """One row a vector: its first `size` components, zeros behind a shorter one."""
    out = np.zeros((len(vectors), size))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v[:size]
    return out


def _vectors(column, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(v, kind) for v in column.to_pylist()]


def _codes(shared, kind: str):
    """Rows (ordering, code, id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                codes = shared.value.codes(np.asarray(batch.column("id"), np.int64), _vectors(batch.column("vector"), kind))
                for ordering, code in enumerate(codes):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), ordering, np.int32)), pa.array(code), batch.column("id")], ["ordering", "code", "id"])

    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted partition: each key's place among those of its ordering."""
    part, seen = TaskContext.get().partitionId(), 0
    last = -1
    for batch in batches:
        ordering = np.asarray(batch.column("ordering"), np.int64)
        first = np.flatnonzero(np.concatenate([[True], ordering[1:] != ordering[:-1]])) if len(ordering) else np.zeros(0, np.int64)
        at = np.arange(len(ordering))
        at -= np.repeat(first, np.diff(np.concatenate([first, [len(ordering)]])))
        if len(ordering):
            if ordering[0] == last:
                at[: first[1] if len(first) > 1 else len(at)] += seen
            last, seen = int(ordering[-1]), int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("ordering"), pa.array(np.full(len(at), part, np.int32)), pa.array(at, pa.int64())], ["id", "ordering", "part", "at"])


def _deal(reach: int):
    """Rows (ordering, range, id, vector) for each ordering, and for each range within reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks = batch.column("ranks")
            row = np.repeat(np.arange(batch.num_rows), np.asarray(ranks.value_lengths(), np.int64))
            flat = ranks.flatten()
            ordering, own = np.asarray(flat.field("ordering"), np.int32), np.asarray(flat.field("rank"), np.int64) // RANGE_ROWS
            for step in range(-reach, reach + 1):
                for at in range(0, len(row), 8192):
                    part = slice(at, at + 8192)
                    columns = [pa.array(ordering[part]), pa.array(own[part] + step), *(batch.column(c).take(pa.array(row[part])) for c in ("id", "vector"))]
                    yield pa.RecordBatch.from_arrays(columns, ["ordering", "range", "id", "vector"])

    return run


class Points:
    """Vectors of any lengths, as a matrix for each length. Where lengths differ, the shorter vector counts as one with zeros behind it."""

    def __init__(self, vectors: list[np.ndarray]):
        by_size: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            by_size.setdefault(len(v), []).append(i)
        self.n = len(vectors)
        self.groups = [(np.array(rows), np.stack([vectors[i] for i in rows]).astype(np.float64)) for rows in by_size.values()]

    def distances(self, v: np.ndarray) -> np.ndarray:
        out, v = np.empty(self.n), v.astype(np.float64)
        for rows, points in self.groups:
            m = min(points.shape[1], len(v))
            out[rows] = np.sqrt(np.square(points[:, :m] - v[:m]).sum(1) + np.square(points[:, m:]).sum(1) + np.square(v[m:]).sum())
        return out


def score(a: np.ndarray, b: np.ndarray) -> float:
    """Euclidean distance, squares added up from the first component to the last."""
    size = max(len(a), len(b))
    difference = cut_to([a], size)[0] - cut_to([b], size)[0]
    return float(np.sqrt(np.square(difference).cumsum()[-1]))


def _nearest(kind: str, k: int):
    """The k nearest vectors of a range for each query that meets it."""

    def run(key, vectors, queries):
        out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if vectors.num_rows and queries.num_rows:
            vectors = vectors.sort_by("id")
            ids, rows = np.asarray(vectors.column("id"), np.int64), _vectors(vectors.column("vector"), kind)
            points = Points(rows)
            for q, v in zip(np.asarray(queries.column("id"), np.int64), _vectors(queries.column("vector"), kind), strict=True):
                distance = points.distances(v)
                # a few more, in whose order the rounding of another order of sums may have a part
                least = np.arange(len(ids)) if len(ids) <= k + SPARE else _first(distance, k + SPARE)
                exact = np.array([score(rows[i], v) for i in least.tolist()])
                best = np.lexsort((ids[least], exact))[:k]
                for column, values in zip(out, (np.full(len(best), q), ids[least][best], exact[best]), strict=True):
                    column.append(values)
        return pa.table([pa.array(np.concatenate(c)) for c in out], names=["query", "id", "score"])

    return run


def _first(distance: np.ndarray, k: int) -> np.ndarray:
    """Places of the k least, ties to the first ones."""
    near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
    return near[np.argsort(distance[near], kind="stable")[:k]]


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no null or non-finite component, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _ranked(points: DataFrame, grid: Grid, kind: str, n: int) -> DataFrame:
    """(id, ranks): a vector's rank in each ordering. To the driver comes a number for each partition and ordering in it."""
    spark = points.sparkSession
    coded = points.mapInArrow(_codes(spark.sparkContext.broadcast(grid), kind), "ordering int, code bigint, id bigint")
    order = ["ordering", "code", "id"]
    parts = max(1, -(-n * ORDERINGS // SORT_ROWS))
    placed = cut(coded.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_places, "id bigint, ordering int, part int, at bigint"))
    sizes = sorted(map(tuple, placed.groupBy("ordering", "part").agg(F.count(F.lit(1))).collect()))
    before, rows = {}, []
    for ordering, part, size in sizes:
        rows.append((ordering, part, before.get(ordering, 0)))
        before[ordering] = before.get(ordering, 0) + size
    offsets = F.broadcast(spark.createDataFrame(rows, "ordering int, part int, before bigint"))
    ranked = placed.join(offsets, ["ordering", "part"]).select("id", F.struct("ordering", (F.col("before") + F.col("at")).alias("rank")).alias("rank"))
    return ranked.groupBy("id").agg(F.collect_list("rank").alias("ranks"))


def hilbert_search(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for each query row: its k nearest other rows by Euclidean distance, ties to smaller ids.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do null ids. Where lengths differ,
    a shorter vector counts as one with zeros behind it. Equal vectors stand as one, with their k + 1 least ids, so a
    vector with very many copies moves as few rows. With fewer than k candidates all are returned. Ids should be unique;
    a repeated id is returned once for each vector of it. Only the two columns and `is_query` are read. An empty table
    gives no rows. Measured recall is in the README.
    """
    spark = vectors.sparkSession
    kind = "<f4" if vectors.schema[vector_col].dataType.elementType.typeName() == "float" else "<f8"
    valid = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), is_query.alias("query")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    valid = valid.withColumn("class", F.concat(F.xxhash64("vector"), F.lit(":"), F.hash("vector"), F.lit(":"), F.size("vector")))
    placed = valid.withColumn("n", F.row_number().over(Window.partitionBy("class").orderBy("id"))).where(F.col("n") <= k + 1)

    def packed(batches):
        for b in batches:
            rows = [np.asarray(v, kind).tobytes() for v in b.column("vector").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("class"), b.column("n"), pa.array(rows, pa.binary())], ["id", "class", "n", "vector"])

    members = cut(placed.select("id", "class", "n", "vector").mapInArrow(packed, "id bigint, class string, n int, vector binary"))
    heads = members.where("n = 1")
    n = heads.count()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sample = heads.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("vector").collect()
    asks = valid.where("query").groupBy("class").agg(F.count(F.lit(1)).alias("asks"))
    grid = Grid.fit([np.frombuffer(r[0], kind) for r in sample])
    ranked = cut(_ranked(heads.select("id", "vector"), grid, kind, n).join(heads.select("id", "class", "vector"), "id").join(asks, "class", "left"))
    schema = "ordering int, range bigint, id bigint, vector binary"
    indexed = ranked.select("id", "ranks", "vector").mapInArrow(_deal(0), schema).groupBy("ordering", "range")
    met = ranked.where("asks IS NOT NULL").select("id", "ranks", "vector").mapInArrow(_deal(REACH), schema).groupBy("ordering", "range")
    near = indexed.cogroup(met).applyInArrow(_nearest(kind, k + 1), "query bigint, id bigint, score double")
    merged = near.groupBy("query", "id").agg(F.min("score").alias("score"))
    best = merged.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("score", "id"))).where(F.col("n") <= k + 1)
    # back from classes to rows
    class_of = ranked.select("id", "class")
    found = best.select("query", "id", "score").join(class_of, "id").select("query", "class", "score").join(members.select("class", F.col("id").alias("vec_id")), "class")
    shortlist = found.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))).where(F.col("n") <= k + 1)
    lists = shortlist.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    by_class = cut(lists.join(ranked.select(F.col("id").alias("query"), "class", "asks"), "query").select("class", "asks", "near"))
    own = join_groups(valid.where("query").select(F.col("id").alias("query_id"), "class"), by_class, "class", "asks", F.col("query_id"))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    each = own.select("query_id", F.posexplode(others).alias("at", "found"))
    return each.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("found.vec_id").alias("vec_id"), F.col("found.score").alias("score"))


def op8_hilbert_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_search(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0)


#: Brute force: the query's rows as long as its windows hold all vectors, up to 2 * RANGE_ROWS of them.
OP8_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.e, c.e), lambda x: (x[1] - x[2]) * (x[1] - x[2])), lambda a, b: a + b)) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d) WHERE rank <= 10
"""
