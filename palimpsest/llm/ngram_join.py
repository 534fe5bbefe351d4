"""Jaccard join of word n-gram sets by vertical partitioning.

The global order of n-grams is cut into fragments. A first pass over the cuts finds n-grams that two documents share;
documents that share too few for any link drop out. The rest order their n-grams by rarity, and those in their prefixes
bring candidates together. Candidates' overlaps are counted in each fragment separately and summed by pair.

Many documents of one prefix n-gram don't pair with each other: all meet one of them, the one with the least share of
n-grams of its own. Where that leaves several components, documents outside the largest one meet all others of their
cluster in blocks of bounded size; there, too, overlaps are counted fragment by fragment and added up, in a matrix that
doesn't leave its task: what leaves it is one link a document at most.

Two documents link when 100 * intersection >= threshold * union.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bytes_of, cut, join_groups, marked, marks, mix, numbered, plain_strings, slices, table, words_of
from .components import components

N, THRESHOLD = 5, 80
#: Fragments of the order in which overlaps are counted separately; a power of 2.
FRAGMENTS = 8
#: Bytes of text whose n-grams meet in one cut of the order, about, and bits of the number of cuts, at least and at most.
#: What leaves the cuts is one row for each n-gram that a document shares, whatever the number of cuts.
CUT_BYTES, LEAST_CUT_BITS, MOST_CUT_BITS = 8 << 20, 3, 15
#: Bytes of text whose n-grams are sorted together.
SLICE_BYTES = 1 << 20
#: Up to so many documents of a prefix n-gram pair with each other at once; of more, each pairs with one of them first.
SMALL = 8
#: Documents and n-grams in a block of a cluster, about, and n-grams of a fragment there.
BLOCK_DOCS, BLOCK_GRAMS, BLOCK_FRAGMENT = 1024, 1 << 21, 2048
#: Bits of an n-gram below those of its cut.
LOW_BITS = 48
_LOW = np.uint64((1 << LOW_BITS) - 1)


def shingles(raw: np.ndarray, places: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of each text: text numbers and 64-bit hashes, sorted by both. Fewer than n words make one n-gram."""
    _, _, owner, words = words_of(raw, places)
    texts = len(places) - 1
    count = np.bincount(owner, minlength=texts)
    h = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for k in range(n):
        h = h * np.uint64(0xA0761D6478BD642F) + words[k : k + len(h)]
    whole = owner[: len(h)] == owner[n - 1 :] if len(h) else np.zeros(0, bool)
    h, own = mix(h[whole]), owner[: len(whole)][whole]
    first = np.concatenate([[0], np.cumsum(count)])
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        s = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            has = count[short] > k
            s[has] = s[has] * np.uint64(0xE7037ED1A0B428DB) + words[first[short[has]] + k]
        h, own = np.concatenate([h, mix(s + count[short].astype(np.uint64))]), np.concatenate([own, short])
    order = np.argsort(h, kind="stable")
    order = order[np.argsort(own[order], kind="stable")]
    h, own = h[order], own[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    return own[new], h[new]


def _each_slice(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for batch in batches:
        raw, places = bytes_of(plain_strings(batch.column(1)))
        for a, b in slices(places, SLICE_BYTES):
            yield (batch.column(0)[a:b], *shingles(raw[places[a] : places[b]], places[a : b + 1] - places[a], n))


def shingle_sets(docs: DataFrame, n: int = N) -> DataFrame:
    """docs (id, text) -> id, n_shingles and two sums that stand for the set."""

    def run(batches):
        for ids, own, h in _each_slice(batches, n):
            size = np.bincount(own, minlength=len(ids))
            start = np.concatenate([[0], np.cumsum(size)])
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (h, mix(h + np.uint64(77)))]
            sums = [(s[start[1:]] - s[start[:-1]]).view(np.int64) for s in sums]
            yield pa.RecordBatch.from_arrays([ids, pa.array(size, pa.int64()), pa.array(sums[0]), pa.array(sums[1])], ["id", "n_shingles", "sum_a", "sum_b"])

    return docs.mapInArrow(run, "id bigint, n_shingles bigint, sum_a bigint, sum_b bigint")


def _repeats(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each n-gram of a slice is another text's too, and one copy of each such n-gram."""
    order = np.argsort(h, kind="stable")
    ordered = h[order]
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    shared = np.empty(len(h), bool)
    shared[order] = same[1:] | same[:-1]
    return shared, ordered[~same[:-1] & same[1:]]


def _deal(cuts: int, n: int):
    """Rows for the cuts. An n-gram that several texts of a slice hold goes once, without them, whatever their number."""
    shift = np.uint64(64 - cuts.bit_length() + 1)

    def run(batches):
        for ids, own, h in _each_slice(batches, n):
            ids = np.asarray(ids, np.int64)
            shared, once = _repeats(h)
            own, h = own[~shared], h[~shared]
            at, once_at = (h >> shift).astype(np.int32), (once >> shift).astype(np.int32)
            rows = {"cut": [], "docs": [], "counts": [], "grams": [], "shared": []}
            for c in range(cuts):
                mine = at == c
                count = np.bincount(own[mine], minlength=len(ids))
                has = np.flatnonzero(count)
                rows["cut"].append(c)
                rows["docs"].append(_planes(ids[has], 8))
                rows["counts"].append(_planes(count[has], 4))
                rows["grams"].append(_planes(h[mine], LOW_BITS // 8))
                rows["shared"].append(_planes(once[once_at == c], LOW_BITS // 8))
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("cut", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()), ("grams", pa.binary()), ("shared", pa.binary())]))

    return run


def _shared_in_slice(cuts: int, n: int):
    """The n-grams that `_deal` sends without their texts, by text."""
    bits = np.uint64(cuts.bit_length() - 1)

    def run(batches):
        for ids, own, h in _each_slice(batches, n):
            shared, _ = _repeats(h)
            grams = (h[shared] >> (np.uint64(64) - bits) << np.uint64(LOW_BITS)) | (h[shared] & _LOW)
            yield pa.RecordBatch.from_arrays([pa.array(np.asarray(ids, np.int64)[own[shared]]), pa.array(grams.view(np.int64))], ["id", "gram"])

    return run


def _planes(values: np.ndarray, size: int) -> bytes:
    """The low `size` bytes of each, all first bytes first: ids of neighbours and small counts then compress well."""
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)[:, :size].T).tobytes() if len(values) else b""


def _values(packed: list[bytes], size: int) -> np.ndarray:
    out = np.zeros((sum(map(len, packed)) // size, 8), np.uint8)
    at = 0
    for p in packed:
        part = np.frombuffer(p, np.uint8).reshape(size, -1).T
        out[at : at + len(part), :size] = part
        at += len(part)
    return out.view("<u8").ravel()


def _shared_grams(key, group):
    """Of one cut: each document's n-grams that another document has too."""
    docs = _values(group.column("docs").to_pylist(), 8).view(np.int64)
    counts = _values(group.column("counts").to_pylist(), 4).view(np.int64)
    grams = _values(group.column("grams").to_pylist(), LOW_BITS // 8)
    owner = np.repeat(docs, counts)
    ordered = np.sort(grams)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    known = np.union1d(_values(group.column("shared").to_pylist(), LOW_BITS // 8), twice)
    hit = known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams if len(known) else np.zeros(len(grams), bool)
    grams = grams[hit] | np.uint64(key[0].as_py() << LOW_BITS)
    return pa.table({"id": pa.array(owner[hit], pa.int64()), "gram": pa.array(grams.view(np.int64), pa.int64())})


def _need(size: Column, threshold: int) -> Column:
    """Overlap that any link of a set of this size has at least: ceil(threshold / 100 * size)."""
    return F.ceil(size * threshold / F.lit(100.0) - 1e-9).cast("long")


def _in_fragment(above: int, k: int):
    return lambda gram: F.shiftright(gram, above) == k


def _linked(pairs: DataFrame, parts: DataFrame, threshold: int) -> DataFrame:
    """pairs (a, b) and whether they link: one overlap for each fragment, summed by pair."""
    left = parts.select(F.col("id").alias("a"), "fragment", F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
    right = parts.select(F.col("id").alias("b"), "fragment", F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))
    counted = pairs.join(left, "a").join(right, ["b", "fragment"])
    partial = counted.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).alias("overlap"))
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    union = F.col("n_a") + F.col("n_b") - F.col("overlap")
    return total.select("a", "b", (F.col("overlap") * 100 >= union * threshold).alias("linked"))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of some rows, and the row of each."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.asarray(lists.value_lengths(), np.int64)
    return np.asarray(lists.flatten(), np.int64), np.repeat(np.arange(len(sizes)), sizes)


def _block_links(threshold: int):
    """Of one pair of blocks: a link from each document that has one to the least id that it reaches in here."""

    def run(key, group):
        few = np.asarray(group.column("few"), bool)
        sides = [group.filter(pa.array(few)), group.filter(pa.array(~few))]
        ids, sizes, component = ([np.asarray(side.column(c), np.int64) for side in sides] for c in ("id", "n", "component"))
        grams, owner = zip(*(_flat(side.column("grams")) for side in sides), strict=True)
        both = np.intersect1d(*grams)
        overlap = np.zeros((len(ids[0]), len(ids[1])), np.float32)
        for at in range(0, len(both), BLOCK_FRAGMENT):  # partial overlaps, summed by pair
            fragment = both[at : at + BLOCK_FRAGMENT]
            held = []
            for g, o, i in zip(grams, owner, ids, strict=True):
                place = np.minimum(np.searchsorted(fragment, g), len(fragment) - 1)
                hit = fragment[place] == g
                m = np.zeros((len(i), len(fragment)), np.float32)
                m[o[hit], place[hit]] = 1
                held.append(m)
            overlap += held[0] @ held[1].T
        union = sizes[0][:, None] + sizes[1] - overlap.astype(np.float64)
        linked = (overlap.astype(np.float64) * 100 >= union * threshold) & (component[0][:, None] != component[1])
        least = [i.copy() for i in ids]
        while linked.any():
            mine = np.minimum(least[0], np.where(linked, least[1], np.iinfo(np.int64).max).min(1))
            theirs = np.minimum(least[1], np.where(linked, mine[:, None], np.iinfo(np.int64).max).min(0))
            if (mine == least[0]).all() and (theirs == least[1]).all():
                break
            least = [mine, theirs]
        a, b = np.concatenate(least), np.concatenate(ids)
        return pa.table({"a": a[a != b], "b": b[a != b]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def _cluster_links(met: DataFrame, shared: DataFrame, threshold: int) -> DataFrame:
    """All links that join two components, among documents (id, centre, component) that meet a centre.

    Who meets one centre, or a centre that meets another one's documents, is in one cluster. Documents of a cluster's
    largest component are linked already; the others meet all of the cluster, block by block.
    """
    clusters = components(met.select("id", "centre"), "id", "centre").withColumnRenamed("component", "cluster")
    members = cut(met.select("id", "component").distinct().join(clusters, "id").join(shared.select("id", "n", "grams"), "id"))
    sizes = members.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size("grams")).alias("grams"))
    blocks = lambda docs, grams: F.ceil(F.greatest(docs / BLOCK_DOCS, grams / BLOCK_GRAMS, F.lit(1.0))).cast("int")
    whole = sizes.groupBy("cluster").agg(F.max(F.struct("docs", "grams", "component")).alias("top"), F.sum("docs").alias("docs"), F.sum("grams").alias("grams"))
    several = whole.where("docs > top.docs")
    dealt = several.select("cluster", F.col("top.component").alias("largest"), blocks(F.col("docs") - F.col("top.docs"), F.col("grams") - F.col("top.grams")).alias("rows"), blocks(F.col("docs"), F.col("grams")).alias("columns"))
    placed = members.join(dealt, "cluster")
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # a key of its own for each pair of blocks, else all of a cluster would stay in the task that its key is dealt to
    pair = F.concat_ws(":", "cluster", "i", "j").alias("pair")
    columns = [pair, "few", "id", "n", "component", "grams"]
    few = placed.where("component <> largest").withColumn("few", F.lit(True)).withColumn("i", block("rows")).withColumn("j", each("columns"))
    every = placed.withColumn("few", F.lit(False)).withColumn("j", block("columns")).withColumn("i", each("rows"))
    return few.select(*columns).unionByName(every.select(*columns)).groupBy("pair").applyInArrow(_block_links(threshold), "a bigint, b bigint")


def ngram_links(docs: DataFrame, sets: DataFrame, n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """(id, component) over links between different sets; sets has one row (id, n_shingles) for each distinct set.

    Links inside a component may be left out, never one that joins two.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cuts = 1 << min(MOST_CUT_BITS, max(LEAST_CUT_BITS, (size // CUT_BYTES).bit_length()))
    dealt = docs.mapInArrow(_deal(cuts, n), "cut int, docs binary, counts binary, grams binary, shared binary")
    schema = "id bigint, gram bigint"
    shared = dealt.groupBy("cut").applyInArrow(_shared_grams, schema).unionByName(docs.mapInArrow(_shared_in_slice(cuts, n), schema))
    by_id = shared.groupBy("id").agg(F.collect_list("gram").alias("grams"))
    kept = cut(by_id.join(sets.select("id", F.col("n_shingles").alias("n")), "id").where(F.size("grams") >= _need(F.col("n"), threshold)))
    grams = kept.select("id", F.explode("grams").alias("gram"))
    frequent = grams.groupBy("gram").agg(F.count(F.lit(1)).cast("int").alias("df")).where("df > 1")
    ranked = grams.join(frequent, "gram").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "gram"))), lambda x: x["gram"]).alias("grams"))
    # n-grams that no other has come first in the order of rarity; they take places of the prefix
    alone = F.col("n") - F.size("grams")
    places = F.col("n") - _need(F.col("n"), threshold) + 1 - alone
    ordered = cut(ranked.join(kept.select("id", "n"), "id").withColumn("places", places.cast("int")).where("places > 0"))
    index = cut(ordered.select("id", "n", (alone / F.col("n")).alias("alone"), F.explode(F.slice("grams", 1, F.col("places"))).alias("gram")))
    above = LOW_BITS + cuts.bit_length() - FRAGMENTS.bit_length()
    parts = ordered.select("id", "n", F.posexplode(F.array(*[F.filter("grams", _in_fragment(above, k)) for k in range(FRAGMENTS)])).alias("fragment", "grams"))
    buckets = cut(index.groupBy("gram").agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("alone", "id", "n")).alias("centre")).where("docs > 1"))
    placed = cut(join_groups(index, buckets, "gram", "docs", F.col("id")).where("docs IS NOT NULL"))
    fits = lambda x, y: (x * 100 >= y * threshold) & (y * 100 >= x * threshold)
    star = placed.where("id <> centre.id").where(fits(F.col("n"), F.col("centre.n"))).select(F.col("centre.id").alias("a"), F.col("id").alias("b"))
    few = placed.where(F.col("docs").between(3, SMALL)).select("gram", "id", "n")
    x, y = few.alias("x"), few.alias("y")
    among = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.id") < F.col("y.id")) & fits(F.col("x.n"), F.col("y.n"))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    links = cut(_linked(star.unionByName(among).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), parts, threshold).where("linked").select("a", "b"))
    found = cut(components(links))

    # n-grams of many documents, which still lie in several components
    many = placed.where(F.col("docs") > SMALL).select("gram", "id", F.col("centre.id").alias("centre"))
    labelled = cut(many.join(found, "id", "left").select("gram", "id", "centre", F.coalesce("component", "id").alias("component")))
    apart = labelled.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("docs")).where("low <> high")
    met = cut(join_groups(labelled, cut(apart.select("gram", "docs")), "gram", "docs", F.col("id")).where("docs IS NOT NULL").select("id", "centre", "component").distinct())
    if met.isEmpty():
        return found
    late = cut(_cluster_links(met, ordered, threshold))
    return found if late.isEmpty() else components(links.unionByName(late))


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """One row for each row of docs: id, n_shingles and component_id (least id reachable by links, itself included).

    Equal sets stand as one row, that of their least id; repeated rows and ties cost nothing more. Null and wordless
    texts have the empty set and link with nothing. Rows that share an id are reachable from each other, whatever their
    texts. Rows of a null id are left out of links and their component is null. An empty table gives no rows. Only the
    two columns are read, so others may have any names. A very long text is cut into words in one task, in memory that
    follows its length; its n-grams then lie in many.

    N-grams are compared by 64-bit hashes, of which overlaps keep 51 bits or more: a pair of texts of 1,000 words each
    counts one n-gram too many with a probability of 1e-9.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    same = ["n_shingles", "sum_a", "sum_b"]
    sets = shingle_sets(texts, n)
    torn = sets.where("id IS NOT NULL").groupBy("id").agg((F.min(F.struct(*same)) != F.max(F.struct(*same))).alias("torn")).where("torn")
    if torn.isEmpty():
        return _joined(texts, sets, n, threshold)
    # rows of one id and several texts: each text stands for itself, and its components are joined by the id
    rows = cut(texts.select("id", F.when(F.col("id").isNotNull(), F.xxhash64("id", F.coalesce("text", F.lit("")))).alias("row"), "text"))
    found = _joined(rows.select(F.col("row").alias("id"), "text"), shingle_sets(rows.select(F.col("row").alias("id"), "text"), n), n, threshold)
    own = cut(rows.select("id", "row").join(found.distinct().withColumnRenamed("id", "row"), "row", "left"))
    low = own.groupBy("id").agg(F.min("component_id").alias("low"))
    merged = components(own.join(low, "id").select("component_id", "low"), "component_id", "low").select(F.col("id").alias("component_id"), "component")
    named = own.join(merged, "component_id", "left").withColumn("component", F.coalesce("component", "component_id"))
    least = named.where("id IS NOT NULL").groupBy("component").agg(F.min("id").alias("least"))
    back = named.where("id IS NOT NULL").join(least, "component").select("id", "n_shingles", F.col("least").alias("component_id"))
    return back.unionByName(sets.where("id IS NULL").select("id", "n_shingles", F.lit(None).cast("long").alias("component_id")))


def _joined(texts: DataFrame, sets: DataFrame, n: int, threshold: int) -> DataFrame:
    """`ngram_join` where rows of one id have one set."""
    same = ["n_shingles", "sum_a", "sum_b"]
    classes = cut(sets.where("n_shingles > 0 AND id IS NOT NULL").groupBy(*same).agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")))
    found = ngram_links(texts.where("id IS NOT NULL"), classes.select(F.col("least").alias("id"), "n_shingles"), n, threshold)
    named = cut(classes.join(found.select(F.col("id").alias("least"), "component"), "least", "left").select(F.struct(*same).alias("set"), F.coalesce("component", "least").alias("component"), "rows"))
    own = sets.select("id", "n_shingles", F.struct(*same).alias("set"))
    return join_groups(own, named, "set", "rows", F.col("id")).select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("id", "doc_id")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the least id of each group of near copies stays, and every document that links with nothing, as do those without an id.

    Texts move only for ids that seem to be among the dropped ones. Of equal rows all stay; the stage before leaves one.
    """
    dropped = cut(ngram_join(docs.select("doc_id", "text")).where("component_id <> id").select(F.col("id").alias("dropped")).distinct())
    plain, (row,) = numbered(docs, "doc_id")
    table = marks(dropped.select(F.xxhash64("dropped").alias("key")), "key")
    seen = marked(plain, F.xxhash64(row), table, "seen")
    left = seen.where("NOT seen").unionByName(seen.where("seen").join(dropped, F.col(row) == F.col("dropped"), "left_anti"))
    return left.drop("seen").toDF(*docs.columns)


OP4_SQL = r"""
WITH RECURSIVE
lowered AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM lowered),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS gram FROM sets),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS overlap FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared WHERE 100 * overlap >= 80 * (n + m - overlap)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(doc_id, other) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, ways.y FROM reached r JOIN ways ON r.other = ways.x)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c.component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) c ON sets.doc_id = c.doc_id
"""
