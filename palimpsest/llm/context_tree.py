"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions, each with its own tree of contexts: the bytes before it, the latest first, to DEPTH.
A node holds the zeros and ones that training texts showed there. Its Krichevsky-Trofimov probability and the product
of its children's weighted probabilities count half each; so a prediction mixes the estimates of all depths, each with
the weight that training gave it. A text ends with a byte that no text has, and contexts before its first byte are
made of that byte.

How it is spread: counts of (DEPTH + 1)-byte strings are summed in each task, then by hash of the whole string, which no
frequent context can crowd, and dealt to shards; a shard holds whole subtrees below two context bytes. The tops of the trees, two levels with at most 256 * 255 + 255 nodes, are finished on
the driver and sent to all. Texts lie in blocks. A block asks the shards for each string it has, once, and scores its
texts by the answers, so that nothing that grows with the corpus is sent to every task. A shard that very many blocks
ask for much stands in several copies, each for some of the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _LOWER, bytes_of, crc_mod, cut, mix, plain_strings, slices, table, words_of

#: Context bytes. Strings of one byte more must fit in 48 bits.
DEPTH = 5
#: Text bytes in a block, about.
BLOCK_BYTES = 32 << 20
END = 255
#: The key of the token that ends a text; words have other keys.
END_TOKEN = 0
#: Strings summed up before they are merged.
MERGE_AT = 2 << 20
#: Bytes that one copy of a shard is asked for, at most about.
ASK_BYTES = 64 << 20
GRAMS, WORDS = 0, 1
_U8 = np.uint64(8)
PARTS = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
ROWS = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def grams(raw: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One 48-bit key for each byte and end of the texts, latest context byte first and the byte itself last; text starts."""
    n = len(places) - 1
    owner = np.repeat(np.arange(n), np.diff(places))
    padded = np.full(len(raw) + (DEPTH + 1) * n, END, np.uint8)
    padded[np.arange(len(raw)) + owner * (DEPTH + 1) + DEPTH] = _LOWER[raw]
    wide = padded.astype(np.uint64)
    m = len(padded) - DEPTH
    keys = np.zeros(max(m, 0), np.uint64)
    for k in range(1, DEPTH + 1):
        keys = keys << _U8 | wide[DEPTH - k : DEPTH - k + m]
    keys = keys << _U8 | wide[DEPTH:]
    starts = places + np.arange(n + 1) * (DEPTH + 1)
    real = np.ones(len(padded), bool)
    real[(starts[:-1, None] + np.arange(DEPTH)).ravel()] = False
    return keys[real[DEPTH:]], places + np.arange(n + 1)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


class Summed:
    """Counts by key, merged now and then."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.waiting = self.settled = 0

    def add(self, keys: np.ndarray) -> None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys.append(keys[first])
        self.counts.append(np.diff(np.concatenate([first, [len(keys)]])))
        self.waiting += len(first)
        if self.waiting > MERGE_AT + self.settled:
            k, c = merged(self.keys, self.counts)
            self.keys, self.counts, self.waiting, self.settled = [k], [c], 0, len(k)

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        return merged(self.keys, self.counts)


def pack(values: np.ndarray, size: int) -> bytes:
    """The low `size` bytes of each, all first bytes first, which compresses well when the values are sorted."""
    whole = np.ascontiguousarray(values)
    return np.ascontiguousarray(whole.view(np.uint8).reshape(len(whole), -1)[:, :size].T).tobytes() if len(whole) else b""


def unpack(packed: bytes, size: int, kind: str = "<u8") -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(size, -1)
    out = np.zeros((planes.shape[1], np.dtype(kind).itemsize), np.uint8)
    out[:, :size] = planes.T
    return out.view(kind).ravel()


def key_bytes(kind: int) -> int:
    return 6 if kind == GRAMS else 8


def shard_of(kind: int, keys: np.ndarray, shards: int) -> np.ndarray:
    """Strings with the same two latest context bytes lie in one shard."""
    return (mix(keys >> np.uint64(32) if kind == GRAMS else keys + np.uint64(1)) % np.uint64(shards)).astype(np.int32)


def _texts(batch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, places = bytes_of(plain_strings(batch.column("text")))
    for a, b in slices(places):
        yield a, b, raw[places[a] : places[b]], places[a : b + 1] - places[a]


def _word_keys(raw: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words and ends of the texts, and the text of each."""
    _, _, owner, h = words_of(raw, places)
    n = len(places) - 1
    return np.concatenate([np.where(h == END_TOKEN, np.uint64(1), h), np.full(n, END_TOKEN, np.uint64)]), np.concatenate([owner, np.arange(n)])


def _dealt(kind: int, keys: np.ndarray, counts: np.ndarray, where: np.ndarray, schema: pa.Schema) -> pa.Table:
    """A row for each place that `where` names."""
    order = np.argsort(where, kind="stable")
    keys, counts, where = keys[order], counts[order], where[order]
    first, _ = _groups(where)
    edges = [*first.tolist(), len(where)]
    bounds = list(zip(edges[:-1], edges[1:], strict=True))
    return pa.table([[kind] * len(bounds), where[first], [pack(keys[a:b], key_bytes(kind)) for a, b in bounds], [pack(counts[a:b], 8) for a, b in bounds]], schema=schema)


def _count(parts: int):
    """Counts of a task's training texts, a row for each kind and part of all strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {GRAMS: Summed(), WORDS: Summed()}
        for batch in batches:
            for _, _, raw, places in _texts(batch):
                sums[GRAMS].add(grams(raw, places)[0])
                sums[WORDS].add(_word_keys(raw, places)[0])
        for kind, summed in sums.items():
            keys, counts = summed.all()
            yield from _dealt(kind, keys, counts, (mix(keys + np.uint64(7)) % np.uint64(parts)).astype(np.int32), PARTS).to_batches()

    return run


def _summed(group, kind: int) -> tuple[np.ndarray, np.ndarray]:
    return merged([unpack(k, key_bytes(kind)) for k in group.column("keys").to_pylist()], [unpack(c, 8, "<i8") for c in group.column("counts").to_pylist()])


def _merge(shards: int):
    """The sums of one part, a row for each shard."""

    def run(key, group):
        kind = key[0].as_py()
        keys, counts = _summed(group, kind)
        return _dealt(kind, keys, counts, shard_of(kind, keys, shards), ROWS)

    return run


def _gather(key, group):
    """One shard's counts."""
    kind = key[0].as_py()
    keys, counts = _summed(group, kind)
    return pa.table({"kind": [kind], "shard": [key[1].as_py()], "keys": [pack(keys, key_bytes(kind))], "counts": [pack(counts, 8)], "distinct": [len(keys)], "total": [int(counts.sum())]}, schema=MODEL)


MODEL = pa.schema([*ROWS, ("distinct", pa.int64()), ("total", pa.int64())])


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0: Stirling's series at x + 8."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    r = 1 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the KT probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted values: where each new one begins, and each row's group."""
    new = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)
    return np.flatnonzero(new), np.cumsum(new) - 1


class Subtrees:
    """All nodes below two context bytes for some sorted strings with counts (0 for strings only asked for)."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys = keys
        self.ones = [(keys >> np.uint64(7 - j) & np.uint64(1)).astype(bool) for j in range(8)]
        self.answer: list[np.ndarray] = []
        self.top: list[tuple[np.ndarray, ...]] = []
        for j in range(8):
            below = inside = None
            levels = []
            for depth in range(DEPTH, 1, -1):
                # strings sorted by context; those of a node may lie apart once its context is cut, so nodes get numbers
                node = (keys >> np.uint64(8 * (DEPTH - depth) + 8) << _U8) | (keys & np.uint64(255)) >> np.uint64(8 - j)
                if depth == DEPTH:
                    first, group = _groups(node)
                    distinct = node[first]
                else:
                    distinct, group = np.unique(node, return_inverse=True)
                    first = None
                zeros = np.bincount(group, counts * ~self.ones[j], len(distinct))
                ones = np.bincount(group, counts * self.ones[j], len(distinct))
                own = log_kt(zeros, ones)
                if below is None:
                    weighted = own
                    stop = np.ones(len(own))
                else:
                    parent = np.zeros(len(below), np.int64)
                    parent[inside] = group
                    children = np.bincount(parent, below, len(distinct))
                    weighted = np.logaddexp(own, children) - np.log(2)
                    stop = np.exp(own - np.log(2) - weighted)
                levels.append((group, zeros, ones, stop))
                below, inside = weighted, group
            p = None
            for group, zeros, ones, stop in levels:  # from the deepest up
                kt = ((np.where(self.ones[j], ones[group], zeros[group]) + 0.5) / (zeros[group] + ones[group] + 1.0)) if len(group) else np.zeros(0)
                p = kt if p is None else stop[group] * kt + (1 - stop[group]) * p
            self.answer.append(p)
            self.top.append((distinct, zeros, ones, below))


def top_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each shard: sums over the nodes at two context bytes, by the latest of these and the decision's node (1 to 255)."""
    for batch in batches:
        for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            trees = Subtrees(unpack(keys, 6), unpack(counts, 8, "<i8"))
            for j, (node, zeros, ones, weighted) in enumerate(trees.top):
                at = (node >> np.uint64(16) << _U8) | (node & np.uint64(255)) + np.uint64(1 << j)
                places, group = np.unique(at, return_inverse=True)
                sums = [np.bincount(group, x, len(places)) for x in (zeros, ones, weighted)]
                yield pa.RecordBatch.from_arrays([pa.array((places >> _U8).astype(np.int32)), pa.array((places & np.uint64(255)).astype(np.int32)), *map(pa.array, sums)], ["byte", "node", "zeros", "ones", "weighted"])


class Tops:
    """The two top levels of the 255 trees: KT counts and weights at no context and at one context byte."""

    def __init__(self, rows: list[tuple]):
        self.zeros, self.ones, below = np.zeros((256, 256)), np.zeros((256, 256)), np.zeros((256, 256))
        for byte, node, zeros, ones, weighted in rows:
            self.zeros[byte, node], self.ones[byte, node], below[byte, node] = zeros, ones, weighted
        own = log_kt(self.zeros, self.ones)
        weighted = np.logaddexp(own, below) - np.log(2)
        self.stop = np.exp(own - np.log(2) - weighted)
        self.root_zeros, self.root_ones = self.zeros.sum(0), self.ones.sum(0)
        own = log_kt(self.root_zeros, self.root_ones)
        self.root_stop = np.exp(own - np.logaddexp(own, weighted.sum(0)))

    def log10(self, trees: Subtrees) -> np.ndarray:
        """log10 of the probability of each string's last byte after its others."""
        total = np.zeros(len(trees.keys))
        byte = (trees.keys >> np.uint64(40)).astype(np.int64)
        for j, p in enumerate(trees.answer):
            node = ((trees.keys & np.uint64(255)) >> np.uint64(8 - j)).astype(np.int64) + (1 << j)
            one = trees.ones[j]
            zeros, ones = self.zeros[byte, node], self.ones[byte, node]
            p = self.stop[byte, node] * (np.where(one, ones, zeros) + 0.5) / (zeros + ones + 1) + (1 - self.stop[byte, node]) * p
            zeros, ones = self.root_zeros[node], self.root_ones[node]
            p = self.root_stop[node] * (np.where(one, ones, zeros) + 0.5) / (zeros + ones + 1) + (1 - self.root_stop[node]) * p
            total += np.log10(p)
        return total


def _ask(shards: int, copies: dict[int, int]):
    """The strings and words of a block, each once, a row for each kind and shard; of a shard with copies, to one of them."""

    def run(key, group):
        block, sums = key[0].as_py(), {GRAMS: Summed(), WORDS: Summed()}
        for _, _, raw, places in _texts(group):
            sums[GRAMS].add(grams(raw, places)[0])
            sums[WORDS].add(_word_keys(raw, places)[0])
        rows = []
        for kind, summed in sums.items():
            keys, _ = summed.all()
            where = shard_of(kind, keys, shards)
            rows += [(block, kind, s, block % copies.get(s, 1) if kind == GRAMS else 0, pack(keys[where == s], key_bytes(kind))) for s in np.unique(where).tolist()]
        return pa.table([list(c) for c in zip(*rows, strict=True)], schema=ASKED) if rows else ASKED.empty_table()

    return run


ASKED = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("shard", pa.int32()), ("copy", pa.int64()), ("keys", pa.binary())])
ANSWERED = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("values", pa.binary())])


def _answer(tops):
    """Log probabilities of strings and counts of words, for all blocks that ask a shard."""

    def run(key, asked, model):
        kind = key[0].as_py()
        size = key_bytes(kind)
        if not asked.num_rows:
            return ANSWERED.empty_table()
        packed = asked.column("keys").to_pylist()
        wanted = [unpack(k, size) for k in packed]
        have = [unpack(k, size) for k in model.column("keys").to_pylist()]
        counts = [unpack(c, 8, "<i8") for c in model.column("counts").to_pylist()]
        keys, counts = merged([*have, *wanted], [*counts, *(np.zeros(len(w), np.int64) for w in wanted)])
        values = tops.value.log10(Subtrees(keys, counts)).astype("<f4") if kind == GRAMS else counts.astype("<i8")
        found = [pack(values[np.searchsorted(keys, w)], values.itemsize) for w in wanted]
        return pa.table([asked.column("block"), pa.array([kind] * len(found), pa.int32()), pa.array(packed, pa.binary()), pa.array(found, pa.binary())], schema=ANSWERED)

    return run


def _look_up(rows, kind: int, value: str) -> tuple[np.ndarray, np.ndarray]:
    mine = [(k, v) for x, k, v in zip(rows.column("kind").to_pylist(), rows.column("keys").to_pylist(), rows.column("values").to_pylist(), strict=True) if x == kind]
    keys = np.concatenate([np.zeros(0, np.uint64), *(unpack(k, key_bytes(kind)) for k, _ in mine)])
    values = np.concatenate([np.zeros(0, value), *(unpack(v, np.dtype(value).itemsize, value) for _, v in mine)])
    order = np.argsort(keys)
    return keys[order], values[order].astype(float)


def _score(total: int, distinct: int):
    """Scores of a block's texts by the answers to it."""

    def run(key, docs, answers):
        out = {"n_bytes": [], "n_tokens": [], "n_known": [], "score": [], "base_score": []}
        if docs.num_rows:
            keys, logs = _look_up(answers, GRAMS, "<f4")
            words, counts = _look_up(answers, WORDS, "<i8")
            base = np.log10((counts + 0.1) / (total + 0.1 * (distinct + 1)))
        for _, _, raw, places in _texts(docs):
            n = len(places) - 1
            own, starts = grams(raw, places)
            sums = np.concatenate([[0.0], np.cumsum(logs[np.searchsorted(keys, own)])])
            out["score"].append(sums[starts[1:]] - sums[starts[:-1]])
            tokens, owner = _word_keys(raw, places)
            at = np.searchsorted(words, tokens)
            out["n_bytes"].append(np.diff(places))
            out["n_tokens"].append(np.bincount(owner, minlength=n))
            out["n_known"].append(np.bincount(owner, counts[at] > 0, n).astype(np.int64))
            out["base_score"].append(np.bincount(owner, base[at], n))
        columns = {k: np.concatenate(v) if v else [] for k, v in out.items()}
        return pa.table({"id": docs.column("id"), "held_out": docs.column("held_out"), **columns, "train_tokens": pa.array([total] * docs.num_rows, pa.int64())}, schema=SCORED)

    return run


SCORED = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("score", pa.float64()), ("base_score", pa.float64()), ("train_tokens", pa.int64())])


def ctw_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each row of docs: id, held_out, n_bytes, n_tokens, n_known, score, base_score and train_tokens.

    Texts whose crc32(id as text) mod 10 is not 0 train the model, the others are held out; all are scored, A-Z in lower
    case. score is the model's log10 probability of the whole text with its end, to single precision for each byte, and
    bits a byte are -score / log10(2) / (n_bytes + 1). base_score is the add-0.1 unigram score of words and end.
    Null and empty texts are an end alone. A null id counts as held out. Repeated rows train and score as often as they
    stand. Without a training text, each byte costs 8 bits. A very long text is scored in the task of its block, in memory
    that follows its length. An empty table gives no rows. Only the two columns are read, so others may have any names.
    """
    spark = docs.sparkSession
    held_out = F.coalesce(crc_mod(id_col, 10) == 0, F.lit(True))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    shards = max(16, 4 * blocks)
    schema = "keys binary, counts binary"
    counted = texts.where("NOT held_out").mapInArrow(_count(shards), f"kind int, part int, {schema}")
    dealt = counted.groupBy("kind", "part").applyInArrow(_merge(shards), f"kind int, shard int, {schema}")
    model = cut(dealt.groupBy("kind", "shard").applyInArrow(_gather, f"kind int, shard int, {schema}, distinct bigint, total bigint"))
    distinct, total = model.where(F.col("kind") == WORDS).agg(F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    rows = model.where(F.col("kind") == GRAMS).mapInArrow(top_rows, "byte int, node int, zeros double, ones double, weighted double")
    tops = rows.groupBy("byte", "node").agg(F.sum("zeros"), F.sum("ones"), F.sum("weighted")).collect()  # at most 256 * 255 rows
    shared = spark.sparkContext.broadcast(Tops([tuple(r) for r in tops]))
    placed = texts.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks))).repartition(blocks, "block")
    # a block asks a shard for its strings at most, and for as many as its share of all strings lets expect
    strings = model.where(F.col("kind") == GRAMS)
    everything = strings.agg(F.sum("total")).first()[0] or 1
    asks = F.least(F.col("distinct"), F.lit(block_bytes) * F.col("total") / F.lit(everything)) * blocks * key_bytes(GRAMS)
    hot = strings.select("shard", F.ceil(asks / ASK_BYTES).cast("long").alias("copies")).where("copies > 1")  # at most 65,536
    copies = dict(map(tuple, hot.collect()))
    asked = placed.groupBy("block").applyInArrow(_ask(shards, copies), "block bigint, kind int, shard int, copy bigint, keys binary")
    several = F.when(F.col("kind") == GRAMS, F.col("copies"))
    copied = model.join(F.broadcast(hot), "shard", "left").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(several, F.lit(1)) - 1))).drop("copies")
    answers = asked.groupBy("kind", "shard", "copy").cogroup(copied.groupBy("kind", "shard", "copy")).applyInArrow(_answer(shared), "block bigint, kind int, keys binary, values binary")
    schema = "id bigint, held_out boolean, n_bytes bigint, n_tokens bigint, n_known bigint, score double, base_score double, train_tokens bigint"
    return placed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(total, distinct), schema)


def op1_ctw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ctw_scores(table(spark, sf_dir, "documents"))
    return scored.select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
