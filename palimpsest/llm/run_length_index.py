"""Removal of long repeated byte strings by a run-length Burrows-Wheeler index.

Equal strings have the same least k-gram hash, so each window of `length` bytes goes, with its neighbours of the same
least hash, to that hash's group; groups of one piece drop out before any text moves. The pieces of some groups make
one text, whose Burrows-Wheeler transform is kept as runs with suffix-array samples at both ends of each run. Only
there are longest common prefixes looked up; between samples the matching statistics of a text fall by one a byte, so
they are streamed over the text from the samples. Windows whose statistics reach `length` occur elsewhere.

Where very many texts share a passage, its pieces are equal but for those at its edges. Equal pieces of a group too large
for an index become one first, with their number, and what is left of the group is indexed. Edges, each with another
neighbourhood, may leave a group that is still too large; hashes of its windows are then counted over all tasks. Such
pieces are cut out where the texts lie, in a second reading.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MARK_BITS, bytes_of, cut, eights, join_groups, marked, marks, mix, plain_strings, slices, table, window_hash

LENGTH, GRAM = 400, 32
#: Windows in a piece, at most; bytes of the pieces in one index, and of a group that shares an index.
PIECE_WINDOWS, INDEX_BYTES, GROUP_BYTES = 4096, 1 << 20, 1 << 19
#: Bytes of pieces that one task indexes, and of texts in a block, about.
TASK_BYTES, BLOCK_BYTES = 4 << 20, 16 << 20


def pieces_of(raw: np.ndarray, places: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows with one least hash: hash, text, first and last window start in the text, and whether one alone may repeat."""
    none = np.zeros(0, np.int64)
    width = length - gram + 1
    sizes = np.diff(places)
    if len(raw) < length or not (sizes >= length).any():
        return np.zeros(0, np.uint64), none, none, none, np.zeros(0, bool)
    h = window_hash(raw, gram)

    def sliding(x: np.ndarray, f) -> np.ndarray:
        w = 1
        while w * 2 <= width:
            x, w = f(x[:-w], x[w:]), w * 2
        return f(x[: len(x) - (width - w)], x[width - w :]) if width > w else x

    least = sliding(h, np.minimum)
    ends = np.repeat(places[1:], sizes)[: len(least)]
    at = np.flatnonzero(np.arange(len(least)) + length <= ends)
    value = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (value[1:] != value[:-1]) | (at[1:] != at[:-1] + 1)
    # long runs are cut; each window stays in one piece
    group_start = at[np.flatnonzero(new)][np.cumsum(new) - 1]
    new |= (at - group_start) % PIECE_WINDOWS == 0
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(at)]]) - 1
    key, low, high = value[first], at[first], at[last]
    # a run alone may hold equal windows only if its hash stands at two places
    most = sliding(np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)]), np.maximum)[: len(h)]
    spots = np.flatnonzero(most == h)
    names, number = np.unique(h[spots], return_inverse=True)
    ordered = np.sort(number.astype(np.int64) * (len(raw) + 1) + spots)
    mine = np.searchsorted(names, key).astype(np.int64) * (len(raw) + 1)
    begin = np.searchsorted(ordered, mine + low)
    second = np.minimum(begin + 1, len(ordered) - 1)
    alone = (begin + 1 < len(ordered)) & (ordered[second] <= mine + high + width - 1)
    owner = np.searchsorted(places, low, "right") - 1
    return key, owner, low - places[owner], high - places[owner], alone


def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The suffix array of pieces that lie one after the other, each with a closing place that is less than any byte.

    text has up to 2**20 bytes; ends holds the closing places. Ranks double the length that they order, by sorting ranks
    and positions packed in one integer; suffixes that stand alone already are left out.
    """
    n = len(text)
    bits = np.uint64(20)
    close = ends[np.searchsorted(ends, np.arange(n))]
    index = np.arange(n, dtype=np.uint64)
    symbol = text.astype(np.uint64) + np.uint64(1)
    symbol[ends] = 0
    # four symbols of nine bits, none from beyond the piece's close
    key = np.zeros(n, np.uint64)
    for k in range(4):
        ahead = np.minimum(np.arange(n) + k, close)
        key = key << np.uint64(9) | symbol[ahead]
    closing = np.zeros(n, bool)
    closing[ends] = True
    order, slots = np.empty(n, np.int64), np.arange(n)
    rank = np.empty(n, np.uint64)
    known = 4
    while True:
        packed = np.sort(key << bits | index)
        found = (packed & np.uint64((1 << 20) - 1)).astype(np.int64)
        values = packed >> bits
        new = np.ones(len(found), bool)
        new[1:] = (values[1:] != values[:-1]) | closing[found[1:]]  # closing places differ from each other
        order[slots] = found
        # a suffix's rank is the first slot of those that it can't be told from yet
        rank[found] = slots[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))].astype(np.uint64)
        alone = new.copy()
        alone[:-1] &= new[1:]
        if alone.all():
            return order
        slots, waiting = slots[~alone], found[~alone]
        index = waiting.astype(np.uint64)
        key = rank[waiting] << bits | rank[np.minimum(waiting + known, close[waiting])]
        known *= 2


class RunLengthIndex:
    """Run ends of the transform of some pieces, with suffix samples and common prefixes at run borders."""

    def __init__(self, pieces: list[bytes]):
        self.ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
        self.text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        order = suffix_order(self.text, self.ends)
        # before the first byte of a piece stands a close, and closes differ: each is a run of its own
        before = self.text[order - 1].astype(np.int16)
        first = np.zeros(len(self.text), bool)
        first[0] = True
        first[self.ends[:-1] + 1] = True
        before[first[order]] = -1
        border = np.flatnonzero((before[1:] != before[:-1]) | (before[1:] < 0))
        #: Samples: the last suffix of a run and the first of the next one.
        self.tail, self.head = order[border], order[border + 1]
        self.runs = len(border) + 1
        self.common = self._common(self.tail, self.head)

    def _common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Longest common prefixes of suffixes, which end with their pieces; eight bytes at a time."""
        most = np.minimum(self.ends[np.searchsorted(self.ends, x)] - x, self.ends[np.searchsorted(self.ends, y)] - y)
        wide, out, rows, at = eights(self.text), np.zeros(len(x), np.int64), np.arange(len(x)), 0
        while len(rows):
            differ = wide[x[rows] + at] ^ wide[y[rows] + at]
            low = differ & (~differ + np.uint64(1))  # the lowest bit that differs lies in the first byte that does
            out[rows] = at + np.where(differ == 0, 8, np.frexp(low.astype(np.float64))[1] - 1 >> 3)
            at += 8
            rows = rows[(differ == 0) & (most[rows] > at)]
        return np.minimum(out, most)

    def matching_statistics(self) -> np.ndarray:
        """For each place, the length of the longest string there that also starts at another place."""
        n = len(self.text)
        out = np.zeros(n, np.int64)
        for sample in (self.head, self.tail):
            reach = np.zeros(n, np.int64)
            np.maximum.at(reach, sample, self.common + sample)
            out = np.maximum(out, np.maximum.accumulate(reach) - np.arange(n))
        return out


def repeated_windows(pieces: list[bytes], length: int = LENGTH, times: list[int] | None = None) -> list[np.ndarray]:
    """For each piece, which of its windows also start elsewhere, in it or in another one; a piece stands `times` times."""
    number: dict[bytes, int] = {}
    copies: list[int] = []
    for p, n in zip(pieces, times or [1] * len(pieces), strict=True):
        k = number.setdefault(p, len(number))
        if k == len(copies):
            copies.append(0)
        copies[k] += n
    distinct = list(number)
    index = RunLengthIndex(distinct)
    reached = index.matching_statistics() >= length
    found = []
    for p, n, end in zip(distinct, copies, index.ends.tolist(), strict=True):
        start = end - len(p)
        found.append(np.ones(len(p) - length + 1, bool) if n > 1 else reached[start : start + len(p) - length + 1])
    return [found[number[p]] for p in pieces]


def ranges(marks: np.ndarray, offset: int, length: int) -> Iterator[tuple[int, int]]:
    """Bytes that marked windows cover, as [from, to)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        yield offset + a, offset + b - 1 + length


def _find(length: int, gram: int):
    schema = pa.schema([("uid", pa.int64()), ("key", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("alone", pa.bool_())])

    def run(batches):
        for batch in batches:
            uid = np.asarray(batch.column("uid"), np.int64)
            raw, places = bytes_of(plain_strings(batch.column("text")))
            for a, b in slices(places):
                key, owner, low, high, alone = pieces_of(raw[places[a] : places[b]], places[a : b + 1] - places[a], length, gram)
                yield pa.RecordBatch.from_arrays([pa.array(uid[a:b][owner], pa.int64()), pa.array(key.view(np.int64)), pa.array(low), pa.array(high), pa.array(alone)], schema=schema)

    return run


def _texts_by_uid(docs) -> dict[int, np.ndarray]:
    raw, places = bytes_of(plain_strings(docs.column("text")))
    return {u: raw[a:b] for u, a, b in zip(docs.column("uid").to_pylist(), places[:-1].tolist(), places[1:].tolist(), strict=True)}


def _extract(length: int):
    """The bytes of a block's pieces."""

    def run(key, docs, wanted):
        texts = _texts_by_uid(docs) if wanted.num_rows else {}
        lows, highs = wanted.column("low").to_pylist(), wanted.column("high").to_pylist()
        data = [texts[u][a : b + length].tobytes() for u, a, b in zip(wanted.column("uid").to_pylist(), lows, highs, strict=True)]
        return pa.table({**{c: wanted.column(c) for c in ("block", "uid", "key", "low", "task")}, "piece": pa.array(data, pa.binary())})

    return run


HOT = pa.schema([("uid", pa.int64()), ("key", pa.int64()), ("name", pa.int64()), ("low", pa.int64()), ("n", pa.int64()), ("size", pa.int64()), ("piece", pa.binary())])


def _mixed_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.asarray(batch.column("key"), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(mix(keys.view(np.uint64)).view(np.int64))], ["mark"])


def _cut_out(length: int, gram: int, bits):
    """Pieces whose key may be a marked one. Of equal ones of a slice, the first has the bytes and the number of all."""

    def run(batches):
        table = bits.value
        for batch in batches:
            uid = np.asarray(batch.column("uid"), np.int64)
            raw, places = bytes_of(plain_strings(batch.column("text")))
            for a, b in slices(places):
                part, begins = raw[places[a] : places[b]], places[a : b + 1] - places[a]
                key, owner, low, high, _ = pieces_of(part, begins, length, gram)
                h = mix(key)
                hit = np.flatnonzero((table[h >> np.uint64(64 - MARK_BITS)] >> (h & np.uint64(63)) & np.uint64(1)) != 0)
                seen: dict[tuple[int, int], int] = {}
                rows: list[list] = []
                for i in hit.tolist():
                    start = int(begins[owner[i]] + low[i])
                    piece = part[start : start + int(high[i] - low[i]) + length].tobytes()
                    name = int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True)
                    first = seen.setdefault((int(key[i]), name), len(rows))
                    rows.append([int(uid[a + owner[i]]), int(key[i : i + 1].view(np.int64)[0]), name, int(low[i]), 0, len(piece), piece if first == len(rows) else None])
                    rows[first][4] += 1
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), HOT.types, strict=True)], schema=HOT)

    return run


RANGE = pa.schema([("block", pa.int64()), ("uid", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _batches(keys: list, data: list[bytes]) -> Iterator[tuple[int, int]]:
    """Whole groups of sorted keys, of INDEX_BYTES together or one larger group."""
    at = 0
    while at < len(data):
        to, size = at, 0
        while to < len(data):
            end, more = to, 0
            while end < len(data) and keys[end] == keys[to]:
                more += len(data[end]) + 1
                end += 1
            if to > at and size + more > INDEX_BYTES:
                break
            to, size = end, size + more
        yield at, to
        at = to


def _index(length: int):
    """Repeated ranges of a task's pieces, whole groups of them in one index."""

    def run(key, group):
        group = group.sort_by("key")
        data, keys = group.column("piece").to_pylist(), group.column("key").to_pylist()
        blocks, uids, lows = group.column("block").to_pylist(), group.column("uid").to_pylist(), group.column("low").to_pylist()
        rows = []
        for at, to in _batches(keys, data):
            for i, marks in zip(range(at, to), repeated_windows(data[at:to], length), strict=True):
                rows += [(blocks[i], uids[i], a, b) for a, b in ranges(marks, lows[i], length)]
        return pa.table([list(c) for c in zip(*rows, strict=True)], schema=RANGE) if rows else RANGE.empty_table()

    return run


PIECE = pa.schema([("key", pa.int64()), ("name", pa.int64()), ("n", pa.int64()), ("from", pa.list_(pa.int64())), ("to", pa.list_(pa.int64()))])


def _piece_row(key: int, name: int, n: int, marks: np.ndarray, length: int) -> tuple:
    found = list(ranges(marks, 0, length))
    return key, name, n, [a for a, _ in found], [b for _, b in found]


def _index_distinct(length: int):
    """Repeated ranges within a task's distinct pieces."""

    def run(task, group):
        group = group.sort_by("key")
        data, keys, names, times = (group.column(c).to_pylist() for c in ("piece", "key", "name", "n"))
        rows = []
        for at, to in _batches(keys, data):
            marks = repeated_windows(data[at:to], length, times[at:to])
            rows += [_piece_row(keys[i], names[i], times[i], m, length) for i, m in zip(range(at, to), marks, strict=True)]
        return pa.table([list(c) for c in zip(*rows, strict=True)], schema=PIECE) if rows else PIECE.empty_table()

    return run


def _windows(length: int):
    """Hashes of each window of some pieces."""
    schema = pa.schema([("key", pa.int64()), ("name", pa.int64()), ("n", pa.int64()), ("at", pa.int32()), ("x", pa.int64()), ("y", pa.int32())])

    def run(batches):
        for batch in batches:
            for key, name, n, piece in zip(*(batch.column(c).to_pylist() for c in ("key", "name", "n", "piece")), strict=True):
                raw = np.frombuffer(piece, np.uint8)
                x, y = window_hash(raw, length, 1).view(np.int64), window_hash(raw, length, 2).astype(np.uint32).view(np.int32)
                m = len(x)
                yield pa.RecordBatch.from_arrays([*(pa.array(np.full(m, v, np.int64)) for v in (key, name, n)), pa.array(np.arange(m, dtype=np.int32)), pa.array(x), pa.array(y)], schema=schema)

    return run


def _ranges_of_windows(length: int):
    def run(batches):
        for batch in batches:
            rows = []
            for key, name, at in zip(*(batch.column(c).to_pylist() for c in ("key", "name", "at")), strict=True):
                marks = np.zeros(max(at) + 1, bool)
                marks[at] = True
                rows.append(_piece_row(key, name, 0, marks, length))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PIECE.types, strict=True)], schema=PIECE)

    return run


def _hot_spans(known: DataFrame, hot: DataFrame, blocks: int, length: int, gram: int) -> DataFrame:
    """Repeated ranges in groups (key) of many pieces: equal ones first become one, with their number.

    A piece's name is a 64-bit hash of it beside its key's 64 bits. A few groups more may be marked; they are right too.
    """
    spark = known.sparkSession
    table = np.zeros(1 << MARK_BITS, np.uint64)
    for slot, bits in marks(hot.mapInArrow(_mixed_keys, "mark bigint"), "mark").collect():  # MARK_BITS bounds it
        table[slot] = np.int64(bits).view(np.uint64)
    shared = spark.sparkContext.broadcast(table)
    pieces = cut(known.select("uid", "text").mapInArrow(_cut_out(length, gram, shared), "uid bigint, key bigint, name bigint, low bigint, n bigint, size bigint, piece binary"))
    counted = cut(pieces.groupBy("key", "name").agg(F.sum("n").alias("n"), F.max("size").alias("size")))
    large = counted.groupBy("key").agg(F.sum(F.col("size") + 1).alias("bytes"))
    wide = marks(large.where(F.col("bytes") > GROUP_BYTES).select(F.xxhash64("key").alias("mark")), "mark")
    sized = marked(pieces.where("piece IS NOT NULL").select("key", "name", "n", "piece"), F.xxhash64("key"), wide, "wide")
    total = large.where(F.col("bytes") <= GROUP_BYTES).agg(F.sum("bytes")).first()[0] or 0
    task = F.pmod(F.xxhash64("key"), F.lit(max(1, -(-total // TASK_BYTES)))).alias("task")
    distinct = sized.where("NOT wide").groupBy("key", "name").agg(F.sum("n").alias("n"), F.first("piece").alias("piece"))
    schema = "key bigint, name bigint, n bigint, `from` array<bigint>, `to` array<bigint>"
    indexed = distinct.select("key", "name", "n", "piece", task).groupBy("task").applyInArrow(_index_distinct(length), schema)
    hashed = sized.where("wide").select("key", "name", "n", "piece").mapInArrow(_windows(length), "key bigint, name bigint, n bigint, at int, x bigint, y int")
    twice = hashed.groupBy("key", "x", "y").agg(F.sum("n").alias("n")).where("n > 1").select("key", "x", "y")
    met = hashed.select("key", "name", "at", "x", "y").join(twice, ["key", "x", "y"], "left_semi")
    windows = met.groupBy("key", "name").agg(F.collect_set("at").alias("at")).mapInArrow(_ranges_of_windows(length), schema)
    found = indexed.unionByName(windows).where(F.size("from") > 0).select("key", "name", F.arrays_zip("from", "to").alias("spans"))
    both = F.struct("key", "name").alias("piece")
    answered = cut(found.join(counted.select("key", "name", "n"), ["key", "name"]).select(both, "n", "spans"))
    placed = join_groups(pieces.select("uid", "low", both), answered, "piece", "n", F.struct("uid", "low")).where("spans IS NOT NULL")
    each = placed.select("uid", "low", F.explode("spans").alias("span"))
    return each.select(F.pmod("uid", F.lit(blocks)).alias("block"), "uid", (F.col("low") + F.col("span.from")).alias("a"), (F.col("low") + F.col("span.to")).alias("b"))


def _remove(length: int):
    """What is left of a block's texts."""

    def run(key, docs, found):
        spans: dict[int, list[tuple[int, int]]] = {}
        for u, a, b in zip(found.column("uid").to_pylist(), found.column("a").to_pylist(), found.column("b").to_pylist(), strict=True):
            spans.setdefault(u, []).append((a, b))
        raw, places = bytes_of(plain_strings(docs.column("text")))
        rows = []
        for i, (row, uid) in enumerate(zip(docs.column("id").to_pylist(), docs.column("uid").to_pylist(), strict=True)):
            text = raw[places[i] : places[i + 1]]
            kept, joined = [], []
            for a, b in sorted(spans.get(uid, ())):
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(b, joined[-1][1])
                else:
                    joined.append([a, b])
            at = 0
            for a, b in joined:
                kept.append(text[at:a])
                at = b
            kept.append(text[at:])
            rest = b"".join(k.tobytes() for k in kept)
            rows.append((row, len(text), len(text) - len(rest), len(joined), hashlib.sha256(rest).hexdigest(), joined))
        return pa.table([list(c) for c in zip(*rows, strict=True)], schema=LEFT) if rows else LEFT.empty_table()

    return run


LEFT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.list_(pa.int64())))])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row for each row of docs: id, n_bytes, n_removed, n_spans, kept_sha256 and spans (maximal removed [from, to)).

    A byte goes if a string of `length` bytes that covers it starts at two places or more of all texts; no string crosses
    texts. Null texts are empty, texts shorter than `length` stay whole, repeated rows repeat their texts. Ids are
    carried only. An empty table gives no rows.

    Memory: an index holds up to INDEX_BYTES of pieces, a task the texts of a block; a very long text is a block alone.
    Other columns don't matter, whatever their names.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0]
    blocks = max(1, -(-(size or 0) // BLOCK_BYTES))
    known = texts.withColumn("uid", F.xxhash64("id", "text"))
    # rows that agree in id and text have one uid and the same spans; each counts as a text
    found = cut(known.select("uid", "text").mapInArrow(_find(length, gram), "uid bigint, key bigint, low bigint, high bigint, alone boolean"))
    window = F.col("high") - F.col("low") + length
    groups = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(window).alias("bytes"), F.max("alone").alias("alone")).where("n > 1 OR alone").select("key", "bytes", "n")
    wanted = cut(join_groups(found, cut(groups), "key", "n", F.struct("uid", "low")).where("n IS NOT NULL").withColumn("block", F.pmod("uid", F.lit(blocks))).select("block", "uid", "key", "low", "high", "bytes"))
    small, large = wanted.agg(F.sum(F.when(F.col("bytes") <= GROUP_BYTES, window)), F.sum(F.when(F.col("bytes") > GROUP_BYTES, window))).first()
    tasks = max(1, -(-(small or 0) // TASK_BYTES))
    placed = known.withColumn("block", F.pmod("uid", F.lit(blocks))).repartition(blocks, "block")
    by_block = placed.groupBy("block")
    few = wanted.where(F.col("bytes") <= GROUP_BYTES).withColumn("task", F.pmod(F.xxhash64("key"), F.lit(tasks)))
    pieces = by_block.cogroup(few.groupBy("block")).applyInArrow(_extract(length), "block bigint, uid bigint, key bigint, low bigint, task bigint, piece binary")
    spans = pieces.groupBy("task").applyInArrow(_index(length), "block bigint, uid bigint, a bigint, b bigint")
    if large:
        hot = wanted.where(F.col("bytes") > GROUP_BYTES).select("key").distinct()
        spans = spans.unionByName(_hot_spans(known, hot, blocks, length, gram))
    return by_block.cogroup(spans.groupBy("block")).applyInArrow(_remove(length), "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<array<bigint>>")


def op2_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents"))
    return left.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP2_SQL = """
WITH t AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, p, md5(b[p + 1:p + 400]) AS k FROM (SELECT r, b, unnest(range(0, octet_length(b) - 399)) AS p FROM t)),
m AS (SELECT r, p FROM w SEMI JOIN (SELECT k FROM w GROUP BY k HAVING count(*) > 1) USING (k)),
j AS (SELECT r, p, sum(s) OVER (PARTITION BY r ORDER BY p) AS run FROM (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 400 THEN 0 ELSE 1 END AS s FROM m)),
spans AS (SELECT r, min(p) AS a, max(p) + 400 AS z FROM j GROUP BY r, run),
pieces AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
kept AS (SELECT t.r, count(*) AS n_spans, sum(z - a) AS gone, string_agg(hex(b[before + 1:a]), '' ORDER BY a) || hex(any_value(b)[max(z) + 1:]) AS h FROM pieces JOIN t USING (r) GROUP BY t.r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(coalesce(unhex(h), b)) AS kept_sha256
FROM t LEFT JOIN kept USING (r)
"""
