"""Byte-level BPE with a hierarchical-bitmap rank queue.

Pairs of neighbouring tokens wait in one bucket per merge rank. A bitmap of two levels says which buckets hold
something; find-first-set on each level leads to the lowest rank. Buckets hold positions in a linked list of tokens,
least last, and are emptied from their end; entries that a neighbour's merge has made stale are skipped when they come
up. Many pre-tokens share one list and one queue, with no pair across their borders. A pre-token of n bytes takes
O(n log n) steps, however long it is.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import small_batches, table

#: Encoded pre-tokens kept by a worker, and the longest one kept; what is not kept is encoded anew.
CACHE_ENTRIES, CACHE_CHARS = 1 << 17, 48
#: Pairs remembered by a worker.
PAIRS = 1 << 19
#: Texts encoded together, and their characters; a longer text is encoded alone.
BATCH_ROWS, BATCH_CHARS = 256, 1 << 20


class Pairs(dict):
    """Ids that pairs of ids merge to, -1 for none; at most PAIRS of them are remembered."""

    def __init__(self, pieces: list[bytes], ranks: dict[bytes, int]):
        self.pieces, self.ranks = pieces, ranks

    def __missing__(self, pair: tuple[int, int]) -> int:
        if len(self) >= PAIRS:
            self.clear()
        rank = self.ranks.get(self.pieces[pair[0]] + self.pieces[pair[1]], -1)
        self[pair] = rank
        return rank


class RankQueue:
    """Buckets of positions by rank. `top` has a bit for each word of `words` that isn't 0, a word one for each rank in use.

    `ByteBPE.encode_pieces` works on these fields itself where a call would take more time than the step.
    """

    __slots__ = ("buckets", "top", "unsorted", "words")

    def __init__(self, ranks: int):
        self.words = [0] * ((ranks + 63) >> 6)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}
        self.unsorted: set[int] = set()

    def open(self, rank: int, bucket: list[int]) -> None:
        self.buckets[rank] = bucket
        at = rank >> 6
        self.words[at] |= 1 << (rank & 63)
        self.top |= 1 << at

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.open(rank, [position])
        else:
            bucket.append(position)
            self.unsorted.add(rank)

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank and its bucket, which leaves the queue."""
        at = (self.top & -self.top).bit_length() - 1
        bits = self.words[at]
        low = bits & -bits
        self.words[at] = bits ^ low
        if bits == low:
            self.top ^= 1 << at
        rank = (at << 6) + low.bit_length() - 1
        bucket = self.buckets.pop(rank)
        if rank in self.unsorted:
            self.unsorted.discard(rank)
            bucket.sort(reverse=True)
        return rank, bucket


class ByteBPE:
    """Encoder and decoder for one rank file and pre-token pattern; no special tokens."""

    def __init__(self, path: str, pattern: str):
        lines = Path(path).read_bytes().splitlines()
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.size = max(self.ranks.values()) + 1
        self.pieces: list[bytes] = [b""] * self.size
        for piece, rank in self.ranks.items():
            self.pieces[rank] = piece
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.pairs = Pairs(self.pieces, self.ranks)
        self.first = np.array([[self.ranks.get(bytes([i, j]), -1) for j in range(256)] for i in range(256)], np.int32).ravel()
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each pre-token as little-endian unsigned 32-bit integers."""
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        if not len(raw):
            return [b""] * len(pieces)
        ends = np.cumsum([len(p) for p in pieces])
        n = len(raw)
        links = np.arange(1, n + 1)
        links[ends - 1] = -1
        after = links.tolist()
        links = np.arange(-1, n - 1)
        links[ends[:-1][ends[:-1] < n]] = -1
        before = links.tolist()
        ids = self.single[raw].tolist()
        ranks = np.full(n, -1, np.int32)
        ranks[:-1] = self.first[raw[:-1].astype(np.int32) * 256 + raw[1:]]
        ranks[ends - 1] = -1
        places = np.flatnonzero(ranks >= 0)[::-1]
        places = places[np.argsort(ranks[places], kind="stable")]
        used, at = np.unique(ranks[places], return_index=True)
        queue, pairs = RankQueue(self.size), self.pairs
        for rank, bucket in zip(used.tolist(), np.split(places, at[1:]), strict=True) if len(used) else ():
            queue.open(rank, bucket.tolist())
        buckets, unsorted = queue.buckets, queue.unsorted
        while queue.top:
            rank, bucket = queue.pop()
            lower = False
            while bucket:
                i = bucket.pop()
                own, j = ids[i], after[i]
                if own < 0 or j < 0 or pairs[own, ids[j]] != rank:
                    continue  # stale
                ids[i], ids[j] = rank, -1
                after[i] = k = after[j]
                if k >= 0:
                    before[k] = i
                    found = pairs[rank, ids[k]]
                    if found >= 0:
                        held = buckets.get(found)
                        if held is None:
                            queue.open(found, [i])
                        else:
                            held.append(i)
                            unsorted.add(found)
                        lower = found <= rank
                h = before[i]
                if h >= 0:
                    found = pairs[ids[h], rank]
                    if found >= 0:
                        held = buckets.get(found)
                        if held is None:
                            queue.open(found, [h])
                        else:
                            held.append(h)
                            unsorted.add(found)
                        lower = lower or found <= rank
                if lower:  # it comes before what is left here
                    break
            if bucket:
                again = buckets.get(rank)
                if again is None:
                    queue.open(rank, bucket)
                else:
                    bucket.extend(again)
                    buckets[rank] = bucket
                    unsorted.add(rank)
        out = np.array(ids, np.int32)
        live = out >= 0
        upto = np.concatenate([[0], np.cumsum(live)])[np.concatenate([[0], ends])] * 4
        packed, upto = out[live].astype("<u4").tobytes(), upto.tolist()
        return [self.whole(p) or packed[a:b] for p, a, b in zip(pieces, upto, upto[1:])]

    def whole(self, piece: bytes) -> bytes | None:
        """A pre-token that the vocabulary has is one token, whatever its merges."""
        rank = self.ranks.get(piece)
        return None if rank is None else rank.to_bytes(4, "little")

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        known = self.known
        if len(known) >= CACHE_ENTRIES:
            known.clear()
        words = [self.split(t) for t in texts]
        new = list(dict.fromkeys([w for ws in words for w in ws if w not in known]))
        known.update(zip(new, self.encode_pieces([w.encode() for w in new]), strict=True))
        out = [b"".join([known[w] for w in ws]) for ws in words]
        for w in new:
            if len(w) > CACHE_CHARS:
                del known[w]
        return out

    def encode(self, text: str) -> list[int]:
        return memoryview(self.encode_texts([text])[0]).cast("I").tolist()

    def decode(self, ids) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in ids])


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> ByteBPE:
    """One codec for each worker process and rank file."""
    return ByteBPE(path, pattern)


def encoded(bpe: ByteBPE, texts: list[str | None]) -> Iterator[bytes]:
    """Packed ids of each text, in batches of bounded size."""
    batch, chars = [], 0
    for text in texts:
        text = text or ""
        if batch and chars + len(text) > BATCH_CHARS:
            yield from bpe.encode_texts(batch)
            batch, chars = [], 0
        batch.append(text)
        chars += len(text)
    yield from bpe.encode_texts(batch)


def _with(df: DataFrame, source: str, added: dict[str, str], rows) -> DataFrame:
    """df with columns added to it by rows(values of source) -> one list for each added column."""
    kept = [c for c in df.columns if c not in added]
    fields = [df.schema[c] for c in kept]
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType(fields + [f for f in StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in added.items()))])
    arrow = to_arrow_schema(StructType(schema.fields[len(kept) :]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                new = [pa.array(v, f.type) for v, f in zip(rows(part.column(kept.index(source)).to_pylist()), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *added])

    small_batches(df.sparkSession)
    return df.select(*kept).mapInArrow(run, schema)


def bpe_encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """df with the ids of each whole text (null: empty) as array<int>; a column of the name `out` is replaced."""
    return _with(df, text_col, {out: "array<int>"}, lambda texts: [[np.frombuffer(p, "<u4") for p in encoded(codec(path, pattern), texts)]])


def bpe_decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """df with the bytes that each array of ids stands for (null: empty); a column of the name `out` is replaced."""
    return _with(df, ids_col, {out: "binary"}, lambda rows: [[codec(path, pattern).decode(r or ()) for r in rows]])


def bpe_digest(df: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """df with n_tokens, ids_sha256 and decoded_sha256: each text is encoded and its ids decoded again in one pass.

    No shuffle; a row's work and memory follow its own text. Null texts count as empty, which have no ids.
    """

    def rows(texts: list) -> list[list]:
        bpe, n, ids, decoded = codec(path, pattern), [], [], []
        for packed in encoded(bpe, texts):
            n.append(len(packed) // 4)
            ids.append(hashlib.sha256(packed).hexdigest())
            decoded.append(hashlib.sha256(bpe.decode(memoryview(packed).cast("I"))).hexdigest())
        return [n, ids, decoded]

    return _with(df, text_col, {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}, rows)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of docs by the many-language rank file."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_digest(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenized(spark, table(spark, sf_dir, "documents"), sf_dir)
