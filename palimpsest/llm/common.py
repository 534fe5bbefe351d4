"""Helpers shared by the operators of this subpackage: tables, checkpoints and byte kernels over Arrow strings."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once by the numpy kernels; a longer text is handled alone.
CHUNK_BYTES = 1 << 20
#: A word is a run of bytes other than these.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(text: Column) -> Column:
    """Lower-case A-Z alone; `lower` would change other letters too."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_mod(doc_id: str, mod: int) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(mod))


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the cluster names. Where none is named, one of our own, which only one machine can share."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp())
    return context._jsc.sc().getCheckpointDir().get()


#: Rows in a batch that goes to Python, at most: rows may hold whole texts, and batches lie in memory on both sides.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def cut(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder that the cluster shares and read it from there."""
    shared_folder(df.sparkSession)
    small_batches(df.sparkSession)
    return df.checkpoint()


def numbered(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """df with columns c0, c1, ..., so that no name of it can clash with a private one; and the new names of some."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))), [f"c{df.columns.index(n)}" for n in names]


#: Bits of the number of 64-bit words in a table of marks: at most 262,144 rows of two numbers, whatever the input.
MARK_BITS = 18


def marks(keys: DataFrame, key: str) -> DataFrame:
    """A set of 64-bit keys as a bit table of bounded size, written once and sent to every task. Others may seem to be in it."""
    slot, bit = _slot(F.col(key)), _bit(F.col(key))
    return F.broadcast(cut(keys.groupBy(slot.alias("mark_slot")).agg(F.bit_or(bit).alias("mark_bits"))))


def _slot(key: Column) -> Column:
    return F.shiftrightunsigned(key, 64 - MARK_BITS)


def _bit(key: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63).cast("long")).cast("int"))


def marked(df: DataFrame, key: Column, table: DataFrame, name: str) -> DataFrame:
    """df with a boolean column: False for sure if the key isn't among the marked ones. Rows stay where they are."""
    joined = df.join(table, _slot(key) == F.col("mark_slot"), "left")
    found = F.coalesce(F.col("mark_bits").bitwiseAND(_bit(key)) != 0, F.lit(False))
    return joined.withColumn(name, found).drop("mark_slot", "mark_bits")


#: A group that holds this share of all rows is hot; there are at most as many.
HOT_GROUPS = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: Column) -> DataFrame:
    """rows with the columns of their group, null if none. groups (a written table) has one row a key, and its number of rows.

    At most HOT_GROUPS groups hold a HOT_GROUPS-th of the rows each. These are sent to every task; their rows are then
    dealt by `spread` instead of the key, so that no key brings many rows to one task.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.broadcast(groups.where(F.col(size) * HOT_GROUPS >= total))
    cold = groups.where(F.col(size) * HOT_GROUPS < total)
    columns = [c for c in groups.columns if c != key]
    first = rows.join(hot.select(F.col(key).alias("hot_key"), *(F.col(c).alias(f"hot_{c}") for c in columns)), F.col(key) == F.col("hot_key"), "left")
    dealt = F.when(F.col("hot_key").isNull(), F.concat(F.lit("k"), F.col(key).cast("string"))).otherwise(F.concat(F.lit("r"), F.xxhash64(spread).cast("string")))
    second = cold.select(F.concat(F.lit("k"), F.col(key).cast("string")).alias("cold_key"), *(F.col(c).alias(f"cold_{c}") for c in columns))
    joined = first.withColumn("dealt_key", dealt).join(second, F.col("dealt_key") == F.col("cold_key"), "left")
    return joined.select(*rows.columns, *(F.coalesce(f"hot_{c}", f"cold_{c}").alias(c) for c in columns))


def plain_strings(column: pa.Array) -> pa.Array:
    """The column as one string array with 64-bit offsets, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a `plain_strings` array, and the n + 1 places where its texts begin and end."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[places[0] : places[-1]], places - places[0]


def slices(places: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `most` bytes together, or of one longer text."""
    at, n = 0, len(places) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(places, places[at] + most, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def eights(raw: np.ndarray) -> np.ndarray:
    """At each place, and one behind the last, the next eight bytes as one integer; zeros follow the last byte."""
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    return np.ndarray((len(raw) + 1,), "<u8", padded.data, strides=(1,))


def absorb(h: np.ndarray, eight: np.ndarray) -> np.ndarray:
    """One step of a hash that takes eight bytes at a time; not linear, so that no pattern of letters cancels out."""
    h = (h ^ eight) * np.uint64(0x9FB21C651E98DF25)
    h ^= h >> np.uint64(29)
    return h


def window_hash(raw: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """64-bit hashes of all strings of `size` bytes, 8 at least: of those of eight bytes, then of twice as many each time."""
    if len(raw) < size:
        return np.zeros(0, np.uint64)
    h, w = absorb(np.uint64(0x2545F4914F6CDD1D + seed), eights(raw)[: len(raw) - 7]), 8
    while w < size:
        step = min(w, size - w)
        h, w = absorb(h[:-step] * np.uint64(0x9E3779B97F4A7C15), h[step:]), w + step
    return mix(h)


def string_hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of raw[start:end]."""
    size = end - start
    h = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x2545F4914F6CDD1D)
    wide = eights(raw)
    left, at, rows = size, start, np.arange(len(start))
    for _ in range(LONG_WORD // 8):
        has = left > 0
        if not has.all():
            left, at, rows = left[has], at[has], rows[has]
        if not len(rows):
            break
        h[rows] = absorb(h[rows], wide[at] & _KEEP[np.minimum(left, 8)])
        left, at = left - 8, at + 8
    for i in rows[left > 0].tolist():  # longer ones one by one
        digest = hashlib.blake2b(raw[start[i] : end[i]].tobytes(), digest_size=8).digest()
        h[i] = np.frombuffer(digest, "<u8")[0]
    return mix(h)


#: Strings up to so many bytes are hashed together.
LONG_WORD = 256
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def words_of(raw: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words of the texts: start and end bytes, text number, and 64-bit hash of each."""
    raw = _LOWER[raw]
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    bounds = places[1:-1]
    bounds = bounds[(bounds > 0) & (bounds < len(raw))]
    first[bounds] = inside[bounds]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[bounds - 1] = inside[bounds - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    owner = np.searchsorted(places, start, "right") - 1
    return start, end, owner, string_hash(raw, start, end)
