"""Language identification by segmentation-marginalised unigrams.

Each language has one probability for each piece of a fixed public vocabulary. The probability of a word is the sum,
over every way to cut it into pieces, of the product of their probabilities; the forward algorithm takes that sum.
Piece probabilities are fitted by expectation-maximization, whose expected counts come from forward and backward sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from .common import crc_mod, cut, marked, marks, numbered, small_batches, table

#: Labelled texts of each language that the model is fitted on, at most (in whole words of any length); all rows are scored.
FIT_TEXTS = 256
ROUNDS, SMOOTHING = 3, 0.05
#: Words up to this length are summed together; longer ones one by one, in logarithms.
SHORT = 32
CACHE_WORDS = 1 << 17
UNKNOWN = "und"

_letters = regex.compile(r"\p{L}+").findall


@lru_cache(maxsize=2)
def pieces(path: str) -> dict[str, int]:
    """Numbers of the vocabulary's ordinary pieces without capitals; the last number, one more, is for unknown characters."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[str, int] = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and piece == piece.lower():
            found.setdefault(piece, len(found))
    return found


def words(text: str | None) -> list[str]:
    return _letters(text.lower()) if text else []


class Lattice:
    """Every piece of each of some words of one length."""

    def __init__(self, group: list[str], known: dict[str, int], longest: int):
        self.n = len(group[0]) + 1
        self.edges: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        missing = len(known)
        marked = ["▁" + w for w in group]
        for end in range(1, self.n + 1):
            for start in range(max(0, end - longest), end):
                ids = [known.get(w[start:end], -1) for w in marked]
                if end - start == 1:
                    ids = [missing if i < 0 else i for i in ids]
                ids = np.array(ids)
                rows = np.flatnonzero(ids >= 0)
                if len(rows):
                    self.edges.append((start, end, rows, ids[rows]))
        self.size = len(group)

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Sums over all ways to each place; p has a row for each piece, with one column a language."""
        a = np.zeros((self.n + 1, self.size, p.shape[1]))
        a[0] = 1
        for start, end, rows, ids in self.edges:
            a[end, rows] += a[start, rows] * p[ids]
        return a

    def expected(self, p: np.ndarray, weight: np.ndarray, into: np.ndarray) -> None:
        """Adds each piece's expected count in words that occur `weight` times (a row a word, a column a language)."""
        a = self.forward(p)
        b = np.zeros_like(a)
        b[self.n] = weight / np.maximum(a[self.n], 1e-300)
        for start, end, rows, ids in reversed(self.edges):
            share = b[end, rows] * p[ids]
            np.add.at(into, ids, a[start, rows] * share)
            b[start, rows] += share


def lattices(group: list[str], known: dict[str, int]) -> Iterator[tuple[np.ndarray, Lattice]]:
    longest = max(map(len, known), default=1)
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(group):
        by_length.setdefault(len(w), []).append(i)
    for at in by_length.values():
        for k in range(0, len(at), 4096):
            yield np.array(at[k : k + 4096]), Lattice([group[i] for i in at[k : k + 4096]], known, longest)


class LongWord:
    """Sums over all ways to cut one word of any length, in logarithms; time and memory follow its length."""

    def __init__(self, word: str, known: dict[str, int], longest: int):
        marked, missing = "▁" + word, len(known)
        self.n = len(marked)
        self.into: list[list[tuple[int, int]]] = [[] for _ in range(self.n + 1)]
        for end in range(1, self.n + 1):
            for start in range(max(0, end - longest), end):
                i = known.get(marked[start:end], missing if end - start == 1 else -1)
                if i >= 0:
                    self.into[end].append((start, i))

    def forward(self, log_p: np.ndarray) -> np.ndarray:
        a = np.zeros((self.n + 1, log_p.shape[1]))
        for end in range(1, self.n + 1):
            a[end] = np.logaddexp.reduce([a[start] + log_p[i] for start, i in self.into[end]], 0)
        return a

    def expected(self, log_p: np.ndarray, weight: np.ndarray, into: np.ndarray) -> None:
        a = self.forward(log_p)
        b = np.full_like(a, -np.inf)
        b[self.n] = 0
        for end in range(self.n, 0, -1):
            for start, i in self.into[end]:
                share = log_p[i] + b[end]
                into[i] += weight * np.exp(a[start] + share - a[self.n])
                b[start] = np.logaddexp(b[start], share)


@dataclass
class Model:
    """Piece probabilities of each language; its size is that of the vocabulary times the languages."""

    path: str
    languages: list[str]
    p: np.ndarray

    @property
    def longest(self) -> int:
        return max(map(len, pieces(self.path)), default=1)

    def long_word(self, word: str) -> np.ndarray:
        """Log probability of a word of any length."""
        found = LongWord(word, pieces(self.path), self.longest)
        return found.forward(np.log(self.p))[found.n]

    def score_words(self, group: list[str]) -> np.ndarray:
        """Log probabilities of words up to SHORT."""
        out = np.zeros((len(group), len(self.languages)))
        for at, lattice in lattices(group, pieces(self.path)):
            out[at] = np.log(np.maximum(lattice.forward(self.p)[lattice.n], 1e-300))
        return out

    def expected(self, group: list[str], weight: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces in words that occur `weight` times (a row a word, a column a language)."""
        known, counts = pieces(self.path), np.zeros_like(self.p)
        short = [i for i, w in enumerate(group) if len(w) <= SHORT]
        for at, lattice in lattices([group[i] for i in short], known):
            lattice.expected(self.p, weight[np.array(short)[at]], counts)
        for i, w in enumerate(group):
            if len(w) > SHORT:
                LongWord(w, known, self.longest).expected(np.log(self.p), weight[i], counts)
        return counts


def fit(counts: DataFrame, path: str) -> Model:
    """A model of the words (lang, word, n) of each language.

    Words stay in their tasks. To the driver come the languages and, in each round, one number for each piece of the
    vocabulary and language.
    """
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
    size = len(pieces(path)) + 1
    model = Model(path, languages, np.full((size, len(languages)), 1 / size))
    number = {x: i for i, x in enumerate(languages)}
    for _ in range(ROUNDS if languages else 0):
        shared = counts.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(shared.value.p)
            for batch in batches:
                group, weight = batch.column("word").to_pylist(), np.zeros((batch.num_rows, len(number)))
                weight[np.arange(len(group)), [number[x] for x in batch.column("lang").to_pylist()]] = np.asarray(batch.column("n"), float)
                total += shared.value.expected(group, weight)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(lang.astype(np.int32)), pa.array(total[piece, lang])], ["piece", "lang", "value"])

        sums = counts.mapInArrow(run, "piece int, lang int, value double").groupBy("piece", "lang").agg(F.sum("value"))
        p = np.full((size, len(languages)), SMOOTHING)
        for piece, lang, value in sums.collect():
            p[piece, lang] += value
        model = Model(path, languages, p / p.sum(0))
        shared.destroy()
    return model


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = FIT_TEXTS) -> DataFrame:
    """At most about `per_language` texts of each label, those whose ids hash lowest within 16 shares of the label."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL")
    order = F.xxhash64("id")
    share = Window.partitionBy("lang", F.pmod(order, F.lit(16))).orderBy(order, "id")
    chosen = cut(rows.select("id", "lang").withColumn("n", F.row_number().over(share)).where(F.col("n") <= -(-per_language // 16)).select("id").distinct())
    # texts move only for ids that seem to be chosen
    seen = marked(rows, order, marks(chosen.select(order.alias("key")), "key"), "seen").where("seen")
    return seen.join(chosen, "id", "left_semi").select("lang", "text")


def count_words(sample: DataFrame) -> DataFrame:
    """(lang, word, n): all words of the sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = words(text)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.string())], ["lang", "word"])

    return cut(sample.mapInArrow(count, "lang string, word string").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))


def _predicted(docs: DataFrame, model: Model, text_col: str) -> tuple[DataFrame, list[str]]:
    """docs with numbered columns, and lang_pred and score; the numbered columns."""
    plain, (text,) = numbered(docs, text_col)
    at, names = plain.columns.index(text), [*plain.columns, "lang_pred", "score"]
    schema = StructType.fromJson(plain.schema.jsonValue()).add("lang_pred", "string").add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cache: dict[str, int] = {}
    rows: list[np.ndarray] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                found = [words(t) for t in batch.column(at).to_pylist()]
                if len(cache) > CACHE_WORDS:
                    cache.clear()
                    rows.clear()
                new = list(dict.fromkeys(w for ws in found for w in ws if w not in cache and len(w) <= SHORT))
                if new:
                    have = rows[0] if rows else np.zeros((0, len(model.languages)))
                    rows[:] = [np.concatenate([have, model.score_words(new)])]
                    cache.update(zip(new, range(len(have), len(have) + len(new)), strict=True))
                langs, scores = [], []
                for ws in found:
                    if not ws or not model.languages:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    log = np.zeros(len(model.languages))
                    short = [cache[w] for w in ws if w in cache]
                    if short:
                        log += rows[0][short].sum(0)
                    if len(short) < len(ws):
                        for w in ws:
                            if len(w) > SHORT:
                                log += model.long_word(w)
                    best = int(log.argmax())
                    langs.append(model.languages[best])
                    scores.append(float(1 / np.exp(log - log[best]).sum()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names)

    small_batches(docs.sparkSession)
    return plain.mapInArrow(run, schema), plain.columns


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score (the posterior of that language, all languages being as likely before).

    Every whole text is scored where it lies, without a shuffle; words are runs of letters (Unicode's category L). A text
    that is null or has no letter, and every text if the model has no language, is `und` with score 0. Ties go to the
    first language by name; repeated rows score alike. A very long text or word costs time and memory in proportion. An
    empty table gives no rows. Columns named lang_pred and score are replaced, others stay whatever their names.
    """
    docs = docs.drop("lang_pred", "score")
    found, _ = _predicted(docs, model, text_col)
    return found.toDF(*docs.columns, "lang_pred", "score")


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", path: str | None = None) -> Model:
    """A model of the labelled rows whose crc32(id) mod 4 is not 2."""
    labelled = docs.where(crc_mod(id_col, 4) != 2)
    return fit(count_words(training_sample(labelled, id_col, text_col, lang_col)), path or piece_path())


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs)
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return predict(docs.select("doc_id", "text", held_out), model).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose language can be told."""
    found, columns = _predicted(docs, learn(docs), "text")
    return found.where(F.col("lang_pred") != UNKNOWN).select(*columns).toDF(*docs.columns)
