"""The forward sums against all segmentations, and held-out accuracy."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from palimpsest.llm import language_id as lid


def test_forward_sums_all_segmentations():
    path = lid.piece_path()
    known = lid.pieces(path)
    p = np.random.default_rng(0).random((len(known) + 1, 2))
    p /= p.sum(0)
    model = lid.Model(path, ["x", "y"], p)
    for word in ("a", "the", "straße", "ñandú漢"):
        marked, total = "▁" + word, np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(marked) - 1):
            edges = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(marked)]
            parts = [marked[a:b] for a, b in itertools.pairwise(edges)]
            if all(len(x) == 1 or x in known for x in parts):
                total += np.prod([p[known.get(x, len(known))] for x in parts], 0)
        assert np.allclose(model.score_words([word])[0], np.log(total))
        assert np.allclose(model.long_word(word), np.log(total))


def test_long_word_takes_all_of_it(spark):
    model = lid.fit(spark.createDataFrame([("x", "abab", 5), ("y", "cdcd", 5)], "lang string, word string, n bigint"), lid.piece_path())
    log = model.long_word("ab" * 3000 + "cd" * 4000)
    assert np.isfinite(log).all() and log[1] > log[0]


def test_expected_counts_of_long_words_equal_those_of_short_ones(monkeypatch):
    path = lid.piece_path()
    p = np.random.default_rng(0).random((len(lid.pieces(path)) + 1, 2))
    model = lid.Model(path, ["x", "y"], p / p.sum(0))
    group, weight = ["straße", "the", "banana"], np.array([[1.0, 0], [2, 3], [0, 4]])
    want = model.expected(group, weight)
    monkeypatch.setattr(lid, "SHORT", 0)
    assert np.allclose(model.expected(group, weight), want)


def test_fit_counts_words_of_any_length(spark):
    rows = [("x", "ab" * 40, 2), ("y", "cd", 1)]
    model = lid.fit(spark.createDataFrame(rows, "lang string, word string, n bigint").repartition(2), lid.piece_path())
    assert np.allclose(model.p.sum(0), 1) and model.long_word("ab" * 40)[0] > model.long_word("ab" * 40)[1]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = lid.predict(docs, lid.learn(docs)).where("crc32(cast(doc_id as string)) % 4 = 2").toPandas()
    assert (found["lang"] == found["lang_pred"]).mean() > 0.98 and found["score"].between(0, 1).all()


def test_odd_rows(spark):
    schema = "doc_id bigint, text string, lang string, score string"
    rows = [(i, "the cat and the dog", "en", "s") for i in range(8)] + [(10 + i, "der hund und die katze", "de", "s") for i in range(8)]
    rows += [(30, None, "en", "s"), (31, "", None, "s"), (32, "123 !?", "de", "s"), (34, "²½ Ⅷ", "en", "s"), (33, "hund katze " * 20000, None, "s"), (None, "cat dog", None, "s")]
    docs = spark.createDataFrame(rows, schema)
    got = {r.doc_id: (r.lang_pred, r.score) for r in lid.predict(docs, lid.learn(docs)).collect()}
    assert got[30] == got[31] == got[32] == got[34] == ("und", 0.0) and got[33][0] == "de" and got[None][0] == "en"
    nothing = docs.where("false")
    assert lid.predict(nothing, lid.learn(nothing)).collect() == []
    unlabelled = docs.where("lang IS NULL")
    assert {r.lang_pred for r in lid.predict(unlabelled, lid.learn(unlabelled)).collect()} == {"und"}


def test_stage_leaves_columns_alone(spark, clashing):
    docs = clashing([(i, "the cat and the dog") for i in range(6)] + [(7, "12"), (8, None), (9, "the end"), (9, "the end")]).withColumn("lang", F.lit("en"))
    left = lid.keep_identified(spark, docs, "")
    assert left.columns == docs.columns
    assert sorted((r.doc_id, *r[2:]) for r in left.collect()) == [(i, *clashing.names, "en") for i in (0, 1, 2, 3, 4, 5, 9, 9)]
    assert lid.keep_identified(spark, docs.where("false"), "").collect() == []
