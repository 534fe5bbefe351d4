"""The pipeline on a small corpus: each stage's decisions hold for what follows."""

import corpus_pipeline
from palimpsest.llm import queries


def test_registered():
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 11)} == {name.split("_")[0] for name in queries.QUERIES}
    assert "pipeline" in entry.queries() and set(queries.ORACLES) <= set(queries.QUERIES)


def test_stages(spark, tmp_path):
    words = [f"w{i}" for i in range(400)]
    long = " ".join(f"the {w} and" for w in words[:60])
    rows = [(0, long, "en", "a", 1), (1, long, "en", "a", 1), (2, long + " more", "en", "a", 1), (3, "12 34", "en", "a", 1), (4, None, "en", "b", 1)]
    rows += [(10 + i, " ".join(f"the {w} of" for w in words[i * 9 : i * 9 + 30]), "en", "ab"[i % 2], 1) for i in range(30)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, folder)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert found.columns == docs.columns
        found.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    every = {r[0] for r in rows}
    assert kept[0] == every - {3, 4}
    assert kept[1] == kept[0] - {0}
    assert kept[2] == kept[1] - {2}
    assert kept[3] <= kept[2] and kept[3] == kept[4]
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and {r.doc_id for r in got.collect()} == kept[4]


def test_rows_without_ids_stay(spark):
    from palimpsest.llm import exact_dedup, ngram_join

    rows = [(None, "one two three four five six", "a"), (None, "one two three four five six", "b"), (None, "x y", "a"), (1, "x y", "a"), (None, "alone", "a"), (None, None, "a"), (None, "", "a"), (2, "other words", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    found = exact_dedup.keep_last(spark, docs, "")
    assert found.columns == docs.columns
    kept = [tuple(r) for r in found.collect()]
    assert sorted((i or 0, t or "", s) for i, t, s in kept) == [(0, "", "a"), (0, "alone", "a"), (0, "one two three four five six", "a"), (1, "x y", "a"), (2, "other words", "a")]
    near = ngram_join.keep_one_of_each(spark, found, "")
    assert sorted((r.doc_id or 0, r.text or "") for r in near.collect()) == sorted((i or 0, t or "") for i, t, _ in kept)


def test_oracles_are_sql():
    import __spark_entry__ as entry

    assert all(isinstance(sql, str) for sql in entry.oracle_sql().values())


def test_nothing_in_nothing_out(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
