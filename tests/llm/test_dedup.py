"""Exact copies, n-gram joins and components against direct computations."""

import collections
import random
import re

import pyarrow as pa

from palimpsest.llm import common, components, exact_dedup, ngram_join

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def joined(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])
    parent = {i: i for i in sets}
    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(parent, i), find(parent, j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(parent, i)) for i, s in sets.items()}


def test_ngram_join(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(2000)]
    base, hot, rows = r.choices(words, k=90), r.choices(words, k=60), []
    for i in range(70):
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join([*r.choices(words, k=r.randint(3, 14)), *hot])) for i in range(70)]
    rows += [(200 + i, " ".join(r.choices(words[:3], k=r.randint(0, 8)))) for i in range(40)]
    rows += [(300, None), (301, ""), (302, " \t"), (303, "A b"), (304, "a B"), (305, "x" * 5000), (306, rows[0][1]), (307, "É b c d e"), (308, "é b c d e")]
    df = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id bigint, text string, grams string").repartition(4)
    assert {x.id: (x.n_shingles, x.component_id) for x in ngram_join.ngram_join(df).collect()} == joined(rows)


def test_ngram_join_of_a_large_group(spark, monkeypatch):
    """Near copies that don't link to a common centre, over several blocks of their cluster."""
    r = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    base, rows = r.choices(words, k=120), []
    for i in range(500):
        w = list(base)
        for _ in range(r.choice([1, 2, 3, 4, 5])):
            w[r.randrange(len(w))] = r.choice(words[:40])
        rows.append((i + 1, " ".join(w)))
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 64)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert {x.id: (x.n_shingles, x.component_id) for x in ngram_join.ngram_join(df).collect()} == joined(rows)


def test_ngram_join_of_rows_that_share_an_id(spark):
    text = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcd"]
    rows = [(1, text[0]), (1, text[1]), (2, text[0]), (3, text[1] + " x"), (4, text[2]), (4, text[2]), (5, text[2]), (6, text[3]), (None, text[3]), (7, None), (7, "")]
    got = sorted((x.id or 0, x.component_id) for x in ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (5, 4), (6, 6), (0, None), (7, 7), (7, 7)])


#: Two words of 1,024 letters, each the other with its two letters swapped: a polynomial hash modulo 2**64 can't tell them apart.
THUE_MORSE = ["".join("ab"[(i.bit_count() + k) % 2] for i in range(1024)) for k in (0, 1)]


def test_ngram_join_of_patterned_words(spark):
    df = spark.createDataFrame(list(enumerate(THUE_MORSE)), "doc_id bigint, text string")
    assert sorted((x.id, x.component_id) for x in ngram_join.ngram_join(df).collect()) == [(0, 0), (1, 1)]


def test_word_hashes():
    r = random.Random(1)
    words = ["".join(r.choice("abé") for _ in range(r.choice([1, 2, 7, 8, 9, 16, 255, 256, 257, 900]))) for _ in range(2000)]
    raw, places = common.bytes_of(common.plain_strings(pa.array([" ".join(words), "", " a"])))
    start, end, owner, h = common.words_of(raw, places)
    assert [raw[a:b].tobytes().decode() for a, b in zip(start, end)] == [*words, "a"]
    assert len(set(h.tolist())) == len({*words, "a"}) and owner.tolist() == [0] * 2000 + [2]


def test_ngram_join_of_nothing(spark):
    schema = "doc_id bigint, text string"
    assert ngram_join.ngram_join(spark.createDataFrame([], schema)).collect() == []
    got = ngram_join.ngram_join(spark.createDataFrame([(None, "a b"), (1, "a b")], schema)).collect()
    assert {(x.id, x.component_id) for x in got} == {(None, None), (1, 1)}


def test_components(spark):
    r = random.Random(2)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(150)] + [(k, k + 1) for k in range(400, 470)] + [(500, 500), (None, 3)]
    parent = {x: x for p in pairs if None not in p and p[0] != p[1] for x in p}
    for a, b in pairs:
        if a in parent and b in parent and a != b:
            x, y = find(parent, a), find(parent, b)
            parent[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert sorted((x.id, x.component) for x in got) == sorted((x, find(parent, x)) for x in parent)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_exact(spark):
    texts = ["a", "b", "a", None, "", "x" * 9000, "x" * 9000, "x" * 9000 + "y", "A", "é"] + ["copy"] * 50
    df = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id bigint, text string, kept boolean").repartition(3)
    groups = collections.defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    got = {r.doc_id: (r.text, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df).collect()}
    assert got == {i: (texts[i], max(g), len(g), i == max(g)) for g in groups.values() for i in g}
    assert exact_dedup.exact_dedup(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_exact_repeated_rows_and_names(spark, clashing):
    rows = [(1, "a b"), (1, "a b"), (1, "a b"), (0, "a b"), (2, "x"), (2, "x"), (3, "alone"), (4, None), (4, None), (4, "")]
    df = clashing(rows)
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df).collect())
    assert got == sorted([(1, 1, 4, False), (1, 1, 4, False), (1, 1, 4, True), (0, 1, 4, False), (2, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 4, 3, False), (4, 4, 3, False), (4, 4, 3, True)])
    left = exact_dedup.keep_last(spark, df, "")
    assert left.columns == df.columns
    assert sorted((r.doc_id, *r[2:]) for r in left.collect()) == [(i, *clashing.names) for i in (1, 2, 3, 4)]
    mapped = df.selectExpr("doc_id", "text", "map(words, 1) AS m")
    assert sorted(r.doc_id for r in exact_dedup.keep_last(spark, mapped, "").collect()) == [1, 2, 3, 4]
    nothing = df.where("false")
    assert exact_dedup.keep_last(spark, nothing, "").collect() == [] and exact_dedup.keep_last(spark, nothing, "").columns == df.columns


def test_near_copies_stage_names(spark, clashing):
    text = " ".join(f"w{i}" for i in range(60))
    df = clashing([(5, text), (3, text + " more"), (9, "other words"), (None, text), (9, "other words"), (None, None)])
    left = ngram_join.keep_one_of_each(spark, df, "")
    assert left.columns == df.columns
    assert sorted((r.doc_id or 0, *r[2:]) for r in left.collect()) == [(i, *clashing.names) for i in (0, 0, 3, 9, 9)]
    nothing = df.where("false")
    assert ngram_join.keep_one_of_each(spark, nothing, "").collect() == []
