"""Removal of long repeats against direct counts of all windows."""

import collections
import hashlib
import random

import numpy as np

from palimpsest.llm import run_length_index as index


def brute(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[p : p + length] for _, b in raw for p in range(len(b) - length + 1))
    out = collections.defaultdict(list)
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i].append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


def found(spark, rows, length, gram):
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id bigint, text string, spans int").repartition(3)
    out = collections.defaultdict(list)
    for r in index.remove_repeats(df, length=length, gram=gram).collect():
        out[r.id].append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    return {i: sorted(v) for i, v in out.items()}


def corpus():
    r = random.Random(3)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 8))) for _ in range(400)]
    shared = [" ".join(r.choices(words, k=30)) for _ in range(5)]
    rows = []
    for i in range(80):
        t = " ".join(r.choices(words, k=r.randint(0, 50)))
        for _ in range(r.randint(0, 3)):
            p, a = r.choice(shared), r.randint(0, 40)
            t += " " + p[a : r.randint(a, len(p))] + " " + " ".join(r.choices(words, k=10))
        rows.append((i, t))
    odd = ["a" * 500, "abc" * 120, "abc" * 14, None, "", "a" * 41, "a" * 40, "xyzw" * 9 + "xyzwx", "q" * 9000]
    return rows + [(200 + k, t) for k, t in enumerate(odd)] + [(7, rows[7][1]), (7, rows[7][1])]


def test_brute_force(spark):
    rows = corpus()
    assert found(spark, rows, 40, 8) == brute(rows, 40)


def test_large_groups_and_long_runs(spark, monkeypatch):
    monkeypatch.setattr(index, "GROUP_BYTES", 2000)
    monkeypatch.setattr(index, "PIECE_WINDOWS", 64)
    rows = corpus()
    assert found(spark, rows, 40, 8) == brute(rows, 40)


def test_empty_table(spark):
    assert found(spark, [], 40, 8) == {}


def test_index_of_random_pieces():
    r = random.Random(1)
    for _ in range(30):
        pieces = ["".join(r.choice("ab") for _ in range(r.randint(1, 40))).encode() for _ in range(r.randint(1, 6))]
        pieces = list(dict.fromkeys(pieces))
        made = index.RunLengthIndex(pieces)
        got = made.matching_statistics()
        places = [(k, p) for k, x in enumerate(pieces) for p in range(len(x))]
        tails = [pieces[k][p:] for k, p in places]
        common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: B905, E731
        for i, (k, p) in enumerate(places):
            at = made.ends[k] - len(pieces[k]) + p
            assert got[at] == max((common(tails[i], t) for j, t in enumerate(tails) if j != i), default=0)
        assert np.all(got >= 0) and made.runs <= len(made.text)
