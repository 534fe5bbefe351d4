"""Context-tree scores against a direct computation of the tree."""

import collections
import functools
import math
import re
import zlib

from palimpsest.llm import context_tree

DEPTH = context_tree.DEPTH


def low(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode()


def words(raw):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", raw), None]


def decisions(raw):
    s = bytes([255]) * DEPTH + raw + bytes([255])
    for p in range(DEPTH, len(s)):
        for j in range(8):
            yield s[p - DEPTH : p][::-1], (1 << j) | (s[p] >> (8 - j)), s[p] >> (7 - j) & 1


def brute(rows):
    count, children, tokens = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(set), collections.Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10 == 0:
            continue
        tokens.update(words(low(t)))
        for ctx, node, bit in decisions(low(t)):
            for d in range(DEPTH + 1):
                count[ctx[:d], node][bit] += 1
                if d < DEPTH:
                    children[ctx[:d], node].add(ctx[: d + 1])
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    of = lambda ctx, node: count.get((ctx, node), (0, 0))

    @functools.lru_cache(None)
    def weighted(ctx, node):
        own = kt(*of(ctx, node))
        if len(ctx) == DEPTH:
            return own
        below = sum(weighted(c, node) for c in children.get((ctx, node), ()))
        top = max(own, below)
        return top + math.log((math.exp(own - top) + math.exp(below - top)) / 2)

    def p(ctx, node, bit):
        out = None
        for d in range(DEPTH, -1, -1):
            a, b = of(ctx[:d], node)
            q = ((b if bit else a) + 0.5) / (a + b + 1)
            stop = 1 if out is None else math.exp(kt(a, b) - math.log(2) - weighted(ctx[:d], node))
            out = stop * q + (1 - stop) * (out or 0)
        return out

    n, v = sum(tokens.values()), len(tokens)
    result = {}
    for i, t in rows:
        own = words(low(t))
        base = sum(math.log10((tokens[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        result[i] = (len(own), sum(tokens[w] > 0 for w in own), n, base, sum(math.log10(p(*d)) for d in decisions(low(t))))
    return result


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, score string").repartition(3)
    got = {r.id: r for r in context_tree.ctw_scores(df, block_bytes=3000).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for i, w in want.items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == w[:3]
        assert math.isclose(got[i].base_score, w[3], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(got[i].score, w[4], rel_tol=1e-6)


def test_brute_force(spark):
    docs = [(r.doc_id, r.text[:300]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(25).collect()]
    check(spark, docs + [(900, None), (901, ""), (902, "été Ünï🙂 x"), (903, " "), (904, "ab" * 400)])


def test_no_training_text(spark):
    held_out = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 10 == 0)
    check(spark, [(held_out, "abc d")])


def test_empty_table(spark):
    assert context_tree.ctw_scores(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_patterned_words_and_long_texts(spark):
    """Words that a polynomial hash modulo 2**64 confuses, and a text of many blocks' length."""
    one, other = ("".join("ab"[(i.bit_count() + k) % 2] for i in range(1024)) for k in (0, 1))
    held_out = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 10 == 0)
    trained = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 10 != 0)
    check(spark, [(trained, one), (held_out, other), (trained + 1000, "long words " * 900)])


def test_shards_in_copies(spark, monkeypatch):
    monkeypatch.setattr(context_tree, "ASK_BYTES", 300)
    check(spark, [(i, f"the cat {i} and the dog {i * 7} sat there " * 6) for i in range(40)])
