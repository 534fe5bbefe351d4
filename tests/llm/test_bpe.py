"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from palimpsest.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
THEIRS = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def ours():
    return bpe.codec(PATH, public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    ours = bpe.codec(PATH, public_tokenizers.PATTERN)
    assert ours.encode(text) == THEIRS.encode_ordinary(text)
    assert ours.decode(ours.encode(text)) == text.encode()


def test_odd_characters(ours):
    r = random.Random(1)
    letters = "ab é\n\t \x0b\x0c\x1c\x1f\x85 ​ 　'strelvmdl0١²漢字🙂_-.\r﻿"
    for _ in range(3000):
        text = "".join(r.choices(letters, k=r.randint(0, 14)))
        assert ours.encode(text) == THEIRS.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 3000, "é" * 2000, " " * 3000, "abcabd" * 900, "漢字" * 700])
def test_long_pre_tokens(ours, text):
    assert ours.encode(text) == THEIRS.encode_ordinary(text)


def test_table(spark):
    texts = [None, "", "one two", "x" * 70000, "one two", "<|endoftext|>"]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id bigint, text string, ids string")
    coded = bpe.bpe_decode(bpe.bpe_encode(df, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    digest = {r.doc_id: r for r in bpe.bpe_digest(df, PATH, public_tokenizers.PATTERN).collect()}
    for r in coded.collect():
        ids = THEIRS.encode_ordinary(texts[r.doc_id] or "")
        assert r.ids == ids and bytes(r.decoded) == (texts[r.doc_id] or "").encode()
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        d = digest[r.doc_id]
        assert (d.n_tokens, d.ids_sha256, d.decoded_sha256) == (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(bytes(r.decoded)).hexdigest())
    assert bpe.bpe_digest(df.where("false"), PATH, public_tokenizers.PATTERN).collect() == []
