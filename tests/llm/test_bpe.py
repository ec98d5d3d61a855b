"""Encoding against two public libraries over the same vocabulary."""

import base64
import os
import random

import numpy as np
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from spotweave.llm import bpe

pytestmark = pytest.mark.skipif(not os.path.exists(bpe.VOCABULARY), reason="needs the vocabulary files")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def reference():
    with open(bpe.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(texts):
    joined = "".join(texts)
    ends = np.cumsum([len(t) for t in texts])
    at = bpe.starts(np.frombuffer(joined.encode("utf-32-le"), np.uint32), ends)
    cut = [*np.flatnonzero(at).tolist(), len(joined)]
    return [joined[a:b] for a, b in zip(cut, cut[1:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="'strelvdm aZé1½漢-\n\t\r\x0b\u3000\u200b\u0301𝔘’S", max_size=20), min_size=1, max_size=6))
def test_pieces(texts):
    if any(texts):
        assert pieces(texts) == [p for t in texts for p in regex.findall(PATTERN, t)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_any_text(texts):
    v = bpe.vocabulary(bpe.VOCABULARY)
    ids, upto = v.encode(texts)
    for got, text in zip(np.split(ids, upto[:-1]) if texts else [], texts):
        assert v.decode(got.tolist()) == text


def test_against_library(spark, reference):
    r = random.Random(7)
    letters = ["'", "s", "re", "ll", " ", "  ", "\n", "é", "1", "½", "漢", "-", "…", "<|endoftext|>", "the", "ing", "'S"]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 25))) for _ in range(3000)]
    texts += [None, "", " ", "\n\n", "a" * 20_000, " " * 5000 + "x", "é" * 3000, "ab" * 9000]
    df = spark.createDataFrame([(i, t, [0]) for i, t in enumerate(texts)], "doc_id bigint, text string, ids array<int>").repartition(3)
    got = {x.doc_id: x.ids for x in bpe.encode(df).collect()}
    assert got == {i: reference.encode_ordinary(t or "") for i, t in enumerate(texts)}
    assert {x.doc_id: x.n_tokens for x in bpe.lengths(df).collect()} == {i: len(x) for i, x in got.items()}
    assert {x.doc_id: x.text for x in bpe.decode(bpe.encode(df)).collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_known_piece_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 10)
    v = bpe.Vocabulary(bpe.VOCABULARY)
    texts = [f"word{i} and{i}" for i in range(100)]
    first = v.encode(texts)[0].tolist()
    assert len(v.known) <= 10 and v.encode(texts)[0].tolist() == first


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.encode(empty).count() == 0 and bpe.lengths(empty).count() == 0
    twice = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id bigint, text string")
    assert bpe.encode(twice).count() == 3
