"""Encoding and decoding by recursive queries against the library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from zoneflow.llm import byte_bpe

from .conftest import frame

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
BPE = byte_bpe.Bpe(PATH, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=BPE.vocab, special_tokens={})


def ids(text):
    return np.array(LIBRARY.encode_ordinary(text or ""), "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(), st.text("ab' \n\t1.é—s日<|\x85\xa0\x1c", max_size=40)), max_size=4))
def test_ids_are_the_librarys(texts):
    encoded = BPE.encode(texts)
    assert encoded == [ids(t) for t in texts]
    assert BPE.decode(encoded) == [t.encode() for t in texts]


def test_caches_turn_over():
    small = byte_bpe.Bpe(PATH, public_tokenizers.PATTERN, held=5)
    for i in range(6):
        texts = [f"qzx{i}w{j}kk vbn{j} the  qzx\n{i}" for j in range(9)]
        assert small.encode(texts) == [ids(t) for t in texts]
    assert len(small.pieces) < 40


@pytest.mark.parametrize("rows", [2_000_000, 700])
def test_long_words_go_through_several_queries(monkeypatch, rows):
    monkeypatch.setattr(byte_bpe, "QUERY_ROWS", rows)
    words = ["x" * 300, "ab" * 200 + "q", "".join(chr(97 + i * i % 26) for i in range(500)), "aaa", "zq"]
    assert byte_bpe.Bpe(PATH, public_tokenizers.PATTERN).encode(words) == [ids(w) for w in words]


def test_slices():
    cut = byte_bpe.slices(enumerate(["ab", "c", "", "x" * 9, "d", "e"]), 3)
    assert [[i for i, _ in part] for part in cut] == [[0, 1, 2], [3], [4, 5]]
    assert list(byte_bpe.slices([], 3)) == []


def test_round_trip(spark, messy_rows):
    docs = frame(spark, messy_rows)
    got = byte_bpe.round_trip(docs, PATH, public_tokenizers.PATTERN).collect()
    want = [(r[0], len(ids(r[1])) // 4, hashlib.sha256(ids(r[1])).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in messy_rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_encode(spark, messy_rows):
    got = byte_bpe.encode(frame(spark, messy_rows), PATH, public_tokenizers.PATTERN).collect()
    want = [(r[0], LIBRARY.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in messy_rows]
    assert sorted(((r[0], r[1], bytes(r[2])) for r in got), key=repr) == sorted(want, key=repr)


def test_nothing(spark):
    assert byte_bpe.round_trip(frame(spark, []), PATH, public_tokenizers.PATTERN).count() == 0
