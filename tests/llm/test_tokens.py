"""Token counts and token files against the library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from zoneflow.llm import token_counts, token_files
from zoneflow.llm.pieces import Encoder

from .conftest import frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH, list, lambda parts: [i for p in parts for i in p], limit=50)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text("ab' \n\t1.é—s日<|\x85\xa0\x1c", max_size=40)))
def test_pieces_are_the_librarys(text):
    assert ENCODER.of(text) == ids(text)


def test_special_strings():
    for t in ("a  <|endoftext|> b", "<|endoftext|>", " <|endoftext|>x", "a <|endoftext| > "):
        assert ENCODER.of(t) == ids(t)


@pytest.mark.parametrize("sample", [0, 4000])
def test_counts(spark, messy_rows, sample):
    got = token_counts.token_counts(frame(spark, messy_rows), PATH, max_tokens=5, sample_docs=sample).collect()
    want = [(r[0], len((r[1] or "").encode()), n := len(ids(r[1])), n > 5) for r in messy_rows]
    assert order(got) == order(want)


def test_counts_of_nothing(spark):
    assert token_counts.token_counts(frame(spark, []), PATH).count() == 0


def brute_files(rows, end):
    at, out = 0, []
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        own = np.array([*ids(t), end], "<u4")
        out.append((i, at, len(own), zlib.crc32(own.tobytes())))
        at += len(own)
    return out


@pytest.mark.parametrize("end", [2, 70_000])
def test_files(spark, messy_rows, tmp_path, end):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = messy_rows + [(1000 + i, f"more text {i} " * (i % 7)) for i in range(500)]
    docs = frame(spark, rows)
    folder = f"file://{tmp_path}/tokens"
    got = token_files.token_files(docs, PATH, folder, end)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert order(got.collect()) == order(brute_files(rows, end))
    files = sorted((tmp_path / "tokens").glob("*.ids"))
    assert len(files) > 1
    flat = np.concatenate([np.fromfile(f, "<u2" if end == 2 else "<u4") for f in files])
    assert len(flat) == sum(len(ids(r[1])) + 1 for r in rows)
    off = np.concatenate([np.fromfile(f.with_suffix(".off"), "<u8")[:-1] for f in files])
    assert (np.diff(off.astype(np.int64)) > 0).all() and off[0] == 0
    assert not list((tmp_path / "tokens").glob(".part*"))


def test_files_of_nothing(spark, tmp_path):
    assert token_files.token_files(frame(spark, []), PATH, f"file://{tmp_path}/none").count() == 0
