"""The backtracking encoder against the tokenizers library, and exact round trips."""

from __future__ import annotations

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import ROWS
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import bpe, queries
from ledgerloom.llm.common import documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as file:
        return bpe.BytePairCodec(file.read())


PIECES = [
    " ", "  ", "\n", "\t", "a", "the", "é", "ß", "日本", "<|endoftext|>", "'s", "'ll", "1", "23", "!", "??", "\xa0",
    "́", "\x1c", " ", "😀", "ing", "tion", "aaaaaaaaaa", "\x00", "²", "ª", "\x85", "ո", "՘",
]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=30), st.lists(st.sampled_from(PIECES), max_size=14).map("".join)))
def test_equals_the_library(library, codec, text):
    ids = codec.encode(text)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert codec.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False) == text


@pytest.mark.parametrize("text", ["a" * 30_000, " " * 3000 + "x", "ab" * 9000, "é" * 3000, "!" * 5000])
def test_long_pieces(library, codec, text):
    assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_any_ids_decode_as_in_the_library(library, codec):
    rng = random.Random(4)
    for _ in range(200):
        ids = [rng.randrange(50_257) for _ in range(20)]
        assert codec.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)
    assert codec.decode(np.array([-1, 99_999])) == ""


def test_merges_that_interfere():
    """A tiny vocabulary in which the longest match is often wrong."""
    alphabet = bpe.byte_alphabet()
    merges = [("b", "c"), ("a", "b"), ("ab", "c"), ("bc", "d"), ("a", "bcd"), ("c", "d"), ("ab", "cd")]
    vocab = {s: i for i, s in enumerate([*alphabet, "bc", "ab", "abc", "bcd", "abcd", "cd"])}
    merges = merges[:6]
    spec = json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
        "post_processor": None, "decoder": None,
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
                  "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
                  "vocab": vocab, "merges": [list(m) for m in merges]},
    })
    own, library = bpe.BytePairCodec(spec), Tokenizer.from_str(spec)
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 12)))
        assert own.encode(text).tolist() == library.encode(text).ids, text


def test_columns_on_odd_rows(spark, odd, none, library):
    vocabulary = bpe.Vocabulary(spark, PATH)
    coded = odd.withColumn("coded", vocabulary.encode(F.col("text")))
    rows = coded.withColumn("decoded", vocabulary.decode(F.col("coded"))).collect()
    assert len(rows) == len(ROWS) and coded.columns[:-1] == odd.columns
    for r in rows:
        assert r.coded == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "")
    assert none.select(vocabulary.encode(F.col("text"))).count() == 0
    nothing = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r[0] for r in nothing.select(vocabulary.decode(F.col("ids"))).collect()] == ["", ""]


def test_query(spark, library):
    texts = {r.doc_id: r.text for r in documents(spark, SMALL).collect()}
    rows = queries.op5_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
