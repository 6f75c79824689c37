"""The token store against the tokenizers library and by keyed look-ups."""

from __future__ import annotations

import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import ROWS
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import queries, token_store
from ledgerloom.llm.perfect_hash import Keys, PerfectHash, part_of
from ledgerloom.llm.pieces import SplittingEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as file:
        return SplittingEncoder(file.read())


TEXTS = st.lists(st.sampled_from([
    " ", "  ", "\n", "\t", "a", "The", "É", "ß", "日本", "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "12",
    "!?", "́", "\x1c", "\xa0", "😀", "İ", "Σ", "²", "ﬁ", "Å",
]), max_size=14).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_encoder_equals_the_library(library, encoder, text):
    got = np.frombuffer(encoder.encode(text, np.dtype("<u2")), "<u2").tolist()
    assert got == library.encode(text, add_special_tokens=False).ids


def test_whole_documents(spark, library):
    docs = duckdb.sql(
        f"SELECT doc_id, coalesce(text, '') FROM '{SMALL}/documents.parquet' ORDER BY doc_id"
    ).fetchall()
    want, start = {}, 0
    for (doc_id, _), e in zip(docs, library.encode_batch([d[1] for d in docs], add_special_tokens=False)):
        ids = np.array([*e.ids, 1], "<u4")
        want[doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    rows = queries.op1_token_store(spark, SMALL).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == want


def test_odd_rows(spark, odd, library, tmp_path):
    store = token_store.write(odd, PATH, 1, str(tmp_path / "store"))
    catalog = store.catalog(spark).orderBy("shard", "row").collect()
    assert len(catalog) == len(ROWS)
    ids = [r.doc_id for r in catalog]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))  # nulls first, ascending
    keys = store.catalog(spark).select("doc_id", "occurrence")
    assert keys.distinct().count() == len(ROWS)
    rows = token_store.read(spark, store, token_store.look_up(spark, store, keys)).collect()
    assert len(rows) == len(ROWS)
    want = sorted((i is None, i or 0, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in ROWS)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in rows) == want
    reader = token_store.TokenReader(spark, store)
    for r in rows:
        assert reader.get(r.doc_id, r.occurrence).tolist() == r.ids
    assert reader.get(77) is None and reader.get(5, 3) is None
    unknown = spark.range(100, 130).select(F.col("id").alias("doc_id"), F.lit(0).alias("occurrence"))
    assert token_store.look_up(spark, store, unknown).count() == 0


def test_an_id_over_several_shards(spark, tmp_path):
    rows = [(7, f"text {i}") for i in range(90)] + [(8, "last")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store = token_store.write(docs, PATH, 1, str(tmp_path / "store"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    catalog = store.catalog(spark)
    assert catalog.select("shard").distinct().count() > 1
    seen = sorted(r.occurrence for r in catalog.where("doc_id = 7").collect())
    assert seen == list(range(90))


def test_empty_table(spark, none, tmp_path):
    store = token_store.write(none, PATH, 1, str(tmp_path / "store"))
    keys = spark.range(3).select(F.col("id").alias("doc_id"), F.lit(0).alias("occurrence"))
    places = token_store.look_up(spark, store, keys)
    assert token_store.read(spark, store, places).count() == 0
    assert token_store.TokenReader(spark, store).get(1) is None


def test_perfect_hash_is_minimal():
    rng = random.Random(3)
    ids = np.array([i * 7919 - 2**62 for i in rng.sample(range(2**40), 5000)])
    keys = Keys(ids, np.zeros(5000, bool), np.zeros(5000, np.int64))
    table = PerfectHash.build(keys)
    assert sorted(table.slots(keys)) == list(range(5000))
    with pytest.raises(ValueError):
        PerfectHash.build(Keys(np.array([1, 1]), np.zeros(2, bool), np.zeros(2, np.int64)))


def test_parts_agree_with_spark(spark):
    rows = [(i, o) for i in (None, 0, 5, -9, 2**60) for o in (0, 3)]
    df = spark.createDataFrame(rows, "doc_id long, occurrence long")
    for r in df.select("*", F.pmod(F.xxhash64("doc_id", "occurrence"), F.lit(97)).alias("p")).collect():
        assert part_of(r.doc_id, r.occurrence, 97) == r.p
