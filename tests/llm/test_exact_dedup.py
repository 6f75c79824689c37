"""Copies by chunk recipes against plain comparison, also with hashes that collide."""

from __future__ import annotations

import hashlib
import re

import pytest
from llm.conftest import LONG, ROWS
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup as ed


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check(rows, got):
    assert len(got) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for sha, ids in by_sha.items():
        mine = [r for r in got if r.text_sha256 == sha]
        assert len(mine) == len(ids) and {r.group_size for r in mine} == {len(ids)}
        known = [i for i in ids if i is not None]
        assert {r.keep_id for r in mine} == {min(known) if known else None}
        kept = [r.doc_id for r in mine if r.kept]
        assert kept == [min(known) if known else None]


HASHES = [ed.chunk_hash, lambda c: F.length(c).cast("long") % 3, lambda c: F.lit(1).cast("long")]


@pytest.mark.parametrize("hashed", HASHES)
def test_odd_rows(spark, odd, hashed):
    check(ROWS, ed.duplicates(odd, hashed).collect())


@pytest.mark.parametrize("hashed", HASHES)
def test_texts_that_share_passages(spark, hashed):
    parts = [f"passage {i} " * 60 for i in range(4)]
    texts = [a + b for a in parts for b in parts] + [LONG, LONG + "!", "\t" + LONG, " " + LONG] + [" \n", " "]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts[::3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(rows, ed.duplicates(df, hashed).collect())


def test_chunks_put_together_are_the_text(spark):
    rows = [(t,) for t in (LONG, "", "x", "é" * 20_000, "lorem fil " * 3000, "😀" * 9000)]
    df = spark.createDataFrame(rows, "text string").select("text", ed.chunks(F.col("text")).alias("c"))
    for r in df.collect():
        assert "".join(r.c) == r.text
        assert all(len(c) <= ed.MAX_CHARS for c in r.c)


def test_a_cut_follows_the_content(spark):
    """A word put in front changes the first chunks only."""
    text = " ".join(f"column {i * i} of circular files" for i in range(3000))
    a, b = (r.c for r in spark.createDataFrame([(text,), ("one more " + text,)], "text string")
            .select(ed.chunks(F.col("text")).alias("c")).collect())
    assert len(set(a) & set(b)) > 0.8 * len(a)


def test_empty_table(none):
    assert ed.duplicates(none).count() == 0
