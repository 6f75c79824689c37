"""Shards of bounded size: brute force over prefixes, hot keys, odd rows."""

from __future__ import annotations

from collections import defaultdict

import pytest
from llm.conftest import ROWS
from pyspark.sql import functions as F

from ledgerloom.llm import sharding


def brute(rows, limit):
    """Shortest prefix whose bucket fits, for (bits, bytes) rows."""
    out = []
    for bits, _ in rows:
        for depth in range(len(bits) + 1):
            inside = [b for other, b in rows if other[:depth] == bits[:depth]]
            if sum(inside) <= limit or len(inside) == 1 or depth == len(bits):
                out.append(bits[:depth])
                break
    return out


@pytest.mark.parametrize("limit", [1, 40, 300, 10**6])
def test_directory_against_brute_force(spark, limit):
    rows = [(f"{i * 2654435761 % 2**16:016b}" + "0" * 104, 5 + i % 30) for i in range(120)]
    rows += [(f"{77:016b}" + f"{i:0104b}", 9) for i in range(40)]  # one key, told apart by the row
    df = spark.createDataFrame(rows, "bits string, n_bytes long")
    found = {(r.cell, r.depth) for r in sharding.directory(df, limit).collect()}
    want = brute(rows, limit)
    for (bits, _), shard in zip(rows, want):
        mine = [(c, d) for c, d in found if bits.startswith(c)]
        assert len(mine) == 1 and mine[0][0][:mine[0][1]] == shard


def test_a_key_with_a_third_of_all_rows(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i}", "x" * 50) for i in range(600)]
    df = spark.createDataFrame(rows, "source string, text string")
    got = sharding.assign(df, 500, key="source").collect()
    assert len(got) == 600 and max(r.shard_bytes for r in got) <= 500
    sizes = defaultdict(int)
    for r in got:
        sizes[r.shard] += r.n_bytes
    assert all(sizes[r.shard] == r.shard_bytes for r in got)


def test_odd_rows(spark, odd, none, tmp_path):
    got = sharding.assign(odd, 100).collect()
    assert len(got) == len(ROWS)
    assert all(r.shard_bytes <= 100 or r.shard_rows == 1 for r in got)
    assert sum(r.n_bytes for r in got) == sum(len((t or "").encode()) for _, t in ROWS)
    assert sharding.assign(none, 100).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(odd, 0)
    sharding.write_shards(odd, str(tmp_path / "out"), 100)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select(odd.columns).exceptAll(odd).count() == 0 and back.count() == len(ROWS)


def test_one_shard_if_all_fits(spark):
    df = spark.range(5).select(F.col("id").alias("doc_id"), F.lit("ab").alias("text"))
    assert {(r.shard, r.shard_rows) for r in sharding.assign(df, 10).collect()} == {("", 5)}
