"""Fingerprints by hand, links and components against all pairs."""

from __future__ import annotations

import random

import pytest
import xxhash
from llm.conftest import ROWS
from pyspark.sql import functions as F

from ledgerloom.llm import simhash as sh


def plain_fingerprint(text, n=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, max_bits):
    """Smallest value reachable, over all pairs."""
    values = sorted(set(values))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {v: find(v) for v in values}


def test_fingerprints(spark, odd):
    rng = random.Random(2)
    texts = [t for _, t in ROWS] + [" ".join(rng.choice(["A", "b\t", "é", "word", "x.y"]) for _ in range(k)) for k in range(30)]
    for t in texts:
        assert sh.text_fingerprint(t, 3, 42) & (2**64 - 1) == plain_fingerprint(t)
    got = odd.select("text", sh.hex16(sh.fingerprint(F.col("text"))).alias("h")).collect()
    assert all(r.h == f"{plain_fingerprint(r.text):016x}" for r in got)


def signed(v):
    return v - 2**64 if v >> 63 else v


@pytest.mark.parametrize(("max_bits", "pairs_up_to"), [(2, 24), (2, 2), (1, 2), (1, 24), (3, 2), (0, 24)])
def test_components_against_all_pairs(spark, max_bits, pairs_up_to):
    """Clusters, chains and crowds, with buckets above and below the bound for pairs."""
    rng = random.Random(max_bits)
    values = [rng.getrandbits(64) for _ in range(60)]
    for v in values[:6]:  # crowds around a value
        values += [v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(25)]
    chain = values[7]
    for i in range(40):  # each step two bits on
        chain ^= (1 << i) | (1 << (i + 20))
        values.append(chain)
    values = sorted({signed(v) for v in values})
    nodes = spark.createDataFrame([(v,) for v in values], "fp long").repartition(4)
    links = sh.close_links(nodes, max_bits, pairs_up_to=pairs_up_to)
    found = {r.node: r.root for r in sh.connected(links).collect()}
    want = roots(values, max_bits)
    assert {v: found.get(v, v) for v in values} == want
    for r in links.collect():
        assert r.a < r.b and ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= max_bits


def test_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, i) for i in range(1001, 1200)]
    links = spark.createDataFrame(chain + star, "a long, b long").repartition(5)
    found = {r.node: r.root for r in sh.connected(links).collect()}
    assert found == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1200), 1000)}


def test_components_of_odd_rows(spark, odd, none):
    rows = sh.components(odd).collect()
    assert len(rows) == len(ROWS)
    prints = [signed(plain_fingerprint(t)) for _, t in ROWS]
    root = roots(prints, 2)
    least = {}
    for (i, _), fp in zip(ROWS, prints):
        if i is not None:
            least[root[fp]] = min(i, least.get(root[fp], i))
    want = sorted((str(i), fp, str(least.get(root[fp]))) for (i, _), fp in zip(ROWS, prints))
    assert sorted((str(r.doc_id), r.fp, str(r.component_id)) for r in rows) == want
    assert sh.components(none).count() == 0


def test_no_links(spark):
    assert sh.connected(spark.createDataFrame([], "a long, b long")).count() == 0
