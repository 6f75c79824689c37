"""Suffix arrays, common prefixes and removed passages against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from llm.conftest import LONG, ROWS

from ledgerloom.llm import suffix_dedup as sd


def brute(texts: list[bytes], length: int) -> list[tuple[list[tuple[int, int]], bytes]]:
    """Spans and kept bytes of each text."""
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        covered = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                covered[i:i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], covered]).astype(int)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((spans, bytes(c for c, gone in zip(t, covered) if not gone)))
    return out


def some_texts(seed: int, n: int = 60) -> list[str]:
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(20, 90))) for _ in range(6)]
    texts = []
    for i in range(n):
        parts = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 120))) for _ in range(3)]
        texts.append(parts[0] + rng.choice(shared) + parts[1] + rng.choice(shared)[rng.randint(0, 20):] + parts[2])
    return texts + ["", "a" * 300, "ab" * 100, "x\x00" * 40, texts[0], texts[1][5:] + "end"]


def strings(*parts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(parts), np.uint8)
    left = np.repeat(ends, sizes) - np.arange(len(data))
    return data, left, ends - sizes, sizes


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array_and_common_prefixes(seed):
    rng = random.Random(seed)
    parts = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(1, 60))) for _ in range(12)]
    parts += [parts[0], parts[1][3:] + b"b", b"a" * 80, b"a" * 80, b"a"]
    data, left, starts, sizes = strings(*parts)
    order = sd.suffix_array(data, left)
    suffixes = [data[i:i + left[i]].tobytes() for i in range(len(data))]
    assert order.tolist() == sorted(range(len(data)), key=lambda i: (suffixes[i], i))
    before, shared = sd.common_prefixes(data, left, order, starts, sizes)
    for slot, i in enumerate(order):
        assert before[i] == (order[slot - 1] if slot else -1)
        other = suffixes[before[i]] if slot else b""
        same = next((k for k, (a, b) in enumerate(zip(other, suffixes[i])) if a != b), min(len(other), left[i]))
        assert shared[i] == (same if slot else 0)


def test_suffix_array_of_nothing():
    assert len(sd.suffix_array(np.zeros(0, np.uint8), np.zeros(0, np.int64))) == 0


def test_every_window_is_in_one_passage_and_equal_windows_share_a_name():
    rng = random.Random(5)
    passage = bytes(rng.randrange(97, 101) for _ in range(120))
    texts = [bytes(rng.randrange(97, 101) for _ in range(200)) + passage + b"c" * k for k in (0, 3, 90)]
    names = {}
    for t in texts:
        starts, ends, hashes = sd.passages(np.frombuffer(t, np.uint8), 40, 8)
        at = 0
        for a, b, h in zip(starts, ends, hashes):
            assert a == at and b - a >= 40
            for i in range(a, b - 40 + 1):
                assert names.setdefault(t[i:i + 40], h) == h
            at = b - 40 + 1
        assert at == len(t) - 40 + 1


@pytest.mark.parametrize("shard_bytes", [2 << 20, 400])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, monkeypatch, seed, shard_bytes):
    """Small shards spread crowded names over several, so that shards are merged."""
    monkeypatch.setattr(sd, "MERGED", 64)
    texts = some_texts(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = {r.doc_id: r for r in sd.without_repeats(docs, 40, shard_bytes).collect()}
    want = brute([t.encode() for t in texts], 40)
    assert len(rows) == len(texts) and any(spans for spans, _ in want)
    for i, (spans, kept) in enumerate(want):
        assert [(s["first"], s["last"]) for s in rows[i].spans] == spans
        assert bytes(rows[i].kept) == kept
        assert rows[i].n_bytes == len(texts[i].encode()) and rows[i].n_removed == rows[i].n_bytes - len(kept)


def test_a_crowded_border_is_merged_across_shards(spark):
    """One passage in many texts, each going on in its own way."""
    rng = random.Random(9)
    common = "".join(rng.choice("abcdefgh ") for _ in range(70))
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(60)) + common + "".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = {r.doc_id: r for r in sd.without_repeats(docs, 40, 1000).collect()}
    for i, (spans, kept) in enumerate(brute([t.encode() for t in texts], 40)):
        assert bytes(rows[i].kept) == kept and len(rows[i].spans) == len(spans) > 0


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 64)
    texts = some_texts(3, 10)
    run = sd._occurrences(40, 8)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"file": [0] * len(texts), "place": list(range(len(texts))), "bytes": [t.encode() for t in texts]})
    covered = Counter()
    for out in run(iter([batch])):
        for r in out.to_pylist():
            covered.update((r["place"], i) for i in range(r["start"], r["start"] + r["size"] - 39))
    assert set(covered.values()) == {1}
    assert len(covered) == sum(max(0, len(t.encode()) - 39) for t in texts)


def test_odd_rows(spark, odd, none):
    rows = sd.without_repeats(odd).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if r.n_bytes == len(LONG):
            assert r.n_removed == r.n_bytes and bytes(r.kept) == b"" and len(r.spans) == 1
        else:
            assert r.n_removed == 0 and len(r.kept) == r.n_bytes and r.spans == []
    assert sum(r.doc_id is None for r in rows) == sum(i is None for i, _ in ROWS)
    assert sd.without_repeats(none).count() == 0
    with pytest.raises(ValueError, match="16"):
        sd.without_repeats(none, 10)
