"""Benchmark windows in documents against a brute-force search."""

from __future__ import annotations

import random
import re

import pytest
from llm.conftest import ROWS

from ledgerloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window):
    said, hit, found = words(text), set(), set()
    for item, other in items:
        w = words(other)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            part = w[i:i + window]
            for at in range(len(said) - len(part) + 1):
                if said[at:at + len(part)] == part:
                    hit.update(range(at, at + len(part)))
                    if item is not None:
                        found.add(str(item))
    return len(said), len(hit), sorted(found)


def random_case(seed):
    rng = random.Random(seed)
    alphabet = ["The", "of", "A", "é", "x1", "日本", "long-word", "end."]

    def text(n):
        return " ".join(rng.choice(alphabet) for _ in range(n))

    items = [(i, text(rng.choice([0, 1, 2, 3, 5, 9]))) for i in range(12)] + [(None, "of of of of"), (3, "end x1 The A"), (4, None)]
    docs = [(i, text(rng.choice([0, 1, 4, 30, 60]))) for i in range(40)]
    docs += [(100 + i, f"{text(3)} {t} {text(2)}") for i, (_, t) in enumerate(items) if t]
    return docs, items


@pytest.mark.parametrize(("seed", "window", "shingle", "links"), [(1, 5, 3, 10**6), (2, 4, 2, 7), (3, 2, 3, 10**6), (4, 6, 1, 20)])
def test_against_brute_force(spark, odd, seed, window, shingle, links):
    docs, items = random_case(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(d, b, window, links, shingle).collect()
    assert len(rows) == len(docs)
    texts = dict(docs)
    for r in rows:
        assert (r.n_words, r.n_hit, r["items"]) == brute(texts[r.doc_id], items, window)
    marked = decontaminate.contaminated(d, b, window, shingle, links).collect()
    assert {r.doc_id for r in marked if r.contaminated} == {r.doc_id for r in rows if r.n_hit}


def test_odd_rows(spark, odd, none):
    items = [(1, "the quick brown fox jumps over a lazy dog and the quick"), (2, "the"), (None, "white space")]
    b = spark.createDataFrame(items, "item_id long, text string")
    for links in (10**6, 2):
        rows = decontaminate.contamination(odd, b, links_per_block=links).collect()
        got = sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in rows)
        assert got == sorted((str(i), *brute(t, items, 10)) for i, t in ROWS)
    assert decontaminate.contamination(none, b).count() == 0
    assert decontaminate.contaminated(odd, b, name="hit").columns == [*odd.columns, "hit"]
    empty = b.where("false")
    assert {r.n_hit for r in decontaminate.contamination(odd, empty).collect()} == {0}
