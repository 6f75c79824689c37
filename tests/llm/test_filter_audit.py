"""The walk over filter subsets, and the audit, against applying the filters one by one."""

from __future__ import annotations

from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from llm.conftest import ROWS

from ledgerloom.llm import filter_audit as fa


def failing(text: str | None) -> str:
    text = text or ""
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    found = "A" if len(words) < 200 else ""
    found += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    found += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text) else ""
    return found + ("D" if set(text) & set("#$%&*|") else "")


def brute(docs, quality, toxic) -> dict:
    """docs: (doc_id, text, source)."""
    judged = []
    for i, text, source in docs:
        copy = i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in docs)
        judged.append((source or "", failing(text) + "E" * copy, i in quality, i in toxic))
    out = {}
    for part in {p for p, *_ in judged}:
        mine = [x for x in judged if x[0] == part]
        removed_by = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                removed_by[f] += len(gone)
                hits = sum(f in x[1] for x in mine)
                out[part, "".join(order), step] = [
                    len(left), len(gone), hits - len(gone), sum(x[1] == f for x in mine),
                    sum(x[2] for x in gone), sum(x[3] for x in gone), f,
                ]
        for key, v in out.items():
            if key[0] == part:
                v[6] = removed_by[v[6]] if isinstance(v[6], str) else v[6]
    return out


def check(rows, want):
    got = {
        (r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
        for r in rows
    }
    assert got == want and len(rows) == len(want)


LONGER = " ".join(f"w{i}" for i in range(250))
DOCS = [
    (1, LONGER, "x"), (2, LONGER, "y"), (3, "short $", "x"), (4, "A B C", "x"), (5, "w " * 300, "y"),
    (6, "W " * 300 + "#", None), (7, None, ""), (8, "", "x"), (9, LONGER + " A|", "x"), (10, "Aa\tbb" * 150, "y"),
]


def test_against_applying_the_filters(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string").repartition(3)
    labels = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (3, 1, 1), (6, 1, 1), (9, None, 1), (10, 1, None), (None, 1, 1), (99, 1, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    check(fa.audit(docs, labels).collect(), brute(DOCS, {1, 2, 3, 6, 10}, {2, 3, 6, 9}))


def test_odd_rows(spark, odd, none):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(5, 1, 1)], "doc_id long, quality int, toxic int")
    docs = odd.withColumn("source", F.when(F.col("doc_id") < 4, "s"))
    want = brute([(i, t, "s" if i is not None and i < 4 else None) for i, t in ROWS], {5}, {5})
    check(fa.audit(docs, labels).collect(), want)
    assert fa.audit(none.withColumn("source", F.lit("s")), labels).count() == 0
    check(fa.audit(docs, labels.where("false")).collect(), {k: [*v[:4], 0, 0, v[6]] for k, v in want.items()})


@pytest.mark.parametrize("filters", [1, 3, 5])
def test_walk_visits_every_subset(filters):
    rng = np.random.default_rng(filters)
    cells = rng.integers(0, 100, (1 << filters, 3, 4))
    states = fa.surviving(cells, filters)
    for subset in range(1 << filters):
        free = [m for m in range(1 << filters) if not m & subset]
        assert (states[subset] == cells[free].sum(axis=0)).all()


def test_many_parts_go_in_slices(spark, monkeypatch):
    monkeypatch.setattr(fa, "_PARTS_AT_ONCE", 2)
    docs = [(i, f"text {i % 5}", f"s{i % 7}") for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    check(fa.audit(frame, labels).collect(), brute(docs, {3}, set()))
