"""How filters interact: what each removes, repeats or alone would catch, in every order.

Each document is reduced to a mask of the filters it fails, and the masks are counted per part,
so a part has at most ``2 ** n`` cells whatever its size. The survivors of every subset of filters
then come from one walk through the subsets in Gray-code order: each step toggles one filter, which
changes the active-failure counter of the cells that fail it, and a cell leaves the running
survivors when its counter leaves zero and returns when it comes back to it. Each step of each
order is a difference of two stored states.

Defined results: a null text is empty; an empty text has no words, so it fails A only (and E as a
copy); copies are told by the SHA-256 digest of the whole text, whatever its length; a row without
an id is no copy and makes none; rows of one id are no copies of each other, and each counts;
several label rows of an id count as one that is positive if any is; a null source is the part of
the empty string; an empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import spool

FILTERS = "ABCDE"
MEASURES = ("n", "good", "toxic")
# Parts whose rows are made together.
_PARTS_AT_ONCE = 64
_WHITE = r"[\x20\x09-\x0D]+"


def own_failures(text: Column) -> dict[str, Column]:
    """The conditions A to D of a text without nulls."""
    words = F.array_remove(F.split(text, _WHITE), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals.cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask`` (bit i: fails filter i), ``n``, ``good`` and ``toxic``: the cells that
    occur. ``docs`` has ``doc_id``, ``text``, ``source``; ``labels`` has ``doc_id``, ``quality``,
    ``toxic``."""
    text = F.coalesce("text", F.lit(""))
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(own_failures(F.col("text")).values())]
    read = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    marked = spool(
        read.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), sum(bits[1:], bits[0]).alias("own")),
        "marked",
    )
    # Only texts that occur again have a row here. Written, so that a large group can be split.
    firsts = spool(
        marked.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("times"))
        .where("times > 1").select("digest", "first"),
        "first-copies",
    )
    known = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    known = known.where("doc_id is not null")
    copy = F.when(F.col("doc_id") > F.col("first"), 16).otherwise(0)
    return (
        marked.join(firsts, "digest", "left").select("doc_id", "part", (F.col("own") + copy).alias("mask"))
        .join(known, "doc_id", "left").groupBy("part", "mask").agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
            F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
        )
    )


def surviving(cells: np.ndarray, filters: int) -> np.ndarray:
    """What is left under every subset of filters: ``cells`` has the amounts by failure mask in its
    first axis, and so has the result by subset."""
    failing = [np.flatnonzero(np.arange(1 << filters) >> f & 1) for f in range(filters)]
    active = np.zeros(1 << filters, np.int64)
    states = np.empty_like(cells)
    running = cells.sum(axis=0)
    subset = 0
    states[subset] = running
    for step in range(1, 1 << filters):
        toggled = (step & -step).bit_length() - 1
        subset ^= 1 << toggled
        mine = failing[toggled]
        if subset >> toggled & 1:
            running = running - cells[mine[active[mine] == 0]].sum(axis=0)
            active[mine] += 1
        else:
            active[mine] -= 1
            running = running + cells[mine[active[mine] == 0]].sum(axis=0)
        states[subset] = running
    return states


def step_counts(states: np.ndarray, filters: int) -> dict[str, np.ndarray]:
    """Each measure for all orders, steps (axes 0 and 1) and parts, from states with the
    amounts ``MEASURES`` in the second axis and parts in the third."""
    orders = np.array(list(permutations(range(filters))))
    upto = np.cumsum(1 << orders, axis=1)
    before = upto - (1 << orders)
    gone = states[before] - states[upto]
    alone, none, all_filters = 1 << np.arange(filters), 0, (1 << filters) - 1
    failing = states[none, 0] - states[alone, 0]
    unique = states[all_filters ^ alone, 0] - states[all_filters, 0]
    removed = gone[:, :, 0]
    total = np.zeros_like(failing)
    np.add.at(total, orders, removed)
    return {
        "kept": states[upto, 0], "removed": removed, "redundant": failing[orders] - removed,
        "unique_fails": unique[orders], "good_lost": gone[:, :, 1], "toxic_lost": gone[:, :, 2],
        "shapley": total[orders],
    }


def _walk(names: str):
    counts = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    filters, rows = len(names), factorial(len(names)) * len(names)
    orders = ["".join(p) for p in permutations(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, _PARTS_AT_ONCE):
                batch = whole.slice(i, _PARTS_AT_ONCE)
                parts = batch.num_rows
                cells = np.zeros((1 << filters, len(MEASURES), parts), np.int64)
                for p, entries in enumerate(batch.column("cells").to_pylist()):
                    for e in entries:
                        cells[e["mask"], :, p] = [e[m] for m in MEASURES]
                found = step_counts(surviving(cells, filters), filters)
                # Rows by part, order and step.
                columns = [
                    pa.array(np.repeat(np.array(batch.column("part").to_pylist(), object), rows), pa.string()),
                    pa.array(np.tile(np.repeat(np.array(orders, object), filters), parts), pa.string()),
                    pa.array(np.tile(np.arange(1, filters + 1, dtype=np.int32), len(orders) * parts)),
                    *[pa.array(np.moveaxis(found[c], 2, 0).ravel()) for c in counts],
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *counts])

    return run


def audit_cells(cells: DataFrame, names: Sequence[str] = FILTERS) -> DataFrame:
    """One row per part, order of ``names`` and step from the cells of ``failure_masks``."""
    per_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))
    return per_part.mapInArrow(
        _walk("".join(names)),
        "part string, filter_order string, step int, kept long, removed long, redundant long, "
        "unique_fails long, good_lost long, toxic_lost long, shapley long",
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters applied to ``docs`` in every order, per part."""
    return audit_cells(failure_masks(docs, labels))


ORACLE = r"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), failing AS (
    SELECT doc_id, part,
           CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
    FROM texts
), judged AS (
    SELECT part, fails, count(*) AS n,
           count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) AS good,
           count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS toxic
    FROM failing GROUP BY part, fails
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE b.f <> a.f AND c.f NOT IN (a.f, b.f) AND d.f NOT IN (a.f, b.f, c.f) AND e.f NOT IN (a.f, b.f, c.f, d.f)
), steps AS (
    SELECT filter_order, s.step, substr(filter_order, s.step, 1) AS f, substr(filter_order, 1, s.step - 1) AS earlier
    FROM orders, (SELECT unnest(range(1, 6)) AS step) s
), placed AS (
    SELECT part, filter_order, step, f, n, good, toxic, fails,
           contains(fails, f) AS hit, length(translate(fails, earlier, '')) < length(fails) AS gone
    FROM steps, judged
), counted AS (
    SELECT part, filter_order, step, f,
           coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS kept,
           coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS removed,
           coalesce(sum(n) FILTER (gone AND hit), 0) AS redundant,
           coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails,
           coalesce(sum(good) FILTER (NOT gone AND hit), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (NOT gone AND hit), 0) AS toxic_lost
    FROM placed GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""
