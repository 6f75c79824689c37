"""Hard negatives by exact integer inner products, several candidates in one multiplication.

Components become integers. Candidates are made non-negative by a bias and several of them are
packed into one wide integer for each component, in fields so wide that no sum can carry into the
next field (Kronecker substitution). One multiplication by an anchor's component then multiplies
all of them; the sums of the products are unpacked and the biases taken away, which gives exact
scores. Fields share 64-bit words where two fit, and else Python's unbounded integers, so there is
no magnitude at which a score is rounded.

Anchors go to the tasks in blocks of at most ``ANCHORS`` rows, and each block passes all candidates
twice: for the best rows of the same label, and for the best rows of other labels inside the band
that each of those sets. A task returns the best of what it read; those are merged per anchor.

Defined results: rows with a null label, a null vector, or a component that is null or not finite
(also after scaling) take no part; vectors of different lengths are compared over the components
that both have; a row without an id comes last in ties and is no anchor; of rows that are the same
in all columns each is a row of its own, and each as an anchor gives the same rows again; a score
beyond 64 bits orders rows exactly and is returned as the nearest long; an anchor without
positives, or a positive without negatives, gives no rows, as does an empty table; extra columns
are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import spool

SCALE = 256
# Anchors in a block, and candidates that are scored together.
ANCHORS = 4096
CANDIDATES = 4096
# Cells of the table of scores that is held at once.
_CELLS = 1 << 20
# Fields of an unbounded integer.
_FIELDS = 8
_LONG = (1 << 63) - 1


@dataclass
class Packed:
    """Biased components of several candidates in fields of wide integers."""

    words: np.ndarray  # component by group of candidates
    fields: int
    width: int
    bias: int
    sums: np.ndarray  # of each candidate's components
    count: int


def as_integers(values: np.ndarray) -> np.ndarray:
    """Floats without fractions as 64-bit integers, or as unbounded ones where some do not fit."""
    if values.size == 0 or np.abs(values).max() < 2.0**62:
        return values.astype(np.int64)
    return np.array([int(v) for v in values.ravel()], object).reshape(values.shape)


def _extent(values: np.ndarray) -> tuple[int, int]:
    """The least value, or 0, and how far up the largest is from it."""
    low = min(0, int(values.min())) if values.size else 0
    return low, (int(values.max()) if values.size else 0) - low


def pack(candidates: np.ndarray, largest_factor: int) -> Packed:
    """``candidates`` (row by component) packed for biased anchors up to ``largest_factor``."""
    count, size = candidates.shape
    low, top = _extent(candidates)
    width = max(1, (size * max(top, 0) * largest_factor).bit_length())
    small = width <= 32 and candidates.dtype != object
    fields, kind = (64 // width, np.uint64) if small else (_FIELDS, object)
    groups = -(-count // fields)
    biased = np.zeros((groups * fields, size), kind)
    biased[:count] = (candidates - low).astype(kind)
    parts = biased.reshape(groups, fields, size)
    words = np.zeros((groups, size), kind)
    for f in range(fields):
        words |= parts[:, f] << (np.uint64(f * width) if small else f * width)
    wide = candidates.astype(object) if candidates.dtype == object or size * (top + abs(low)) >= 2**62 else candidates
    return Packed(np.ascontiguousarray(words.T), fields, width, low, wide.sum(axis=1), count)


def scores(anchors: np.ndarray, packed: Packed) -> np.ndarray:
    """Inner products of all anchors (row by component) and packed candidates. One multiplication
    a component serves all candidates of a word."""
    low, _ = _extent(anchors)
    kind = packed.words.dtype
    biased = (anchors - low).astype(kind)
    total = np.zeros((len(anchors), packed.words.shape[1]), kind)
    for component, word in enumerate(packed.words):
        total += biased[:, component, None] * word
    mask = (1 << packed.width) - 1
    small = kind == np.uint64
    out = np.empty((len(anchors), packed.words.shape[1], packed.fields), np.int64 if small else object)
    for f in range(packed.fields):
        field = (total >> (np.uint64(f * packed.width) if small else f * packed.width)) & (np.uint64(mask) if small else mask)
        out[:, :, f] = field.astype(np.int64) if small else field
    out = out.reshape(len(anchors), -1)[:, :packed.count]
    size = anchors.shape[1]
    exact = object if not small or anchors.dtype == object else np.int64
    own = anchors.astype(exact).sum(axis=1) if size else np.zeros(len(anchors), exact)
    # (a - low)(c - bias) = ac - low c - bias a + low bias, summed over the components.
    return out + low * packed.sums.astype(exact)[None, :] + packed.bias * own[:, None] - size * low * packed.bias


def best(values: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of each row's ``k`` highest allowed values, of equal ones the first."""
    n = values.shape[1]
    if values.dtype == object or (values.size and int(values.max()) - int(values.min()) > _LONG // (2 * n)):
        # Only the order matters from here on.
        values = np.unique(values, return_inverse=True)[1].reshape(values.shape)
    base = int(values.min()) if values.size else 0
    keys = np.where(allowed, (values - base) * n + (n - 1 - np.arange(n)), -1)
    if k < n:
        columns = np.argpartition(keys, n - k, axis=1)[:, n - k:]
    else:
        columns = np.broadcast_to(np.arange(n), keys.shape)
    rows = np.broadcast_to(np.arange(len(keys))[:, None], columns.shape)
    taken = np.take_along_axis(keys, columns, 1) >= 0
    return rows[taken], columns[taken]


def _vectors(rows: list[np.ndarray], size: int) -> np.ndarray:
    """Whole components of several vectors as a matrix, zeros behind shorter ones."""
    out = np.zeros((len(rows), size))
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return as_integers(np.floor(out))


@dataclass
class Block:
    """Some anchors, and for the second pass the scores of each one's positives."""

    ids: list[int]
    labels: np.ndarray
    vectors: list[np.ndarray]
    positives: list[list[int]] | None = None


def _clip(value: int) -> int:
    return max(-_LONG - 1, min(_LONG, int(value)))


def _column(values: list[int], kind: np.dtype) -> np.ndarray:
    return np.array(values if kind == object else [_clip(v) for v in values], kind)[:, None]


def _rank_key(score: int) -> tuple[int, str]:
    """A number and a text that order as the score does, whatever its size."""
    digits = str(abs(score))
    if score >= 0:
        return len(digits), digits
    return -len(digits), "".join(chr(105 - ord(d)) for d in digits)


class Best:
    """The best rows so far of each anchor and slot."""

    def __init__(self, k: int):
        self.k, self.held = k, []

    def add(self, anchor, slot, vec_id, no_id, score) -> None:
        self.held.append((anchor, slot, vec_id, no_id, score))
        if sum(len(h[0]) for h in self.held) > _CELLS:
            self.prune()

    def prune(self) -> None:
        anchor, slot, vec_id, no_id, score = (np.concatenate(c) for c in zip(*self.held))
        place = np.unique(score, return_inverse=True)[1]
        order = np.lexsort((vec_id, no_id, -place, slot, anchor))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(anchor[order]) != 0) | (np.diff(slot[order]) != 0)
        heads = np.flatnonzero(new)
        upto = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
        keep = order[upto < self.k]
        self.held = [tuple(c[keep] for c in (anchor, slot, vec_id, no_id, score))]

    def batch(self) -> pa.RecordBatch | None:
        if not self.held:
            return None
        self.prune()
        anchor, slot, vec_id, no_id, score = self.held[0]
        keys = [_rank_key(int(s)) for s in score]
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor, pa.int32()), pa.array(slot, pa.int32()), pa.array(vec_id, mask=no_id),
             pa.array([a for a, _ in keys], pa.int32()), pa.array([b for _, b in keys], pa.string()),
             pa.array([_clip(s) for s in score], pa.int64())],
            names=["anchor", "slot", "vec_id", "digits", "text", "score"],
        )


_PARTIAL = "anchor int, slot int, vec_id long, digits int, text string, score long"


def _pass(block: Block, k: int, low: int, high: int):
    """The best candidates of every anchor of ``block`` among the rows of a task.

    First pass: ``k`` + 1 of the same label, as the anchor itself is among the rows. Second pass:
    ``k`` of other labels for each positive, from ``low`` to ``high`` per cent of its score.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_rows, waiting = Best(k + 1 if block.positives is None else k), []
        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= CANDIDATES:
                search(pa.Table.from_batches(waiting), best_rows)
                waiting = []
        if waiting:
            search(pa.Table.from_batches(waiting), best_rows)
        found = best_rows.batch()
        if found is not None:
            yield found

    def search(rows: pa.Table, best_rows: Best) -> None:
        if not rows.num_rows:
            return
        # By id, so that of equal scores the first has the smallest id; without one: last.
        rows = rows.sort_by("vec_id")
        vectors = [v.values.to_numpy(zero_copy_only=False) for chunk in rows.column("x").chunks for v in chunk]
        size = max(map(len, [*vectors, *block.vectors]))
        candidates, anchors = _vectors(vectors, size), _vectors(block.vectors, size)
        labels = rows.column("label").to_numpy()
        no_id = rows.column("vec_id").is_null().to_numpy().astype(bool)
        ids = rows.column("vec_id").fill_null(0).to_numpy()
        packed = pack(candidates, _extent(anchors)[1])
        chunk = max(1, _CELLS // len(candidates))
        for start in range(0, len(anchors), chunk):
            some = slice(start, start + chunk)
            found = scores(anchors[some], packed)
            same = block.labels[some, None] == labels
            if block.positives is None:
                picks = [(0, *best(found, same, k + 1))]
            else:
                picks = []
                for slot in range(k):
                    goal = [p[slot] if len(p) > slot else None for p in block.positives[some]]
                    has = np.array([g is not None for g in goal])[:, None]
                    # The band in whole scores: both ends are exact.
                    least = _column([-(-low * (g or 0) // high) for g in goal], found.dtype)
                    most = _column([g or 0 for g in goal], found.dtype)
                    picks.append((slot, *best(found, ~same & has & (found >= least) & (found <= most), k)))
            for slot, at, columns in picks:
                best_rows.add(at + start, np.full(len(at), slot), ids[columns], no_id[columns], found[at, columns])

    return run


def _ranked(partial: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of what the tasks found, per anchor and slot: a few rows from each task."""
    order = Window.partitionBy("anchor", "slot").orderBy(
        F.desc("digits"), F.desc("text"), F.asc_nulls_last("vec_id")
    )
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def prepared(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``label`` and ``x``, the scaled components, of the rows that take part."""
    scaled = F.transform("embedding", lambda v: v.cast("double") * scale)
    usable = F.col("label").isNotNull() & F.forall(
        "x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    )
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), scaled.alias("x")
    ).where(usable)


def mine(
    rows: DataFrame, anchors: Column, k: int = 5, low: int = 80, high: int = 100, block_rows: int = ANCHORS
) -> DataFrame:
    """Hard negatives of the rows for which ``anchors``, a condition on ``vec_id``, holds.

    ``rows``: ``vec_id``, ``label``, ``embedding``. For each anchor and each of its ``k`` best other
    rows of the same label, the ``k`` best rows of other labels with ``low`` * positive score <=
    ``high`` * score <= ``high`` * positive score: ``anchor_id``, ``positive_id``, ``rank``,
    ``negative_id``, ``positive_score``, ``negative_score``.
    """
    table = spool(prepared(rows), "vectors")
    # Numbered within the files, so that a block has a known number of rows.
    chosen = spool(
        table.where(anchors & F.col("vec_id").isNotNull()).select("*", F.monotonically_increasing_id().alias("n")),
        "anchors",
    )
    cut = F.struct(
        F.shiftright("n", 33).alias("part"), F.floor(F.col("n").bitwiseAND((1 << 33) - 1) / block_rows).alias("chunk")
    )
    sizes = chosen.groupBy(cut.alias("cut")).agg(F.count("*").alias("rows"), F.min("n").alias("a"), F.max("n").alias("b"))
    blocks: list[list[tuple[int, int]]] = []
    room = 0
    for r in sorted(sizes.collect(), key=lambda r: r["a"]):
        if r["rows"] > room:
            blocks.append([])
            room = block_rows
        blocks[-1].append((r["a"], r["b"]))
        room -= r["rows"]
    # Numbers are in order, so that a block is everything from its first row to its last.
    mined = [
        _mine_block(table, chosen.where(F.col("n").between(b[0][0], b[-1][1])), k, low, high) for b in blocks
    ]
    if not mined:
        return table.sparkSession.createDataFrame([], _MINED)
    out = mined[0]
    for more in mined[1:]:
        out = out.union(more)
    return out


_MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _mine_block(table: DataFrame, anchors: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """The result for one block of anchors, written."""
    spark = table.sparkSession
    got = anchors.select("vec_id", "label", "x").toArrow()
    vectors = [v.values.to_numpy(zero_copy_only=False) for chunk in got.column("x").chunks for v in chunk]
    block = Block(got.column("vec_id").to_pylist(), got.column("label").to_numpy(), vectors)
    first = _ranked(table.mapInArrow(_pass(block, k, low, high), _PARTIAL), k + 1)
    positives: list[list[tuple[int, int | None]]] = [[] for _ in block.ids]
    for r in first.orderBy("anchor", "rank").collect():
        digits = r["text"] if r["digits"] > 0 else "-" + "".join(chr(105 - ord(d)) for d in r["text"])
        positives[r["anchor"]].append((int(digits), r["vec_id"]))
    for a, found in enumerate(positives):
        own = sum(int(v) ** 2 for v in np.floor(vectors[a]))
        if (own, block.ids[a]) in found:
            found.remove((own, block.ids[a]))
        del found[k:]
    block.positives = [[score for score, _ in found] for found in positives]
    second = _ranked(table.mapInArrow(_pass(block, k, low, high), _PARTIAL), k)
    named = spark.createDataFrame(
        [(a, slot, block.ids[a], vec_id, _clip(score)) for a, found in enumerate(positives)
         for slot, (score, vec_id) in enumerate(found)],
        "anchor int, slot int, anchor_id long, positive_id long, positive_score long",
    )
    return spool(
        second.join(named, ["anchor", "slot"]).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        ),
        "hard-negatives",
    )


ORACLE = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
