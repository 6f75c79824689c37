"""k-means for several numbers of clusters and several starts, all in one pass per iteration.

Every pass sends the centres of all starts that still move to the tasks; each task adds up, for every
centre, the rows nearest to it, and the sums meet in one short aggregate. The rows are kept as blocks
of numbers. A task takes short runs of them against all starts of one number of clusters at once;
distances and sums are products of matrices. A sweep takes as many passes as its slowest start,
whatever the number of starts. The centres of all starts are ``sum(ks) * restarts`` rows, which bounds
what is sent and what comes back.

Starts are seeded by distance: each further centre is a row drawn in proportion to its squared
distance to the nearest centre so far. The draw is the row with the largest ``log(u) / distance``,
where ``u`` is a hash of the row's key, the start and the step: a maximum, so it needs no second look
at the rows, and a task that runs again draws the same.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ship the functions that run in tasks with the job; executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY = "_key"
_NUMBERS = "_numbers"
# Rows of a block.
_BLOCK = 4096
# Rows of an assignment that are worked on together: few enough for a processor's cache.
_ROWS = 1024
# What a distance from a product of matrices may be off by, as a share of the squares that go into
# it; rounding of doubles stays far below.
_ROUNDING = 1e-12


@dataclass
class Start:
    """One run of the algorithm: its number of clusters, and the state it has reached."""

    k: int
    number: int
    centres: np.ndarray  # cluster by measure
    sizes: np.ndarray | None = None
    sums: np.ndarray | None = None
    norms: np.ndarray | None = None
    cost: float = float("inf")
    before: np.ndarray | None = None  # centres before the last step
    passes: int = 0
    moving: bool = True


@dataclass
class Sweep:
    best: dict[int, Start]
    silhouettes: dict[int, float]
    passes: int


def _packed(columns: list[str]):
    """The rows in blocks: a row of the result holds the numbers of some thousand rows as bytes,
    so that a pass need not hand rows to Python one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, _BLOCK):
                rows = batch.slice(i, _BLOCK)
                numbers = np.stack([rows.column(c).to_numpy(zero_copy_only=False) for c in columns])
                values = [numbers.astype(np.float64).tobytes(), rows.column(KEY).to_numpy().tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], names=[_NUMBERS, KEY])

    return run


def _blocks(batches: Iterator[pa.RecordBatch], measures: int) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Per block its numbers, measure by row, and its keys where they were asked for."""
    for batch in batches:
        for i in range(batch.num_rows):
            x = np.frombuffer(batch.column(_NUMBERS)[i].as_buffer()).reshape(measures, -1)
            yield x, np.frombuffer(batch.column(KEY)[i].as_buffer(), np.int64) if KEY in batch.schema.names else None


def _groups(centres: list[np.ndarray]) -> list[tuple[list[int], np.ndarray]]:
    """Starts with equally many centres together: which they are, and their centres, cluster by
    start by measure."""
    alike: dict[int, list[int]] = {}
    for i, c in enumerate(centres):
        alike.setdefault(len(c), []).append(i)
    return [(which, np.stack([centres[i] for i in which], axis=1)) for which in alike.values()]


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, cluster by start by row. The rows come last, so that every step runs
    along memory, over all starts of a group at once."""
    out = np.zeros((*centres.shape[:2], rows.shape[1]))
    part = np.empty_like(out)
    for j, values in enumerate(rows):
        np.subtract(values, centres[:, :, j, None], out=part)
        out += np.square(part, out=part)
    return out


def _nearest(rows: np.ndarray, parts: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """A one for each row's nearest centre, the first of equally near ones, and zeros for the others.

    A product of matrices gives the distances to within a rounding error. Where two centres are
    nearer to each other than that, the distances are worked out as differences.
    """
    norms = (centres * centres).sum(axis=2)
    factors = np.stack([norms, np.ones_like(norms), *np.moveaxis(-2 * centres, 2, 0)], axis=2)
    about = (factors.reshape(-1, len(parts)) @ parts).reshape(*norms.shape, -1)
    near = about <= about.min(axis=0) + _ROUNDING * (norms.max() + parts[1].max())
    if np.count_nonzero(near) != about[0].size:
        near = np.argmin(_distances(rows, centres), axis=0) == np.arange(len(centres))[:, None, None]
    return near.astype(np.float64)


def _bounds(sizes: Iterable[int]) -> list[tuple[int, int]]:
    ends = np.cumsum([0, *sizes]).tolist()
    return list(zip(ends, ends[1:]))


def _uniform(keys: np.ndarray, number: int, step: int) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit keys, other ones for each start and step."""
    salt = (number * 0x9E3779B97F4A7C15 + step * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF
    x = keys.view(np.uint64) + np.uint64(salt)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _draw(columns: list[str], centres: list[np.ndarray], numbers: list[int], step: int):
    """The best row of a task for each start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full(len(centres), -np.inf)
        rows = np.zeros((len(centres), len(columns)))
        groups = _groups(centres)
        for x, keys in _blocks(batches, len(columns)):
            for which, points in groups:
                weights = _distances(x, points).min(axis=0) if step else np.ones((len(which), len(keys)))
                for i, weight in zip(which, weights):
                    with np.errstate(divide="ignore"):
                        rank = np.where(weight > 0, np.log(_uniform(keys, numbers[i], step)) / weight, -np.inf)
                    top = int(np.argmax(rank))
                    if rank[top] > best[i]:
                        best[i], rows[i] = rank[top], x[:, top]
        found = np.flatnonzero(best > -np.inf)
        if len(found):
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), pa.array(best[found]), *[pa.array(rows[found, j]) for j in range(len(columns))]],
                names=["start", "rank", *columns],
            )

    return run


def _assign(columns: list[str], centres: list[np.ndarray], in_order: bool):
    """For every centre of every start, what a task has nearest to it. ``in_order`` adds up row after
    row, which takes longer: equal clusters then have equal sums to the last bit, whichever start
    they are of, and the sums of distances are there, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _groups(centres)
        sums = [np.zeros((len(columns) + 3, *points.shape[:2])) for _, points in groups]
        for block, _ in _blocks(batches, len(columns)):
            rows = block.shape[1] if in_order else _ROWS
            for x in (block[:, i:i + rows] for i in range(0, block.shape[1], rows)):
                parts = np.stack([np.ones(x.shape[1]), (x * x).sum(axis=0), *x])
                for (which, points), of in zip(groups, sums):
                    if in_order:
                        distances = _distances(x, points)
                        near, least = np.argmin(distances, axis=0), distances.min(axis=0)
                        for place in range(len(which)):
                            for j, part in enumerate([*parts[:2], least[place], *x]):
                                of[j, :, place] += np.bincount(near[place], part, len(points))
                    else:
                        near = _nearest(x, parts, points)
                        found = (parts @ near.reshape(-1, x.shape[1]).T).reshape(-1, *points.shape[:2])
                        of[:2] += found[:2]
                        of[3:] += found[2:]
        bounds = _bounds(map(len, centres))
        total = np.zeros((bounds[-1][1], len(columns) + 3))
        for (which, _), of in zip(groups, sums):
            for place, i in enumerate(which):
                total[slice(*bounds[i])] = of[:, :, place].T
        seen = np.flatnonzero(total[:, 0])
        if len(seen):
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen, pa.int32()), *[pa.array(total[seen, j]) for j in range(total.shape[1])]],
                names=["centre", "_n", "_norm", "_cost", *columns],
            )

    return run


def _silhouettes(columns: list[str], starts: list[Start]):
    """Sums of the simplified silhouette of a task's rows, by squared distances: the mean squared
    distance to a cluster follows from its size, sum and sum of squares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(starts))
        for x, _ in _blocks(batches, len(columns)):
            norms, at = (x * x).sum(axis=0), np.arange(x.shape[1])
            for i, s in enumerate(starts):
                near = np.argmin(_distances(x, s.centres[:, None])[:, 0], axis=0)
                full = s.sizes > 0
                n = np.where(full, s.sizes, 1.0)
                mean = norms[:, None] + s.norms / n - 2 * (x.T @ (s.sums / n[:, None]).T)
                mean[:, ~full] = np.inf
                own = mean[at, near] * s.sizes[near] / np.maximum(s.sizes[near] - 1, 1)
                mean[at, near] = np.inf
                other = mean.min(axis=1)
                alone = (s.sizes[near] <= 1) | ~np.isfinite(other)
                most = np.maximum(own, other)
                with np.errstate(invalid="ignore"):
                    sums[i] += np.where(alone | (most <= 0), 0.0, (other - own) / most).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(starts)), pa.int32()), pa.array(sums)], names=["start", "total"])

    return run


def sweep(
    points: DataFrame, columns: Sequence[str], ks: Iterable[int], restarts: int, seed: int = 42,
    max_iterations: int = 300, tolerance: float = 1e-4,
) -> Sweep:
    """The best of ``restarts`` starts for each of ``ks``, and its mean silhouette.

    ``points``: numeric ``columns`` and a 64-bit ``KEY`` that tells rows apart, read once and kept in
    blocks; a stored table, so that a task that runs again finds the same rows. A start has ended
    when none of its centres moves farther than ``tolerance``. A start that runs out of different
    rows has fewer clusters; a cluster that loses all its rows keeps its centre.
    """
    columns = list(columns)
    # Blocks that get lost are made again from ``points``.
    blocks = points.mapInArrow(_packed(columns), f"{_NUMBERS} binary, {KEY} binary").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _sweep(blocks, columns, ks, restarts, seed, max_iterations, tolerance)
    finally:
        blocks.unpersist()


def _sweep(
    blocks: DataFrame, columns: list[str], ks: Iterable[int], restarts: int, seed: int, max_iterations: int, tolerance: float
) -> Sweep:
    numbers = ", ".join(f"{c} double" for c in columns)
    values = blocks.select(_NUMBERS)
    starts = [
        Start(k, seed * 1_000_003 + k * 1009 + r, np.zeros((0, len(columns)))) for k in ks for r in range(restarts)
    ]
    passes = 0
    for step in range(max((s.k for s in starts), default=0)):
        growing = [s for s in starts if s.k > step == len(s.centres)]
        drawn = blocks.mapInArrow(
            _draw(columns, [s.centres for s in growing], [s.number for s in growing], step),
            f"start int, rank double, {numbers}",
        )
        passes += 1
        for r in drawn.groupBy("start").agg(F.max(F.struct("rank", *columns)).alias("top")).collect():
            s = growing[r["start"]]
            s.centres = np.vstack([s.centres, [r["top"][c] for c in columns]])

    def totals(of: list[Start], in_order: bool) -> None:
        found = values.mapInArrow(
            _assign(columns, [s.centres for s in of], in_order), f"centre int, _n double, _norm double, _cost double, {numbers}"
        )
        rows = found.groupBy("centre").agg(*[F.sum(c).alias(c) for c in found.columns[1:]]).collect()
        table = np.zeros((sum(len(s.centres) for s in of), len(columns) + 3))
        for r in rows:
            table[r["centre"]] = r[1:]
        for s, (a, b) in zip(of, _bounds(len(s.centres) for s in of)):
            s.sizes, s.norms, s.sums = table[a:b, 0], table[a:b, 1], table[a:b, 3:]
            s.cost = float(table[a:b, 2].sum())

    def step(of: list[Start], in_order: bool) -> None:
        """Each centre to the middle of its rows."""
        totals(of, in_order)
        for s in of:
            full = s.sizes > 0
            new = s.centres.copy()
            new[full] = s.sums[full] / s.sizes[full, None]
            s.before, s.centres = s.centres, new

    moving = [s for s in starts if len(s.centres)]
    for _ in range(max_iterations):
        if not moving:
            break
        step(moving, in_order=False)
        passes += 1
        for s in moving:
            s.passes += 1
            s.moving = bool((((s.centres - s.before) ** 2).sum(axis=1) > tolerance**2).any())
        moving = [s for s in moving if s.moving]
    ready = [s for s in starts if len(s.centres)]
    if not ready:
        return Sweep({}, {}, passes)
    # The last step again, in order: starts that end in the same clusters then differ by nothing but
    # the order of their clusters.
    if again := [s for s in ready if s.before is not None]:
        for s in again:
            s.centres = s.before
        step(again, in_order=True)
        passes += 1
    # Costs are those after the last step.
    totals(ready, in_order=True)
    best = {}
    for s in ready:
        if s.k not in best or s.cost < best[s.k].cost:
            best[s.k] = s
    chosen = list(best.values())
    sums = values.mapInArrow(_silhouettes(columns, chosen), "start int, total double")
    found = {r["start"]: r["total"] for r in sums.groupBy("start").agg(F.sum("total").alias("total")).collect()}
    silhouettes = {s.k: found.get(i, 0.0) / s.sizes.sum() for i, s in enumerate(chosen)}
    return Sweep(best, silhouettes, passes + 2)


def squared_distances(values: Sequence[Column], centres: Sequence[Sequence[float]]) -> Column:
    """The squared distances of a row's ``values`` to each of ``centres``, as an array."""
    each = []
    for centre in centres:
        total = F.lit(0.0)
        for value, at in zip(values, centre):
            total = total + (value - F.lit(float(at))) * (value - F.lit(float(at)))
        each.append(total)
    return F.array(*each)


def nearest_sql(values: Sequence[str], centres: Sequence[Sequence[float]]) -> str:
    """SQL for the number, from 0, of the nearest of ``centres``, the first of equally near ones;
    null if a value is."""
    each = [
        " + ".join(f"power({value} - ({float(at)!r}D), 2)" for value, at in zip(values, centre)) for centre in centres
    ]
    distances = f"array({', '.join(each)})"
    return f"CAST(array_position({distances}, array_min({distances})) - 1 AS INT)"
