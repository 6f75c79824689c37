"""Running totals, exact quantiles and exact ranks without a one-task sort.

Spark evaluates an exact percentile in one buffer per group and an unpartitioned window in one
task. Both stop working when a group is large.

Running totals sort the rows into ranges over the whole cluster, in the one shuffle they need, add
up inside each range as its sorted rows pass by, and add the totals of earlier ranges from a table
with one row per range and group.

Quantiles and rank cuts select instead of sorting: a sketch or a sample brackets each wanted position,
one aggregate counts what lies below and at the ends, and what lies between is bracketed again
until it is a short list. No values are shuffled but those lists.

There is one way at every size. What is read more than once is written first, so a task that
runs again cannot shift a boundary.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import spool

# Ship the function that runs in tasks with the job; executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_RANGE = "_range"

# Splitters of a bracket; the rank error of each is n / SKETCH, a twentieth of the way to the next.
GRID = 512
SKETCH = 10_000
# Values of a bracket that are put in order in one place, and rows of a sample.
COLLECTED = 10_000
SAMPLE = 8_192


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    totals: dict[str, str],
    by: Sequence[str] = (),
    group_totals: dict[str, str] | None = None,
    stored: bool = False,
) -> DataFrame:
    """Inclusive running sums in ``order`` within each ``by`` group.

    ``totals`` maps a numeric column without nulls to the name of its running sum,
    ``group_totals`` to the name of the sum over its whole group. The ``order`` columns must be
    unique within a group, and the ``by`` columns free of nulls. ``stored``: ``df`` is a table
    that need not be written before it is read twice.
    """
    by, order = list(by), list(order)
    group_totals = group_totals or {}
    table = df if stored else spool(df, "ordered")
    keys = [*by, *order]
    within = {c: f"_within_{c}" for c in totals}
    ranges = table.repartitionByRange(*keys).sortWithinPartitions(*keys)
    kinds = dict(table.dtypes)
    sums = {c: T.DoubleType() if kinds[c] in ("double", "float") else T.LongType() for c in totals}
    schema = T.StructType([
        *table.schema.fields,
        T.StructField(_RANGE, T.IntegerType()),
        *[T.StructField(name, sums[c]) for c, name in within.items()],
    ])
    summed = spool(
        ranges.withColumn(_RANGE, F.spark_partition_id()).mapInArrow(
            _sums_so_far(by, {c: (name, sums[c] == T.DoubleType()) for c, name in within.items()}), schema
        ),
        "ranges",
    )
    everything = Window.partitionBy(*by)
    earlier = everything.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range and group.
    offsets = (
        summed.groupBy(*by, _RANGE)
        .agg(*[F.sum(c).alias(f"_sum_{c}") for c in {**totals, **group_totals}])
        .select(
            *by,
            _RANGE,
            *[
                F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}")
                for c in totals
            ],
            *[F.sum(f"_sum_{c}").over(everything).alias(n) for c, n in group_totals.items()],
        )
    )
    return summed.join(spool(offsets, "offsets"), [*by, _RANGE]).select(
        *table.columns,
        *[(F.col(f"_before_{c}") + F.col(within[c])).alias(name) for c, name in totals.items()],
        *group_totals.values(),
    )


def _sums_so_far(by: list[str], columns: dict[str, tuple[str, bool]]):
    """Adds to sorted rows, for each of ``columns``, its sum since the task's first row of the
    same group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        carried = dict.fromkeys(columns, 0)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            opens = np.zeros(n, dtype=bool)
            for name in by:
                values = batch.column(name)
                differ = pc.not_equal(values.slice(1), values.slice(0, n - 1))
                opens[1:] |= differ.to_numpy(zero_copy_only=False).astype(bool)
            opens[0] = tuple(batch.column(name)[0].as_py() for name in by) != last
            last = tuple(batch.column(name)[n - 1].as_py() for name in by)
            starts, group = np.flatnonzero(opens), np.cumsum(opens)
            for name, (out, fractions) in columns.items():
                values = batch.column(name).to_numpy(zero_copy_only=False)
                upto = np.cumsum(values.astype(np.float64 if fractions else np.int64))
                before = np.where(starts > 0, upto[starts - 1], 0)
                upto = upto - np.concatenate([[-carried[name]], before])[group]
                carried[name] = upto[-1]
                batch = batch.append_column(out, pa.array(upto))
            yield batch

    return run


def row_numbers(
    df: DataFrame, order: Sequence[str], name: str = "row_number", stored: bool = False
) -> DataFrame:
    """1-based global row number; ``order`` must be unique."""
    ones = df.withColumn("_one", F.lit(1))
    return running_totals(ones, order, {"_one": name}, stored=stored).drop("_one")


def quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = (), stored: bool = False
) -> DataFrame:
    """Exact linearly interpolated quantiles, one row per group.

    Returns the ``by`` columns, ``n`` (values but null and NaN) and ``quantiles`` (array, same order as
    ``probabilities``). Rows with such a value or a null group are ignored; an empty input gives no row.
    ``stored``: ``df`` comes from a table, so that it need not be written before it is read twice.

    A sketch brackets the values around each position, one aggregate counts what lies below a
    bracket and at its ends, and what lies between the ends is bracketed again until it is short.
    """
    by, wanted = list(by), range(len(probabilities))
    keys = by or ["_all"]
    values = df if by else df.withColumn("_all", F.lit(0))
    values = values.select(*keys, F.col(value).cast("double").alias("_v")).dropna(subset=[*keys, "_v"])
    if not stored:
        values = spool(values, "values")
    positions = [(F.col("n") - 1) * F.lit(float(p)) for p in probabilities]

    def narrower(grid: Column, i: int, size: Column, first: Column) -> list[Column]:
        """New ends of bracket ``i``: splitters on either side of the positions wanted, of which
        ``first`` values of the group and the bracket's low end come before the grid."""
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        at, upto = F.floor(positions[i]) - first, F.ceil(positions[i]) - first
        margin = F.ceil(F.lit(2 * GRID) / size) + 1
        below = (F.floor(at * GRID / size) - margin).cast("int")
        above = (F.ceil((upto + 1) * GRID / size) + margin).cast("int")
        new_low = F.when(at >= size, high).when((at < 0) | (below < 0), low).otherwise(F.get(grid, below))
        new_high = F.when(upto < 0, low).when((upto >= size) | (above > GRID), high).otherwise(F.get(grid, above))
        return [new_low.alias(f"_lo{i}"), new_high.alias(f"_hi{i}")]

    def ends(rows: DataFrame) -> DataFrame:
        """Everything: NaN is the largest double there is."""
        return rows.withColumns({
            f"_{side}{i}": F.lit(float(end)) for i in wanted for side, end in (("lo", "-inf"), ("hi", "nan"))
        })

    none = F.lit(0).cast("long")
    # One short row per group, of known size; Spark broadcasts it only if it is small.
    sketch = values.groupBy(*keys).agg(F.count("*").alias("n"), _grid("_v").alias("_grid"))
    brackets = spool(
        ends(sketch).select(
            *keys, "n", *[c for i in wanted for c in narrower(F.col("_grid"), i, F.col("n"), none)]
        ),
        "brackets",
    )
    largest = brackets.agg(F.max("n")).first()[0] or 0
    while largest * 5 / GRID > COLLECTED:
        counted = spool(
            values.join(brackets, keys).groupBy(*keys, *[c for c in brackets.columns if c not in keys]).agg(
                *[c for i in wanted for c in _low_counts(i)],
                *[F.count_if(_between_ends(i)).alias(f"_size{i}") for i in wanted],
                *[_grid(f"CASE WHEN _v > _lo{i} AND _v < _hi{i} THEN _v END").alias(f"_grid{i}") for i in wanted],
            ),
            "brackets",
        )
        left = counted.agg(F.max(F.greatest(F.lit(0), *[F.col(f"_size{i}") for i in wanted]))).first()[0]
        brackets = spool(
            counted.select(
                *keys, "n",
                *[c for i in wanted for c in narrower(
                    F.col(f"_grid{i}"), i, F.col(f"_size{i}"), F.col(f"_below{i}") + F.col(f"_low{i}")
                )],
            ),
            "brackets",
        )
        largest = left
    found = values.join(brackets, keys).groupBy(*keys, *[c for c in brackets.columns if c not in keys]).agg(
        *[c for i in wanted for c in _low_counts(i)],
        *[F.sort_array(F.collect_list(F.when(_between_ends(i), F.col("_v")))).alias(f"_inside{i}") for i in wanted],
    )

    def value_at(i: int, index: Column) -> Column:
        """Value in the 0-based sorted position ``index``."""
        inside = F.col(f"_inside{i}")
        at = (index - F.col(f"_below{i}") - F.col(f"_low{i}")).cast("int")
        return (
            F.when(index < F.col(f"_below{i}"), F.raise_error(F.lit("a position lies before its bracket")))
            .when(at < 0, F.col(f"_lo{i}")).when(at < F.size(inside), F.get(inside, at)).otherwise(F.col(f"_hi{i}"))
        )

    return found.select(
        *by,
        "n",
        F.array(*[
            _between(value_at(i, F.floor(p)), value_at(i, F.ceil(p)), p) for i, p in enumerate(positions)
        ]).alias("quantiles"),
    )


def _grid(value: str) -> Column:
    """``GRID`` + 1 evenly spaced splitters of a column, within n / SKETCH of their ranks."""
    shares = ", ".join(f"{i / GRID!r}D" for i in range(GRID + 1))
    return F.expr(f"percentile_approx({value}, array({shares}), {SKETCH})")


def _between_ends(i: int) -> Column:
    return (F.col("_v") > F.col(f"_lo{i}")) & (F.col("_v") < F.col(f"_hi{i}"))


def _low_counts(i: int) -> list[Column]:
    low = F.col(f"_lo{i}")
    return [F.count_if(F.col("_v") < low).alias(f"_below{i}"), F.count_if(F.col("_v") == low).alias(f"_low{i}")]


def _between(low: Column, high: Column, position: Column) -> Column:
    """Linear interpolation anchored at the nearer end, so equal ends give exactly that value."""
    part = position - F.floor(position)
    gap = high - low
    return F.when(low == high, low).when(part < 0.5, low + gap * part).otherwise(high - gap * (1 - part))


def quantile_values(df: DataFrame, value: str, probabilities: Sequence[float]) -> list[float]:
    """The quantiles as Python numbers (as many as were asked for)."""
    row = quantiles(df, value, probabilities).first()
    return list(row["quantiles"]) if row else []


def first_rank_cuts(df: DataFrame, order: Sequence[str], buckets: int = 4) -> list[tuple]:
    """Sort keys of the last row of every equal-rank bucket but the last, of a stored table.

    With ranks 1..n, the bucket edges are the linearly interpolated quantiles of those ranks;
    a row belongs behind an edge when its sort key lies after the returned key. ``order`` names
    two columns: a count, and what orders rows of equal counts. A table in which the counts add up
    to N has at most the square root of 2 N different ones, so they come to the driver; of
    the second column only samples and the last values to choose from do.
    """
    count, key = order
    sizes = sorted((r[0], r[1]) for r in df.groupBy(count).agg(F.count("*")).collect())
    n = sum(size for _, size in sizes)
    targets = []
    for rank in [int(1 + (n - 1) * k / buckets) for k in range(1, buckets)]:
        before = 0
        for value, size in sizes:
            if before < rank <= before + size:
                targets.append(_Place(value, rank - 1 - before, size))
            before += size
    return [(t.group, t.found) for t in _select_keys(df, count, key, targets)]


@dataclass
class _Place:
    """A 0-based position among the keys of a group, and what is known of where its key lies:
    strictly between ``low`` and ``high`` (None: no end), among ``size`` rows."""

    group: object
    position: int
    size: int
    low: object = None
    high: object = None
    found: object = None
    done: bool = False

    def rows(self, group: str, key: str) -> Column:
        inside = F.col(group) == F.lit(self.group)
        if self.low is not None:
            inside &= F.col(key) > F.lit(self.low)
        if self.high is not None:
            inside &= F.col(key) < F.lit(self.high)
        return inside


def _select_keys(df: DataFrame, group: str, key: str, places: list[_Place]) -> list[_Place]:
    """Finds the key at each place. In every round a sample brackets the positions, one aggregate
    counts the rows below, at and between the ends, and the rows between go on to the next round,
    or to the driver when they are few. A sample that misses only costs a round."""
    while going := [p for p in places if not p.done]:
        draw = F.rand(17)
        chosen = [
            F.when(p.rows(group, key) & (draw < min(0.25, SAMPLE / p.size)), F.col(key)) for p in going
        ]
        drawn = df.select(*[c.alias(f"k{i}") for i, c in enumerate(chosen)])
        drawn = drawn.where(F.coalesce(*drawn.columns).isNotNull()).collect()
        asked, ends = [], []
        for i, p in enumerate(going):
            keys = sorted(r[i] for r in drawn if r[i] is not None)
            middle, margin = p.position / p.size * len(keys), 1.5 * len(keys) ** 0.5 + 1
            a, b = int(middle - margin), int(middle + margin) + 1
            low = keys[a] if middle >= margin and keys else p.low
            high = keys[b] if b < len(keys) else p.high
            ends.append((low, high))
            inner = _Place(p.group, 0, 0, low, high).rows(group, key)
            # NULL where there is no end: then nothing lies beyond it.
            new_low, new_high = low is not None and low != p.low, high is not None and high != p.high
            mine, k = p.rows(group, key), F.col(key)
            short = (b - a) / max(1, len(keys)) * p.size <= COLLECTED or not keys
            asked += [
                F.count_if(mine & (k < F.lit(low))) if new_low else F.lit(0),
                F.count_if(mine & (k == F.lit(low))) if new_low else F.lit(0),
                F.count_if(inner),
                F.count_if(mine & (k == F.lit(high))) if new_high else F.lit(0),
                F.collect_list(F.when(inner, k)) if short else F.lit(None),
            ]
        answer = df.agg(*[c.alias(f"a{j}") for j, c in enumerate(asked)]).first()
        for i, p in enumerate(going):
            low, high = ends[i]
            below, at_low, between, at_high, inside = answer[5 * i:5 * i + 5]
            at = p.position - below
            if at < 0:
                p.high, p.size = low, below
            elif at < at_low:
                p.found, p.done = low, True
            elif at < at_low + between:
                at -= at_low
                if inside is not None:
                    p.found, p.done = sorted(inside)[at], True
                p.low, p.high, p.position, p.size = low, high, at, between
            elif at < at_low + between + at_high:
                p.found, p.done = high, True
            else:
                passed = below + at_low + between + at_high
                p.low, p.position, p.size = high, p.position - passed, p.size - passed
    return places


def after_key(order: Sequence[str], key: Sequence) -> Column:
    """Row sorts strictly after ``key`` (lexicographic)."""
    condition = F.lit(False)
    for column, bound in reversed(list(zip(order, key))):
        c = F.col(column)
        condition = (c > F.lit(bound)) | ((c == F.lit(bound)) & condition)
    return condition


def quantile_score(value: str, edges: Sequence[float], best_low: bool = False) -> Column:
    """Score 1..n from the inner quantile ``edges``; intervals are closed on the right.

    ``best_low`` reverses the scale, so that small values (recent customers) score highest.
    """
    passed = F.lit(1)
    for edge in edges:
        passed = passed + (F.col(value) > F.lit(edge)).cast("int")
    return F.lit(len(edges) + 2) - passed if best_low else passed


def first_rank_score(order: Sequence[str], cuts: Sequence[tuple]) -> Column:
    """Score 1..n by rank, ties broken by the later ``order`` columns."""
    passed = F.lit(1)
    for key in cuts:
        passed = passed + after_key(order, key).cast("int")
    return passed
