"""The batched sweep against plain numpy and MLlib."""

from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerloom.operators import kmeans


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(1)
    middles = [(0, 0), (6, 0), (0, 6), (7, 8), (-5, 4)]
    rows = [tuple(rng.gauss(m, 1.0) for m in middles[rng.randrange(5)]) for _ in range(900)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    return df.withColumn(kmeans.KEY, F.xxhash64("a", "b")).cache()


def test_no_worse_than_mllib(points):
    """Best of ten starts for each k; silhouettes of the same clusters agree."""
    found = kmeans.sweep(points, ["a", "b"], range(2, 7), 10)
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(points)
    for k, start in found.best.items():
        fits = [KMeans(k=k, seed=s, maxIter=300).fit(vectors) for s in range(3)]
        assert start.cost <= min(m.summary.trainingCost for m in fits) * 1.001
        nearest = F.expr(kmeans.nearest_sql(["a", "b"], start.centres.tolist()))
        clustered = vectors.withColumn("prediction", nearest)
        assert found.silhouettes[k] == pytest.approx(ClusteringEvaluator().evaluate(clustered), abs=1e-9)
    assert max(found.silhouettes, key=found.silhouettes.get) == 5


def test_passes_are_those_of_the_slowest_start(points):
    """Drawing the centres takes one pass a centre; then one pass an iteration of all starts."""
    found = kmeans.sweep(points, ["a", "b"], [2, 4], 6)
    slowest = found.passes - 4 - 2
    assert slowest >= max(s.passes for s in found.best.values())
    assert found.passes < 60


def test_sums_of_a_pass_and_its_result_do_not_depend_on_partitions(points):
    one = kmeans.sweep(points, ["a", "b"], [3], 4)
    two = kmeans.sweep(points.repartition(2), ["a", "b"], [3], 4)
    assert np.allclose(one.best[3].centres, two.best[3].centres) and one.best[3].cost == pytest.approx(two.best[3].cost)


def test_fewer_rows_than_clusters(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (4.0,)], "a double").withColumn(kmeans.KEY, F.monotonically_increasing_id())
    start = kmeans.sweep(df, ["a"], [3], 2).best[3]
    assert sorted(start.centres.ravel().tolist()) == [1.0, 4.0] and start.cost == 0
    assert kmeans.sweep(df.where("false"), ["a"], [2], 2).best == {}


def test_distances_and_nearest(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, 0.0), (None, 1.0)], "a double, b double")
    centres = [[0.0, 0.0], [2.0, 2.0], [2.0, 2.0]]
    near = F.expr(kmeans.nearest_sql(["a", "b"], centres))
    far = kmeans.squared_distances([F.col("a"), F.col("b")], centres)
    rows = df.select(near.alias("n"), far.alias("d")).collect()
    assert [r.n for r in rows] == [1, 0, None] and rows[0].d == [5.0, 1.0, 1.0]


def test_draws_follow_the_distances():
    keys = np.random.default_rng(0).integers(-2**62, 2**62, 20_000)
    u = kmeans._uniform(keys, 3, 1)
    assert 0 < u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01
    assert abs(np.corrcoef(u, kmeans._uniform(keys, 4, 1))[0, 1]) < 0.03


def _packed(rows):
    batch = pa.RecordBatch.from_arrays(
        [*map(pa.array, rows.T), pa.array(np.arange(len(rows)))], names=["a", "b", "c", kmeans.KEY]
    )
    return list(kmeans._packed(["a", "b", "c"])(iter([batch])))


def _plainly(rows, centres):
    """Row by centre, start by start: sizes, sums of squares, costs and sums."""
    every, found = np.concatenate(centres), []
    distances = sum((rows[:, j, None] - every[:, j]) ** 2 for j in range(rows.shape[1]))
    for a, b in kmeans._bounds(map(len, centres)):
        near = np.argmin(distances[:, a:b], axis=1)
        parts = [None, (rows * rows).sum(axis=1), distances[np.arange(len(rows)), a + near], *rows.T]
        found.append(np.column_stack([np.bincount(near, p, b - a) for p in parts]))
    return np.concatenate(found)


def _starts(rows, rng):
    return [rows[rng.choice(len(rows), k, replace=False)] for k in rng.permutation(list(range(2, 9)) * 10)]


@pytest.mark.parametrize("kind", ["continuous", "whole numbers", "twice the same centre"])
def test_sums_of_a_pass_equal_plain_ones(kind):
    """Whole numbers make many rows equally near to two centres: the first counts."""
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(5000, 3)) * [1, 3, 50] + [0, 0, 900]
    rows = rows.round() if kind == "whole numbers" else rows
    centres = _starts(rows, rng)
    if kind == "twice the same centre":
        centres = [np.vstack([c, c[:1]]) for c in centres]
    plain = _plainly(rows, centres)
    for costs in (False, True):
        (out,) = kmeans._assign(["a", "b", "c"], centres, costs)(iter(_packed(rows)))
        total = np.zeros_like(plain)
        total[out.column(0).to_numpy()] = np.column_stack([c.to_numpy() for c in out.columns[1:]])
        assert (total[:, 0] == plain[:, 0]).all()
        assert np.allclose(total[:, [1, 3, 4, 5]], plain[:, [1, 3, 4, 5]], rtol=1e-9, atol=1e-6)
        assert np.allclose(total[:, 2], plain[:, 2] if costs else 0)


def test_a_pass_is_much_faster_than_start_by_start():
    """A sweep's time is that of its passes; the plain way took 20 microseconds a row with 350 centres."""
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(16_384, 3))
    centres, blocks = _starts(rows, rng), _packed(rows)

    def seconds(run):
        began = time.process_time()
        run()
        return time.process_time() - began

    plain = min(seconds(lambda: [_plainly(rows[i:i + 4096], centres) for i in range(0, len(rows), 4096)]) for _ in range(3))
    fast = min(seconds(lambda: list(kmeans._assign(["a", "b", "c"], centres, False)(iter(blocks)))) for _ in range(3))
    assert fast < plain / 2
