"""Chi-square test and the linear model from sums, against formulas and MLlib."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from ledgerloom.functions.pvalues import _upper_gamma_share
from ledgerloom.operators import least_squares
from ledgerloom.plans import contingency


def test_gamma_tail():
    for x in (0.0, 0.3, 1.0, 7.5, 40.0, 300.0):
        assert _upper_gamma_share(1.0, x) == pytest.approx(math.exp(-x), rel=1e-12)
        assert _upper_gamma_share(0.5, x) == pytest.approx(math.erfc(math.sqrt(x)), rel=1e-11)
        assert _upper_gamma_share(4.0, x) == pytest.approx(
            math.exp(-x) * sum(x**k / math.factorial(k) for k in range(4)), rel=1e-11)
    assert _upper_gamma_share(5000.0, 5000.0) == pytest.approx(0.498, abs=1e-3)


def test_chi_square_matches_mllib(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(3), rng.choice([0, 0, 1, 2, 5]), i % 2) for i in range(500)] + [(None, 1, 0), (1, None, 0)]
    df = spark.createDataFrame(rows, "a int, b int, g int").repartition(4)
    vectors = VectorAssembler(inputCols=["b"], outputCol="x").transform(df.dropna())
    want = ChiSquareTest.test(vectors, "x", "a", flatten=True).first()
    got = contingency.chi_square_test(df, "a", "b").first()
    assert got.n == 500 and got.degrees == want.degreesOfFreedom == 6
    assert got.statistic == pytest.approx(want.statistic, abs=1e-4)
    assert got.p_value == pytest.approx(want.pValue, abs=1e-6) and got.decision.startswith("FAIL")
    assert contingency.chi_square_test(df, "a", "b", by=["g"]).count() == 2
    one = contingency.chi_square_test(df.withColumn("b", F.lit(1)), "a", "b").first()
    assert one.degrees == 0 and one.p_value is None and one.decision is None
    assert contingency.chi_square_test(df.where("false"), "a", "b").count() == 0


def test_linear_model_equals_mllib(spark):
    rng = random.Random(3)
    rows = [(rng.gauss(1e6, 5), rng.gauss(0, 1e-3), rng.gauss(0, 1), 7.0) for _ in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, e double, k double").repartition(3)
    df = df.withColumn("y", 2 * F.col("a") - 500 * F.col("b") + 3 + F.col("e"))
    found = least_squares.fit(df, ["a", "b", "k"], "y")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = LinearRegression(labelCol="y").fit(vectors)
    x = np.array([r[:2] for r in rows])
    y = 2 * x[:, 0] - 500 * x[:, 1] + 3 + np.array([r[2] for r in rows])
    exact = np.linalg.lstsq(x - x.mean(axis=0), y - y.mean(), rcond=None)[0]
    assert found.coefficients[:2] == pytest.approx(exact.tolist(), rel=1e-7) and found.coefficients[2] == 0
    # Its normal equations keep fewer digits of so large a mean.
    assert found.coefficients[:2] == pytest.approx(list(model.coefficients), rel=1e-3)
    assert found.r2 == pytest.approx(model.summary.r2, rel=1e-6) and found.n == 400
    scored = found.stage().transform(df).select(F.avg(F.col("prediction") - F.col("y"))).first()[0]
    assert scored == pytest.approx(0, abs=1e-6)


def test_linear_model_of_odd_tables(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 2.0, 4.0), (None, 3.0, 6.0)], "a double, b double, y double")
    found = least_squares.fit(df, ["a", "b"], "y")  # a and b are the same: the shortest solution
    assert np.allclose(found.coefficients, [1.0, 1.0]) and found.n == 2
    with pytest.raises(ValueError, match="complete"):
        least_squares.fit(df.where("y > 9"), ["a"], "y")
    assert least_squares.fit(df, [], "y").intercept == pytest.approx(4.0)
