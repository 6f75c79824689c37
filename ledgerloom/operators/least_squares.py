"""A linear model from sufficient statistics: one aggregate over the rows, then a small solve.

Means and covariances are Spark's own aggregates, which are summed on the map side and stay exact
to a few digits however large the values; what reaches the driver is one row of p² numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class LinearFit:
    """Coefficients by input, intercept, and the share of the variance that they explain."""

    inputs: list[str]
    coefficients: list[float]
    intercept: float
    r2: float | None
    n: int

    def stage(self, name: str = "prediction") -> SQLTransformer:
        """The model as a pipeline stage."""
        terms = " + ".join(f"({w!r}D) * CAST({c} AS DOUBLE)" for c, w in zip(self.inputs, self.coefficients))
        rule = f"({self.intercept!r}D)" + (f" + {terms}" if terms else "")
        return SQLTransformer(statement=f"SELECT *, {rule} AS {name} FROM __THIS__")


def covariances(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``n``, the mean of every column (``mean_<i>``) and the population covariance of
    every pair (``cov_<i>_<j>``), over the rows that have all columns."""
    values = [F.col(c).cast("double") for c in columns]
    complete = rows.select(*[v.alias(f"v{i}") for i, v in enumerate(values)]).dropna()
    pairs = combinations_with_replacement(range(len(columns)), 2)
    return complete.agg(
        F.count("*").alias("n"),
        *[F.avg(f"v{i}").alias(f"mean_{i}") for i in range(len(columns))],
        *[F.covar_pop(f"v{i}", f"v{j}").alias(f"cov_{i}_{j}") for i, j in pairs],
    )


def fit(rows: DataFrame, inputs: Sequence[str], target: str) -> LinearFit:
    """Ordinary least squares with an intercept. Inputs that do not vary, or that others make up
    for, get the shortest solution; a table without complete rows is an error."""
    columns = [*inputs, target]
    found = covariances(rows, columns).first()
    if not found["n"]:
        raise ValueError("there are no complete rows to fit")
    size = len(columns)
    cov = np.zeros((size, size))
    for i, j in combinations_with_replacement(range(size), 2):
        cov[i, j] = cov[j, i] = found[f"cov_{i}_{j}"]
    means = np.array([found[f"mean_{i}"] for i in range(size)])
    # In units of each input's deviation, so that a large one does not drown a small one.
    scale = np.sqrt(np.diag(cov)[:-1])
    scale[scale == 0] = 1.0
    weights = np.linalg.lstsq(cov[:-1, :-1] / np.outer(scale, scale), cov[:-1, -1] / scale, rcond=1e-12)[0] / scale
    explained = float(weights @ cov[:-1, -1])
    r2 = explained / float(cov[-1, -1]) if cov[-1, -1] > 0 else None
    return LinearFit(list(inputs), weights.tolist(), float(means[-1] - weights @ means[:-1]), r2, found["n"])
