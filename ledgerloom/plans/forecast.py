"""Demand models: split, train, compare, explain, forecast."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import at_least_zero, even_round
from ledgerloom.operators.ordered import row_numbers
from ledgerloom.plans.demand import FEATURES, TARGET, DemandPanel, forecast_inputs
from ledgerloom.session import spool

_KEY = ["customer_state", "year", "month"]


def default_models(
    trees: int = 200, boosts: int = 200, seed: int = 42, max_bins: int = 64
) -> dict[str, Estimator]:
    """The three models; every tree may split on any input. ``max_bins`` bounds the split points
    tried per input."""
    columns = {"featuresCol": "features", "labelCol": TARGET}
    return {
        "Linear Regression": LinearRegression(**columns),
        "Random Forest": RandomForestRegressor(
            numTrees=trees, maxDepth=10, seed=seed, maxBins=max_bins, featureSubsetStrategy="all",
            **columns,
        ),
        "Gradient Boosting": GBTRegressor(
            maxIter=boosts, maxDepth=5, stepSize=0.05, seed=seed, maxBins=max_bins, **columns
        ),
    }


def split(features: DataFrame, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``. A row's side depends on its key and the seed only, so it is the same
    for any partitioning and after a task is re-run."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), *_KEY), F.lit(10_000))
    return features.withColumn("is_test", bucket < int(test_share * 10_000))


def contiguous_folds(features: DataFrame, folds: int = 5) -> DataFrame:
    """Adds ``fold``: equal consecutive blocks in (state, year, month) order, the first ones a
    row longer when the rows do not divide evenly."""
    rows = features.count()
    size, longer = divmod(rows, folds)
    index = F.col("_row") - 1
    boundary = longer * (size + 1)
    fold = F.when(index < boundary, F.floor(index / (size + 1))).otherwise(
        longer + F.floor((index - boundary) / max(size, 1))
    )
    numbered = row_numbers(features, _KEY, "_row")
    return numbered.withColumn("fold", fold.cast("int")).drop("_row")


def metric_columns(scored: DataFrame, label: str = TARGET) -> DataFrame:
    """Mean absolute error, root mean squared error and R² from one aggregation pass."""
    error = F.col(label) - F.col("prediction")
    return scored.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop(label) * F.count(label))).alias("r2"),
    )


def regression_metrics(scored: DataFrame, label: str = TARGET) -> dict[str, float]:
    return metric_columns(scored, label).first().asDict()


@dataclass
class DemandTraining:
    leaderboard: DataFrame
    best_name: str
    model: PipelineModel


def train(
    panel: DemandPanel,
    models: Mapping[str, Estimator] | None = None,
    folds: int = 5,
    parallelism: int | None = None,
) -> DemandTraining:
    """Fit every model on the training side, score the test side and cross-validate on all rows.

    The model with the best test R² is returned as a pipeline that starts from raw state names.
    Fits of different models and folds run side by side as separate Spark jobs, all at once unless
    ``parallelism`` says how many. A fit is thousands of short jobs one after another over a table
    of one row per state and month, so one fit alone leaves nearly all of a cluster idle.
    """
    models = dict(models or default_models())
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    ready = spool(contiguous_folds(split(panel.features), folds), "training")
    vectors = assembler.transform(ready).select(*_KEY, TARGET, "features", "is_test", "fold")
    vectors.persist()
    by_r2 = RegressionEvaluator(labelCol=TARGET, metricName="r2")

    def holdout(name: str):
        fitted = models[name].fit(vectors.where("not is_test"))
        return fitted, regression_metrics(fitted.transform(vectors.where("is_test")))

    def one_fold(name: str, fold: int) -> float:
        fitted = models[name].copy().fit(vectors.where(F.col("fold") != fold))
        return by_r2.evaluate(fitted.transform(vectors.where(F.col("fold") == fold)))

    session = vectors.sparkSession
    try:
        with ThreadPoolExecutor(parallelism or max(1, len(models) * (1 + folds))) as pool:
            run = inheritable_thread_target(session)
            tests = {n: pool.submit(run(holdout), n) for n in models}
            checks = {n: [pool.submit(run(one_fold), n, i) for i in range(folds)] for n in models}
            fitted = {n: f.result() for n, f in tests.items()}
            cross = {n: sum(f.result() for f in fs) / folds for n, fs in checks.items() if fs}
    finally:
        vectors.unpersist()
    best = max(fitted, key=lambda n: fitted[n][1]["r2"])
    rows = [
        (n, m["mae"], m["rmse"], m["r2"], cross.get(n), n == best) for n, (_, m) in fitted.items()
    ]
    board = session.createDataFrame(
        rows, "model string, mae double, rmse double, r2 double, cv_r2 double, is_best boolean"
    ).orderBy(F.desc("r2"))
    return DemandTraining(
        board, best, PipelineModel([panel.encoder, assembler, fitted[best][0]])
    )


def feature_importance(model: PipelineModel, spark, top: int = 12) -> DataFrame:
    """Most important inputs of a tree model; no rows for a linear one."""
    weights = getattr(model.stages[-1], "featureImportances", None)
    rows = [] if weights is None else list(zip(FEATURES, map(float, weights.toArray())))
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def forecast(features: DataFrame, model: PipelineModel, horizon: int = 3) -> DataFrame:
    """Predicted orders per state for the coming months: one ``transform`` for all rows."""
    inputs = forecast_inputs(features, horizon).drop("state_enc")
    predicted = at_least_zero(even_round(F.col("prediction"), 0)).cast("bigint")
    return (
        model.transform(inputs)
        .select(
            F.col("customer_state").alias("state"),
            F.col("out_year").alias("year"),
            F.col("out_month").alias("month"),
            predicted.alias("predicted_orders"),
        )
        .orderBy("state", "year", "month")
    )
