"""Customer clusters on standardised recency, frequency and spend."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import even_round
from ledgerloom.functions.segments import CLUSTER_NAMES
from ledgerloom.operators import kmeans
from ledgerloom.session import spool

MEASURES = ("recency", "frequency", "monetary")


@dataclass
class Clustering:
    customers: DataFrame
    selection: DataFrame
    profile: DataFrame
    model: PipelineModel
    best_k: int
    passes: int = 0


def label_stage(names: dict[int, str]) -> SQLTransformer:
    """Cluster number to name as a pipeline stage, so that the names learnt in training are
    saved and loaded with the model. A cluster without a name gets null."""
    cases = " ".join(f"WHEN {number} THEN '{name}'" for number, name in sorted(names.items()))
    label = f"CASE cluster {cases} END" if cases else "CAST(NULL AS STRING)"
    return SQLTransformer(statement=f"SELECT *, {label} AS cluster_label FROM __THIS__")


def cluster_stage(
    means: Sequence[float], deviations: Sequence[float], centres: Sequence[Sequence[float]]
) -> SQLTransformer:
    """Number of the nearest centre as a pipeline stage; centres are in standardised units."""
    scaled = [f"((CAST({c} AS DOUBLE) - ({m!r}D)) / {d!r}D)" for c, m, d in zip(MEASURES, means, deviations)]
    return SQLTransformer(statement=f"SELECT *, {kmeans.nearest_sql(scaled, centres)} AS cluster FROM __THIS__")


def mean_spend(clustered: DataFrame) -> DataFrame:
    return (
        clustered.groupBy("cluster")
        .agg(F.avg("monetary").alias("avg_monetary"))
        .orderBy("avg_monetary", "cluster")
    )


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Size and mean measures of each named cluster."""
    return (
        clustered.where(F.col("cluster_label").isNotNull())
        .groupBy("cluster_label")
        .agg(
            F.count("customer_id").alias("customers"),
            even_round(F.avg("recency"), 1).alias("avg_recency"),
            even_round(F.avg("frequency"), 1).alias("avg_frequency"),
            even_round(F.avg("monetary"), 1).alias("avg_monetary"),
        )
        .orderBy("cluster_label")
    )


def cluster_customers(
    rfm: DataFrame,
    ks: Iterable[int] = range(2, 9),
    restarts: int = 10,
    seed: int = 42,
    max_iterations: int = 300,
) -> Clustering:
    """Try each ``k`` with several starts, keep the one with the best silhouette, name clusters.

    All starts of all ``ks`` share the passes over the customers; ``passes`` says how many these
    were. ``selection`` holds the curve per k: ``inertia`` in units of the population deviation,
    and the mean ``silhouette`` by squared Euclidean distance, which follows from the clusters'
    sums without comparing pairs of rows. Clusters are named in ascending order of mean spend;
    with more clusters than names, the highest ones stay unnamed. Customers without one of the
    measures take no part in training and get no cluster.
    """
    session = rfm.sparkSession
    rfm = spool(rfm, "rfm")
    values = [F.col(c).cast("double") for c in MEASURES]
    complete = rfm.where(" AND ".join(f"{c} IS NOT NULL" for c in MEASURES))
    found = complete.agg(*[f(v) for v in values for f in (F.avg, F.stddev_pop)]).first()
    means = [float(m or 0.0) for m in found[0::2]]
    # A measure that does not vary is zero everywhere.
    deviations = [float(d or 1.0) for d in found[1::2]]
    scaled = [((v - m) / d).alias(c) for c, v, m, d in zip(MEASURES, values, means, deviations)]
    points = complete.select(*scaled, F.xxhash64("customer_id").alias(kmeans.KEY))
    sweep = kmeans.sweep(points, MEASURES, ks, restarts, seed, max_iterations)
    curve = [(k, s.cost, float(sweep.silhouettes[k])) for k, s in sorted(sweep.best.items())]
    if not curve:
        raise ValueError("there are no customers to cluster")
    best_k = max(curve, key=lambda row: row[2])[0]
    nearest = cluster_stage(means, deviations, sweep.best[best_k].centres.tolist())
    order = [r["cluster"] for r in mean_spend(nearest.transform(complete)).collect()]
    names = dict(zip(order, CLUSTER_NAMES[:best_k]))
    model = PipelineModel([nearest, label_stage(names)])
    customers = model.transform(rfm)
    selection = session.createDataFrame(curve, "k int, inertia double, silhouette double")
    return Clustering(
        customers, selection.orderBy("k"), cluster_profile(customers), model, best_k, sweep.passes
    )
