"""Mergeable sketches per month, stored once and put together for any range of months.

Each month holds a KLL sketch of the order values and an HLL sketch of the customers, a few
kilobytes whatever the number of orders. Reports over years or any other months merge the stored
sketches and read no order again; a new or corrected month replaces its own partition only. How far
the answers are off is measured, not assumed: ``quantile_errors`` and ``customer_errors`` compare
them with exact counts.

Rows without a year or month are in no sketch; null values and customers do not count; a month
without values has no quantiles, and an empty table no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import spool

VALUES_KEPT = 800  # KLL size: ranks are off by about 0.35 % with 99 % confidence
LOG_REGISTERS = 14  # HLL size: the standard error is about 0.8 %
RANK_TOLERANCE = 0.01
COUNT_TOLERANCE = 0.035


def by_month(master: DataFrame, value: str = "total_payment", customer: str = "customer_id") -> DataFrame:
    """One row per month: both sketches; partial ones are merged before the shuffle."""
    return (
        master.where("year IS NOT NULL AND month IS NOT NULL")
        .groupBy("year", "month")
        .agg(
            F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(VALUES_KEPT)).alias("value_sketch"),
            F.hll_sketch_agg(F.col(customer).cast("string"), LOG_REGISTERS).alias("customer_sketch"),
        )
    )


def store(sketches: DataFrame, path: str) -> None:
    """Write the months of ``sketches``; stored months that are not among them stay."""
    (
        sketches.repartition("year", "month").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    kinds = "value_sketch binary, customer_sketch binary, year int, month int"
    return spark.read.schema(kinds).parquet(path)


def values_counted(sketch: Column) -> Column:
    return F.coalesce(F.kll_sketch_get_n_double(sketch), F.lit(0))


def merged(sketches: DataFrame, keys: Sequence[str] = (), shares: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Per group of months: values counted, about the quantiles at ``shares``, and about how many
    different customers; over all months without ``keys``."""
    both = sketches.groupBy(*keys).agg(
        F.kll_merge_agg_double("value_sketch").alias("values"), F.hll_union_agg("customer_sketch").alias("people")
    )
    n = values_counted(F.col("values"))
    edges = F.array(*[F.kll_sketch_get_quantile_double("values", F.lit(float(s))) for s in shares])
    return both.select(
        *keys, n.alias("n"), F.when(n > 0, edges).alias("quantiles"),
        F.hll_sketch_estimate("people").alias("customers"),
    )


def rank_error(below: Column, upto: Column, n: Column, share: Column) -> Column:
    """How far ``share`` lies from the ranks that a value takes: ``below`` of ``n`` values are
    smaller, ``upto`` are not larger."""
    return F.greatest(below / n - share, share - upto / n, F.lit(0.0))


def quantile_errors(
    master: DataFrame, sketches: DataFrame, key: str = "year", shares: Sequence[float] = (0.5, 0.95, 0.99),
    value: str = "total_payment",
) -> DataFrame:
    """Per group and share: the sketched quantile, its true rank error, and whether that is within
    ``RANK_TOLERANCE``. The quantiles are spooled, one row per group, so that Spark knows their size
    and does not shuffle the orders for the join; one pass counts for all shares."""
    edges = spool(merged(sketches, [key], shares).where("n > 0").select(key, "quantiles"), "edges")
    number = F.col(value).cast("double")
    counts = [
        F.count_if(test).alias(f"{name}_{i}")
        for i in range(len(shares))
        for name, test in (("below", number < F.col("quantiles")[i]), ("upto", number <= F.col("quantiles")[i]))
    ]
    counted = (
        master.where(number.isNotNull()).join(edges, key)
        .groupBy(key).agg(F.count("*").alias("n"), F.any_value("quantiles").alias("quantiles"), *counts)
    )
    each = F.array(*[
        F.struct(
            F.lit(float(s)).alias("share"), F.col("quantiles")[i].alias("value"),
            rank_error(F.col(f"below_{i}"), F.col(f"upto_{i}"), F.col("n"), F.lit(float(s))).alias("rank_error"),
        )
        for i, s in enumerate(shares)
    ])
    return counted.select(key, "n", F.inline(each)).withColumn("within", F.col("rank_error") <= RANK_TOLERANCE)


def customer_errors(
    master: DataFrame, sketches: DataFrame, key: str = "year", customer: str = "customer_id"
) -> DataFrame:
    """Per group: different customers exactly and by the sketches, and whether the relative error
    is within ``COUNT_TOLERANCE``. Both sides are one row per group when they meet."""
    exact = (
        master.where(F.col(key).isNotNull() & F.col("month").isNotNull() & F.col(customer).isNotNull())
        .select(key, customer).distinct().groupBy(key).agg(F.count("*").alias("customers"))
    )
    about = merged(sketches, [key]).select(key, F.col("customers").alias("estimate"))
    off = F.abs(F.col("estimate") - F.col("customers")) / F.col("customers")
    return exact.join(about, key).withColumn("within", off <= COUNT_TOLERANCE)


def edge_error(values: DataFrame, value: str, share: float, accuracy: int = 10_000) -> DataFrame:
    """One row: the approximate percentile that the customer report cuts at, its true rank error
    among all values, and whether that is within the promised 1/``accuracy``."""
    number = F.col(value).cast("double")
    kept = spool(values.select(number.alias("value")).where("value IS NOT NULL"), "edge-values")
    edge = kept.agg(F.percentile_approx("value", share, accuracy)).scalar()
    counted = kept.agg(
        F.count("*").alias("n"), F.count_if(F.col("value") < edge).alias("below"),
        F.count_if(F.col("value") <= edge).alias("upto"),
    )
    error = rank_error(F.col("below"), F.col("upto"), F.col("n"), F.lit(float(share)))
    # One rank is the least that a value among few can be off.
    allowed = F.greatest(F.lit(1.0 / accuracy), 1 / F.col("n"))
    return counted.select("n", F.lit(float(share)).alias("share"), error.alias("rank_error"), (error <= allowed).alias("within"))
