"""Exploratory tables: profiles, distributions and headline figures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import dates
from ledgerloom.functions.numbers import (
    clip_above,
    even_round,
    millions,
    percent,
    share_of_total,
)
from ledgerloom.operators import ordered
from ledgerloom.operators import orders as op
from ledgerloom.operators.histogram import histogram
from ledgerloom.plans.rfm import rfm_base
from ledgerloom.session import spool
# Fixed value: months from this day on are incomplete in the public data set.
INCOMPLETE_FROM = dt.date(2018, 9, 1)


# ---- profiles ---------------------------------------------------------------------------

def shape_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of each column that has nulls, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "nulls").where("nulls > 0")


def value_counts(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    """Rows per non-null value, most frequent first (or in value order)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(column) if by_value else counts.orderBy(F.desc("n"), column)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_people(customers: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.countDistinct
    return customers.agg(count("customer_unique_id").alias("unique_customers"))


# ---- orders -----------------------------------------------------------------------------

def delivered_only(orders: DataFrame) -> DataFrame:
    """Delivered orders; unlike the master, those without a delivery date stay in."""
    return op.only_delivered(op.derive_orders(orders))


def with_payment(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return orders.join(op.payment_value_per_order(payments), "order_id", "left")


def plausible_deliveries(orders: DataFrame) -> DataFrame:
    """Delivered orders with a delivery time of 0 to 60 days."""
    return (
        delivered_only(orders)
        .dropna(subset=["delivery_days"])
        .where(F.col("delivery_days").between(0, 60))
    )


def delivery_overview(orders: DataFrame) -> DataFrame:
    """One row: totals, share delivered, late orders and mean delivery time."""
    delivered = F.col("order_status") == "delivered"
    n_delivered = F.count_if(delivered)
    late = F.sum(F.when(delivered, F.col("is_late")))
    return op.derive_orders(orders).agg(
        F.count("*").alias("total_orders"),
        n_delivered.alias("delivered_orders"),
        even_round(percent(n_delivered, F.count("*")), 1).alias("delivered_pct"),
        late.alias("late_orders"),
        even_round(percent(late, n_delivered), 1).alias("late_pct"),
        even_round(F.avg(F.when(delivered, F.col("delivery_days"))), 1).alias("avg_delivery_days"),
    )


def monthly_trend(
    orders: DataFrame, payments: DataFrame, before: dt.date | None = INCOMPLETE_FROM
) -> DataFrame:
    """Delivered orders and revenue per month, up to (not including) ``before``."""
    trend = (
        with_payment(delivered_only(orders), payments)
        .dropna(subset=["year", "month"])
        .groupBy("year", "month")
        .agg(
            F.count("order_id").alias("order_count"),
            F.coalesce(F.sum("total_payment"), F.lit(0.0)).alias("revenue"),
        )
        .withColumn("period", dates.first_of_month(F.col("year"), F.col("month")))
        .withColumn("revenue_millions", millions(F.col("revenue")))
    )
    if before is not None:
        trend = trend.where(F.col("period") < F.lit(before))
    return trend.orderBy("period")


def peak_month(trend: DataFrame) -> DataFrame:
    """The month with most orders (the earliest on ties), with its label."""
    best = F.max_by(
        F.struct("period", "order_count"),
        F.struct(F.col("order_count"), -F.unix_date("period")),
    )
    return trend.agg(best.alias("best")).select(
        dates.month_label(F.col("best.period")).alias("label"),
        F.col("best.order_count").alias("order_count"),
    )


def delivery_histogram(orders: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(plausible_deliveries(orders), "delivery_days", bins)


def late_split(orders: DataFrame) -> DataFrame:
    """On-time and late orders with their share."""
    return (
        plausible_deliveries(orders)
        .groupBy(F.when(F.col("is_late") == 1, "Late").otherwise("On-Time").alias("delivery"))
        .agg(F.count("*").alias("orders"))
        .withColumn("pct", even_round(share_of_total(F.col("orders")), 1))
    )


def delivery_by_weekday(orders: DataFrame) -> DataFrame:
    """Mean delivery time, Monday to Sunday; a weekday without orders keeps a null."""
    means = (
        plausible_deliveries(orders)
        .groupBy("day_of_week")
        .agg(F.avg("delivery_days").alias("avg_days"))
    )
    week = orders.sparkSession.createDataFrame(
        [(i, d, d[:3]) for i, d in enumerate(dates.WEEKDAYS_FROM_MONDAY, 1)],
        "position int, day_of_week string, label string",
    )
    return week.join(means, "day_of_week", "left").orderBy("position")


def hourly_orders(orders: DataFrame) -> DataFrame:
    """Orders per hour of purchase, over all statuses."""
    return (
        op.derive_orders(orders)
        .where(F.col("hour").isNotNull())
        .groupBy("hour")
        .agg(F.count("*").alias("orders"))
    )


def hourly_peaks(orders: DataFrame, top: int = 3) -> DataFrame:
    """Orders per hour with a flag on the busiest ones. The window runs on 24 rows."""
    place = F.row_number().over(Window.orderBy(F.desc("orders"), "hour"))
    return hourly_orders(orders).withColumn("is_peak", (place <= top).cast("int")).orderBy("hour")


def peak_hour(orders: DataFrame) -> DataFrame:
    best = F.max_by("hour", F.struct(F.col("orders"), -F.col("hour")))
    return hourly_orders(orders).agg(best.alias("peak_hour"), F.max("orders").alias("orders"))


# ---- payments, reviews, places ----------------------------------------------------------

def payment_types(payments: DataFrame) -> DataFrame:
    """Payments per type, counted per payment row rather than per order."""
    return (
        payments.where(F.col("payment_type").isNotNull())
        .groupBy("payment_type")
        .agg(
            F.count("order_id").alias("n"),
            F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("total_value"),
            F.avg("payment_value").alias("avg_value"),
        )
        .withColumn("total_millions", millions(F.col("total_value")))
        .orderBy(F.desc("n"), "payment_type")
    )


def review_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per score in score order, with the share of all review rows."""
    counts = (
        reviews.groupBy("review_score")
        .agg(F.count("*").alias("n"))
        .withColumn("pct", even_round(share_of_total(F.col("n")), 1))
    )
    return counts.where(F.col("review_score").isNotNull()).orderBy("review_score")


def review_overview(reviews: DataFrame) -> DataFrame:
    five = F.count_if(F.col("review_score") == 5)
    return reviews.agg(
        even_round(F.avg("review_score"), 2).alias("avg_score"),
        five.alias("five_star"),
        even_round(percent(five, F.count("*")), 1).alias("five_star_pct"),
    )


def late_by_review(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Review counts by delivery outcome and score, each review of a delivered order counted and
    every score that occurs included; one row per outcome and score.

    Reviews are counted per order and score before the join, so an order with very many reviews
    is a few rows there.
    """
    per_order = (
        reviews.where(F.col("order_id").isNotNull() & F.col("review_score").isNotNull())
        .groupBy("order_id", "review_score").agg(F.count("*").alias("_n"))
    )
    return (
        delivered_only(orders)
        .select("order_id", "is_late")
        .join(per_order, "order_id")
        .groupBy(
            F.when(F.col("is_late") == 1, "Late").otherwise("On-Time").alias("delivery"), "review_score"
        )
        .agg(F.sum("_n").alias("n"))
    )


def state_stats(orders: DataFrame, payments: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivered orders, revenue and mean delivery time per state, most orders first."""
    places = customers.select("customer_id", "customer_state")
    delivered = delivered_only(orders).join(places, "customer_id", "left")
    return (
        with_payment(delivered, payments)
        .where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(
            F.count("order_id").alias("orders"),
            F.coalesce(F.sum("total_payment"), F.lit(0.0)).alias("revenue"),
            F.avg("delivery_days").alias("avg_delivery"),
        )
        .withColumn("revenue_millions", millions(F.col("revenue")))
        .orderBy(F.desc("orders"), "customer_state")
    )


# ---- customers --------------------------------------------------------------------------

def customer_preview(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Customer table of delivered, paid orders; days count from the last order of any status."""
    snapshot = orders.agg(F.max("order_purchase_timestamp").alias("t")).scalar()
    paid = with_payment(delivered_only(orders), payments).dropna(subset=["total_payment"])
    return rfm_base(paid, snapshot)


def customer_histograms(preview: DataFrame) -> DataFrame:
    """Histograms of the three measures, clipped above."""
    preview = spool(preview, "preview")

    def bars(column: str, limit: int, bins: int) -> DataFrame:
        clipped = preview.select(clip_above(F.col(column), limit).alias(column))
        return histogram(clipped, column, bins).withColumn("feature", F.lit(column))

    tables = [bars("recency", 500, 50), bars("frequency", 10, 20), bars("monetary", 1000, 50)]
    return reduce(DataFrame.unionByName, tables).select("feature", "bin", "bin_low", "bin_high", "n")


def describe(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles; one row per column."""
    table = spool(df.select([F.col(c).cast("double").alias(c) for c in columns]), "measures")
    values = table.unpivot([], list(columns), "feature", "value")
    moments = values.groupBy("feature").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
    )
    edges = ordered.quantiles(values, "value", (0.0, 0.25, 0.5, 0.75, 1.0), by=["feature"])
    names = ("min", "q25", "q50", "q75", "max")
    figures = [F.col("mean"), F.col("std"), *[F.col("quantiles")[i] for i in range(5)]]
    return moments.join(edges.select("feature", "quantiles"), "feature", "left").select(
        "feature",
        "n",
        *[even_round(c, digits).alias(a) for c, a in zip(figures, ("mean", "std", *names))],
    )


# ---- headline figures -------------------------------------------------------------------

def summary(tables: Mapping[str, DataFrame], approximate_people: bool = False) -> DataFrame:
    """One row with the ten headline figures. Each source is reduced to one row of its own and
    enters as a scalar subquery, so nothing is joined."""
    orders, payments = tables["orders"], tables["order_payments"]

    def scalar(df: DataFrame, *columns: Column) -> Column:
        return df.select(*columns).scalar()

    delivered = F.col("order_status") == "delivered"
    days = F.when(delivered & F.col("delivery_days").between(0, 60), F.col("delivery_days"))
    # One pass over the orders: per hour, then over the hours.
    hourly = op.derive_orders(orders).groupBy("hour").agg(
        F.count("*").alias("n"), F.count_if(delivered).alias("delivered"),
        F.sum(F.when(days.isNotNull(), F.col("is_late"))).alias("late"),
        F.count(days).alias("timed"), F.sum(days).alias("days"),
    )
    known_hour = F.when(F.col("hour").isNotNull(), F.struct("n", -F.col("hour")))
    totals = hourly.agg(
        F.struct(
            F.sum("n").alias("total"),
            F.sum("delivered").alias("delivered"),
            even_round(percent(F.sum("late"), F.sum("timed")), 1).alias("late"),
            even_round(F.try_divide(F.sum("days"), F.sum("timed")), 1).alias("days"),
            F.max_by("hour", known_hour).alias("peak_hour"),
        ).alias("s")
    ).scalar()
    per_customer = (
        delivered_only(orders).groupBy("customer_id").agg(F.count("order_id").alias("orders"))
    )
    by_state = (
        per_customer.join(tables["customers"].select("customer_id", "customer_state"), "customer_id")
        .where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(F.sum("orders").alias("orders"))
        .orderBy(F.desc("orders"), "customer_state")
        .limit(1)
    )
    by_type = value_counts(payments.where(F.col("order_id").isNotNull()), "payment_type").limit(1)
    people = distinct_people(tables["customers"], approximate_people)
    reviews = review_overview(tables["order_reviews"])
    sellers = tables["sellers"].agg(F.count("*").alias("sellers"))
    return orders.sparkSession.range(1).select(
        F.coalesce(totals.getField("total"), F.lit(0)).alias("total_orders"),
        F.coalesce(totals.getField("delivered"), F.lit(0)).alias("delivered_orders"),
        people.scalar().alias("unique_customers"),
        sellers.scalar().alias("unique_sellers"),
        scalar(reviews, F.col("avg_score")).alias("avg_review_score"),
        totals.getField("late").alias("late_rate_pct"),
        totals.getField("days").alias("avg_delivery_days"),
        scalar(by_state, F.col("customer_state")).alias("top_state"),
        totals.getField("peak_hour").alias("peak_hour"),
        scalar(by_type, F.col("payment_type")).alias("top_payment"),
    )
