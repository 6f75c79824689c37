"""The twelve business reports over the processed tables.

Each takes DataFrames and returns one. Grouping columns are small domains (months, states,
payment types, hours, weekdays, statuses, segments, variants), so every report reduces its input
on the map side first, and windows over a report run on a few aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import percent, ratio, share_of_total, sql_round
from ledgerloom.operators import ordered
from ledgerloom.session import spool


def _late_rate() -> Column:
    return sql_round(percent(F.sum("is_late"), F.count("*")), 1).alias("late_rate_pct")


def monthly_revenue(master: DataFrame) -> DataFrame:
    """Report 1: orders, revenue, delivery time and lateness per month."""
    return (
        master.groupBy("year", "month")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            sql_round(F.sum("total_payment"), 2).alias("revenue"),
            sql_round(F.avg("total_payment"), 2).alias("avg_order_value"),
            sql_round(F.avg("delivery_days"), 1).alias("avg_delivery_days"),
            F.sum("is_late").alias("late_orders"),
            _late_rate(),
        )
        .orderBy("year", "month")
    )


def top_states(master: DataFrame, limit: int = 10) -> DataFrame:
    """Report 2: states with the highest revenue."""
    return (
        master.groupBy("customer_state")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            sql_round(F.sum("total_payment"), 2).alias("revenue"),
            sql_round(F.avg("review_score"), 2).alias("avg_review_score"),
            sql_round(F.avg("delivery_days"), 1).alias("avg_delivery_days"),
            _late_rate(),
        )
        .orderBy(F.desc_nulls_last("revenue"), "customer_state")
        .limit(limit)
    )


def payment_mix(master: DataFrame) -> DataFrame:
    """Report 3: orders and revenue per payment type, with its share of orders."""
    return (
        master.groupBy("payment_type")
        .agg(
            F.count("*").alias("total_orders"),
            sql_round(F.sum("total_payment"), 2).alias("total_revenue"),
            sql_round(F.avg("installments"), 1).alias("avg_installments"),
        )
        .withColumn("pct_orders", sql_round(share_of_total(F.col("total_orders")), 1))
        .orderBy(F.desc("total_orders"), "payment_type")
    )


def delivery_by_state(master: DataFrame, min_orders: int = 100, limit: int = 15) -> DataFrame:
    """Report 4: states with more than ``min_orders`` orders, latest deliveries first."""
    late_days = F.when(F.col("is_late") == 1, F.col("delivery_days"))
    return (
        master.groupBy("customer_state")
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("is_late").alias("late_orders"),
            _late_rate(),
            sql_round(F.avg("delivery_days"), 1).alias("avg_delivery_days"),
            sql_round(F.avg(late_days), 1).alias("avg_late_days"),
        )
        .where(F.col("total_orders") > min_orders)
        .orderBy(F.desc("late_rate_pct"), "customer_state")
        .limit(limit)
    )


def review_vs_delivery(master: DataFrame) -> DataFrame:
    """Report 5: delivery performance per (mean) review score of an order."""
    return (
        master.where(F.col("review_score").isNotNull())
        .groupBy("review_score")
        .agg(
            F.count("*").alias("order_count"),
            sql_round(F.avg("delivery_days"), 1).alias("avg_delivery_days"),
            sql_round(F.avg("total_payment"), 2).alias("avg_order_value"),
            F.sum("is_late").alias("late_orders"),
            _late_rate(),
        )
        .orderBy("review_score")
    )


def hourly_pattern(master: DataFrame) -> DataFrame:
    """Report 6: orders per hour of purchase."""
    return (
        master.groupBy("hour")
        .agg(
            F.count("*").alias("orders"),
            sql_round(F.avg("total_payment"), 2).alias("avg_revenue"),
        )
        .withColumn("pct_of_orders", sql_round(share_of_total(F.col("orders")), 1))
        .orderBy("hour")
    )


def weekday_pattern(master: DataFrame) -> DataFrame:
    """Report 7: orders and revenue per weekday of purchase."""
    return (
        master.groupBy("day_of_week")
        .agg(
            F.count("*").alias("orders"),
            sql_round(F.sum("total_payment"), 2).alias("total_revenue"),
            sql_round(F.avg("total_payment"), 2).alias("avg_order_value"),
        )
        .withColumn("pct_of_orders", sql_round(share_of_total(F.col("orders")), 1))
        .orderBy(F.desc("orders"), "day_of_week")
    )


def customer_spend(master: DataFrame) -> DataFrame:
    return master.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        sql_round(F.sum("total_payment"), 2).alias("total_spend"),
        sql_round(F.avg("total_payment"), 2).alias("avg_order_value"),
        sql_round(F.avg("review_score"), 2).alias("avg_review"),
        F.min("order_purchase_timestamp").alias("first_order"),
        F.max("order_purchase_timestamp").alias("last_order"),
    )


def top_customers(
    master: DataFrame,
    share: float = 0.95,
    limit: int = 100,
    exact: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """Report 8: customers at or above the ``share`` percentile of spend, highest first.

    The percentile is a mergeable sketch by default (rank error at most 1/``accuracy``), or the
    exact interpolated value. It enters the filter as a scalar, so there is no join. Customer
    sums are spooled because both the percentile and the filter read them.
    """
    spend = spool(customer_spend(master), "spend")
    if exact:
        edge = ordered.quantiles(spend, "total_spend", [share]).select(F.col("quantiles")[0])
    else:
        edge = spend.agg(F.percentile_approx("total_spend", share, accuracy))
    return (
        spend.where(F.col("total_spend") >= edge.scalar())
        .orderBy(F.desc("total_spend"), "customer_id")
        .limit(limit)
    )


def status_funnel(orders: DataFrame) -> DataFrame:
    """Report 9: orders per status.

    Give it the raw orders. The processed orders hold delivered ones only, and the funnel then
    is a single row of 100 %.
    """
    return (
        orders.groupBy("order_status")
        .agg(F.count("*").alias("orders"))
        .withColumn("pct", sql_round(share_of_total(F.col("orders")), 2))
        .orderBy(F.desc("orders"), "order_status")
    )


def month_over_month(master: DataFrame) -> DataFrame:
    """Report 10: revenue growth against the month before. The window runs on month rows."""
    previous = F.lag("revenue").over(Window.orderBy("year", "month"))
    return (
        master.groupBy("year", "month")
        .agg(sql_round(F.sum("total_payment"), 2).alias("revenue"))
        .withColumn("prev_month_revenue", previous)
        .withColumn(
            "mom_growth_pct",
            sql_round(
                percent(F.col("revenue") - F.col("prev_month_revenue"), F.col("prev_month_revenue")),
                1,
            ),
        )
        .orderBy("year", "month")
    )


def segment_summary(rfm: DataFrame) -> DataFrame:
    """Report 11: customers and spend per segment, with its share of revenue."""
    return (
        rfm.groupBy("segment")
        .agg(
            F.count("*").alias("customers"),
            sql_round(F.avg("recency"), 0).alias("avg_recency_days"),
            sql_round(F.avg("frequency"), 1).alias("avg_orders"),
            sql_round(F.avg("monetary"), 2).alias("avg_spend"),
            F.sum("monetary").alias("_revenue"),
        )
        .select(
            "segment",
            "customers",
            "avg_recency_days",
            "avg_orders",
            "avg_spend",
            sql_round(F.col("_revenue"), 2).alias("total_revenue"),
            sql_round(share_of_total(F.col("_revenue")), 1).alias("revenue_share_pct"),
        )
        .orderBy(F.desc("avg_spend"))
    )


def campaign(master: DataFrame, assignments: DataFrame) -> DataFrame:
    """Report 12: users, orders and revenue per experiment variant.

    ``conversion_rate`` is orders per user here and may exceed one. Orders are summed per
    customer and assignments counted per customer and variant before the join: a customer with
    very many orders is one row in it, and no distinct count runs over order rows. An order
    belongs to one customer, so adding up distinct orders per customer counts each once; a
    customer assigned twice to a variant counts its revenue twice, as joining rows would.
    """
    spend = master.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("_orders"),
        F.sum("total_payment").alias("_spend"),
        F.count("total_payment").alias("_paid"),
    )
    assigned = assignments.groupBy("customer_id", "variant").agg(F.count("*").alias("_times"))
    revenue = F.sum(F.col("_spend") * F.col("_times"))
    return (
        spend.join(assigned, "customer_id")
        .groupBy("variant")
        .agg(
            F.count("*").alias("users"),
            F.sum("_orders").alias("orders"),
            revenue.alias("_revenue"),
            sql_round(ratio(revenue, F.sum(F.col("_paid") * F.col("_times"))), 2).alias(
                "avg_order_value"
            ),
        )
        .select(
            "variant",
            "users",
            "orders",
            sql_round(ratio(F.col("orders"), F.col("users")), 4).alias("conversion_rate"),
            sql_round(F.col("_revenue"), 2).alias("total_revenue"),
            "avg_order_value",
            sql_round(ratio(F.col("_revenue"), F.col("users")), 2).alias("revenue_per_user"),
        )
        .orderBy("variant")
    )
