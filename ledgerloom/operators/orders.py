"""Order-level derivations and the per-order aggregates joined into the master table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates


def derive_orders(orders: DataFrame) -> DataFrame:
    """Calendar parts, delivery time and late flag for every order, whatever its status."""
    bought = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    return orders.withColumns(
        {
            "year": F.year(bought),
            "month": F.month(bought),
            "day_of_week": dates.weekday_name(bought),
            "hour": F.hour(bought),
            "delivery_days": dates.whole_days(delivered, bought),
            "is_late": dates.flag(delivered > F.col("order_estimated_delivery_date")),
        }
    )


def only_delivered(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status") == "delivered")


def delivered_orders(orders: DataFrame) -> DataFrame:
    """Delivered orders that carry a delivery date, with the derived columns."""
    delivered = only_delivered(derive_orders(orders))
    return delivered.where(F.col("order_delivered_customer_date").isNotNull())


def item_totals(items: DataFrame) -> DataFrame:
    return items.withColumn("item_total", F.col("price") + F.col("freight_value"))


def items_per_order(items: DataFrame) -> DataFrame:
    return (
        item_totals(items)
        .where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.count("order_item_id").alias("num_items"),
            F.coalesce(F.sum("item_total"), F.lit(0.0)).alias("order_value"),
            F.avg("price").alias("avg_price"),
        )
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Sum of value, most instalments, and the most frequent type (ties: smallest name)."""
    return (
        payments.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("total_payment"),
            F.max("payment_installments").alias("installments"),
            F.mode("payment_type", deterministic=True).alias("payment_type"),
        )
    )


def payment_value_per_order(payments: DataFrame) -> DataFrame:
    return (
        payments.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("total_payment"))
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return (
        reviews.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.avg("review_score").alias("review_score"))
    )
