"""Raw tables to processed tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import orders as op


def build_master(tables: Mapping[str, DataFrame], with_customers: bool = True) -> DataFrame:
    """One row per delivered order with item, payment, review and customer columns.

    The customer lookup comes first, while the order rows are narrow, and is followed by the
    shuffle on ``order_id`` that all the per-order aggregates share: no side is shuffled twice
    and the result stays partitioned by ``order_id``. A customer with very many orders only
    makes the lookup uneven, and AQE may split that, because a shuffle follows anyway.

    Per-order aggregates have one row per order, which Spark sees: a side whose columns a query
    does not use is dropped from its plan. It cannot see that for the customers, so
    ``with_customers=False`` leaves that lookup out.
    """
    return assemble(
        op.delivered_orders(tables["orders"]),
        op.items_per_order(tables["order_items"]),
        op.payments_per_order(tables["order_payments"]),
        op.reviews_per_order(tables["order_reviews"]),
        tables["customers"] if with_customers else None,
    )


def assemble(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame,
    customers: DataFrame | None,
) -> DataFrame:
    """The master table from delivered orders and one row per order of each other side."""
    places: list[str] = []
    master = orders
    if customers is not None:
        places = ["customer_state", "customer_city"]
        master = master.join(customers.select("customer_id", *places), "customer_id", "left")
    for side in (items, payments, reviews):
        master = master.join(side, "order_id", "left")
    return master.select(
        *orders.columns,
        *[c for c in master.columns if c not in {*orders.columns, *places}],
        *places,
    )


def snapshot_time(orders: DataFrame) -> Column:
    """Latest purchase among delivered orders with a delivery date, as a scalar subquery.

    Equals the maximum over the master table, whose joins never drop an order, but reads only
    three columns of the orders.
    """
    return (
        op.delivered_orders(orders).agg(F.max("order_purchase_timestamp").alias("t")).scalar()
    )

