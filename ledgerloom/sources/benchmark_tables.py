"""Domain tables derived from the TPC-H-like test tables.

Only column values and integer arithmetic are used, so any engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared, so that building a query reads no file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def _hours(count: Column) -> Column:
    return F.make_dt_interval(F.lit(0), count.cast("int"))


def read_source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    bought = day + _hours(key % 24)
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(F.col("o_orderstatus") == "P", "canceled")
    )
    return read_source(spark, folder, "orders").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        bought.alias("order_purchase_timestamp"),
        (bought + _hours(F.lit(1))).alias("order_approved_at"),
        (bought + _hours(24 * (1 + key % 3))).alias("order_delivered_carrier_date"),
        F.when(key % 97 != 0, day + _hours(24 * (3 + key % 41))).alias(
            "order_delivered_customer_date"
        ),
        (day + _hours(24 * (12 + key % 29))).alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return read_source(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )


def order_payments(spark: SparkSession, folder: str) -> DataFrame:
    kind = (
        F.when(F.col("l_returnflag") == "A", "credit_card")
        .when(F.col("l_returnflag") == "N", "boleto")
        .when(F.col("l_returnflag") == "R", "voucher")
    )
    value = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return read_source(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        kind.alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
        value.alias("payment_value"),
    )


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """The priority digit; no review for every 100th order, a second one (5) for some others."""
    key = F.col("o_orderkey")
    score = F.substring("o_orderpriority", 1, 1).cast("int")
    scores = (
        F.when(key % 100 == 0, F.array().cast("array<int>"))
        .when(key % 50 == 1, F.array(score, F.lit(5)))
        .otherwise(F.array(score))
    )
    return read_source(spark, folder, "orders").select(
        key.alias("order_id"), F.explode(scores).alias("review_score")
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nations = read_source(spark, folder, "nation").select("n_nationkey", "n_name")
    return (
        read_source(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").alias("customer_unique_id"),
            F.col("n_name").alias("customer_state"),
            F.col("c_mktsegment").alias("customer_city"),
        )
    )


def experiment_assignments(spark: SparkSession, folder: str) -> DataFrame:
    """Customers whose key is no multiple of five; even keys control, odd keys test."""
    key = F.col("c_custkey")
    return (
        read_source(spark, folder, "customer")
        .where(key % 5 != 0)
        .select(
            key.alias("customer_id"),
            F.when(key % 2 == 0, "control").otherwise("test").alias("variant"),
        )
    )


def experiment(spark: SparkSession, folder: str) -> DataFrame:
    """One row per user and day of the event log."""
    purchase = F.col("event_type") == "purchase"
    return (
        read_source(spark, folder, "events")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(
            F.max(purchase.cast("int")).alias("converted"),
            F.coalesce(F.sum(F.when(purchase, F.col("value"))), F.lit(0.0)).alias("revenue"),
            F.count(F.when(F.col("event_type") == "view", 1)).cast("int").alias("session_pages"),
        )
        .select(
            F.when(F.col("user_id") % 2 == 0, "control").otherwise("test").alias("variant"),
            "user_id",
            "day",
            "converted",
            "revenue",
            "session_pages",
        )
    )


def domain_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "orders": orders(spark, folder),
        "order_items": order_items(spark, folder),
        "order_payments": order_payments(spark, folder),
        "order_reviews": order_reviews(spark, folder),
        "customers": customers(spark, folder),
        "products": read_source(spark, folder, "part"),
        "sellers": read_source(spark, folder, "supplier"),
    }
