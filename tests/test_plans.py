"""Physical plans: pruning, shuffles, joins, skew."""

from __future__ import annotations

import os
import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ledgerloom.catalog import QUERIES
from ledgerloom.plans import etl, reports
from ledgerloom.session import scratch_root, spool, spools
from ledgerloom.sources import tables

# Queries whose DataFrame is the whole plan (nothing is trained while it is built).
FITTED = {
    "demand_leaderboard", "feature_importance", "demand_forecast", "cluster_selection",
    "customer_clusters", "cluster_profile", "score_demand", "score_segment",
    "score_segment_stream", "customer_segments",
}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_sides(spark):
    """Plan as if no side were small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_no_cross_join_and_no_python(spark, large_sides, name):
    plan = physical(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in ("ab_tests", "ab_chi_square"):  # tail probabilities run on one row per experiment
        assert "Python" not in plan


def test_master_shuffles_each_side_once(raw, large_sides):
    """Orders by customer and by order; customers, items, payments and reviews once each."""
    plan = physical(etl.build_master(raw))
    keys = re.findall(r"Exchange hashpartitioning\((customer_id|order_id)#", plan)
    assert sorted(keys) == ["customer_id"] * 2 + ["order_id"] * 4
    assert plan.count("partial_") >= 3  # every side is reduced before its shuffle


def test_reports_read_only_their_columns(spark, raw):
    plan = physical(reports.monthly_revenue(etl.build_master(raw, with_customers=False)))
    assert plan.count("lineitem.parquet") == 1 and "o_orderpriority" not in plan  # joins dropped
    lines = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "l_orderkey" in s]
    columns = {c.split(":")[0] for c in lines[0].split(",")}
    assert columns == {"l_orderkey", "l_extendedprice", "l_discount", "l_tax"}
    assert "mode(" not in plan  # the payment type is not computed for this report
    assert "customer.parquet" not in plan


def test_bucketed_raw_tables_need_no_shuffle_by_order(spark, raw, large_sides):
    tables.save_tables(spark, raw, "bucketed", buckets=4)
    stored = {name: spark.table(f"bucketed.{name}") for name in raw}
    whole = physical(etl.build_master(stored))
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", whole)
    assert sorted(keys) == ["customer_id", "customer_id", "order_id"]  # only the order rows move
    report = physical(reports.monthly_revenue(etl.build_master(stored, with_customers=False)))
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", report) == ["year"]


def test_filter_on_a_stored_table_reaches_the_scan(spark, raw, tmp_path):
    raw["orders"].write.parquet(str(tmp_path / "orders"))
    stored = {**raw, "orders": spark.read.parquet(str(tmp_path / "orders"))}
    plan = physical(etl.build_master(stored))
    assert "EqualTo(order_status,delivered)" in plan
    assert "IsNotNull(order_delivered_customer_date)" in plan


def test_top_lists_do_not_sort_everything(spark):
    for name in ("q02_top_states", "q04_delivery_by_state", "q08_top_customers"):
        assert "TakeOrderedAndProject" in physical(QUERIES[name](spark, SMALL))


def test_hot_customer_is_split(spark, large_sides):
    """A third of all orders belong to one customer; AQE splits that partition of the lookup."""
    n = 200_000
    orders = spark.range(n).select(
        F.concat(F.lit("order-"), "id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), "id"))
        .alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        *[
            F.expr(f"timestamp_ntz'2018-01-0{d} 00:00:00' + make_dt_interval(0, 0, 0, id % 999)")
            .alias(c)
            for d, c in enumerate(
                ("order_purchase_timestamp", "order_delivered_customer_date",
                 "order_estimated_delivery_date"), 1)
        ],
    )
    customers = spark.range(n).select(
        F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), "id"))
        .alias("customer_id"),
        F.when(F.col("id") % 2 == 0, "SP").otherwise("RJ").alias("customer_state"),
        F.lit("x").alias("customer_city"),
    )
    payments = orders.select(
        "order_id", F.lit("boleto").alias("payment_type"),
        F.lit(1).alias("payment_installments"), F.lit(2.0).alias("payment_value"),
    )
    items = orders.select(
        "order_id", F.lit(1).alias("order_item_id"), F.lit(1.0).alias("price"),
        F.lit(0.0).alias("freight_value"),
    )
    reviews = orders.select("order_id", F.lit(5).alias("review_score"))
    shop = {
        "orders": orders, "customers": customers, "order_payments": payments,
        "order_items": items, "order_reviews": reviews,
    }
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.shuffle.partitions": "16",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        sums = etl.build_master(shop).groupBy("customer_state").agg(
            F.count("*").alias("n"), F.sum("total_payment").alias("s")
        )
        rows = {r["customer_state"]: (r["n"], r["s"]) for r in sums.collect()}
        plan = physical(sums)
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(c for c, _ in rows.values()) == n and sum(s for _, s in rows.values()) == 2.0 * n
    assert rows["SP"][0] > n / 3  # the hot customer's orders are all there
    assert "skew=true" in plan


def test_spool_lives_in_the_checkpoint_folder(spark):
    df = spool(spark.range(5).withColumn("x", F.lit("a")), "t")
    assert df.count() == 5 and [f.name for f in df.schema] == ["id", "x"]
    assert scratch_root(spark).removeprefix("file:") in df.inputFiles()[0]


def test_spool_keeps_an_empty_table(spark):
    df = spool(spark.range(5).where("id > 9"), "t")
    assert df.count() == 0 and df.columns == ["id"]


def test_spools_can_be_cleared(spark):
    def stored():
        return spool(spark.range(5), "t").inputFiles()[0].removeprefix("file://")

    earlier = stored()
    with spools(spark):
        inner = stored()
        assert os.path.exists(inner)
    assert os.path.exists(earlier) and not os.path.exists(inner)
