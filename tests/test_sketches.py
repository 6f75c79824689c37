"""Sketches per month: stored, replaced, merged, and how far their answers are off."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import sketches


@pytest.fixture(scope="module")
def orders(spark):
    """Two years; one month holds a third of all orders, and some values and customers are null."""
    return spark.range(60_000).selectExpr(
        "CAST(2017 + id % 2 AS INT) AS year",
        "CAST(IF(id % 3 = 0, 5, 1 + id % 11) AS INT) AS month",
        "IF(id % 50 = 0, NULL, id % 9000) AS customer_id",
        "IF(id % 40 = 0, NULL, CAST(pmod(hash(id), 100000) AS DOUBLE) / 7) AS total_payment",
    )


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "sketches")


def test_errors_are_true_and_small(spark, orders, place):
    sketches.store(sketches.by_month(orders), place)
    stored = sketches.read(spark, place)
    for r in sketches.quantile_errors(orders, stored).collect():
        values = [v.total_payment for v in orders.where(F.col("year") == r.year).dropna(subset="total_payment").collect()]
        below, upto = sum(v < r.value for v in values) / len(values), sum(v <= r.value for v in values) / len(values)
        assert r.n == len(values) and r.within
        assert r.rank_error == pytest.approx(max(below - r.share, r.share - upto, 0))
    found = {r.year: r for r in sketches.customer_errors(orders, stored).collect()}
    exact = {r.year: r.n for r in orders.groupBy("year").agg(F.countDistinct("customer_id").alias("n")).collect()}
    assert {y: r.customers for y, r in found.items()} == exact and all(r.within for r in found.values())


def test_a_wrong_sketch_is_found(spark, orders, place):
    other = orders.withColumn("total_payment", F.col("total_payment") * 2).withColumn("customer_id", F.col("customer_id") % 100)
    sketches.store(sketches.by_month(other), place)
    stored = sketches.read(spark, place)
    assert not any(r.within for r in sketches.quantile_errors(orders, stored, shares=[0.5, 0.9]).collect())
    assert not any(r.within for r in sketches.customer_errors(orders, stored).collect())


def test_a_month_is_replaced_alone(spark, orders, place):
    sketches.store(sketches.by_month(orders), place)
    late = orders.where("year = 2018 AND month = 5")
    sketches.store(sketches.by_month(late.unionByName(late)), place)
    got = {(r.year, r.month): r.n for r in sketches.merged(sketches.read(spark, place), ["year", "month"]).collect()}
    want = {(r.year, r.month): r.n for r in orders.groupBy("year", "month").agg(F.count("total_payment").alias("n")).collect()}
    want[2018, 5] *= 2
    assert got == want


def test_whole_range_and_partitions(spark, orders, place):
    sketches.store(sketches.by_month(orders), place)
    stored = sketches.read(spark, place)
    row = sketches.merged(stored).first()
    assert row.n == orders.where("total_payment IS NOT NULL").count() and len(row.quantiles) == 3
    plan = stored.where("year = 2018")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_orders_are_not_shuffled_for_the_join(orders):
    sketched = sketches.by_month(orders)
    plan = sketches.quantile_errors(orders, sketched)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_odd_tables(spark, orders, place):
    odd = spark.createDataFrame(
        [(2017, 1, None, None), (2017, 2, "a", 5.0), (2017, 2, "a", 5.0), (None, 2, "b", 1.0), (2018, None, "b", 1.0), (2019, 3, None, 2.0)],
        "year int, month int, customer_id string, total_payment double",
    )
    sketched = sketches.by_month(odd)
    got = {(r.year, r.month): (r.n, r.quantiles, r.customers) for r in sketches.merged(sketched, ["year", "month"], [0.5]).collect()}
    assert got == {(2017, 1): (0, None, 0), (2017, 2): (2, [5.0], 1), (2019, 3): (1, [2.0], 0)}
    assert [(r.year, r.n, r.rank_error) for r in sketches.quantile_errors(odd.where("month IS NOT NULL"), sketched, shares=[0.5]).orderBy("year").collect()] == [(2017, 2, 0.0), (2019, 1, 0.0)]
    assert [(r.year, r.customers) for r in sketches.customer_errors(odd, sketched).collect()] == [(2017, 1)]
    none = odd.where("false")
    assert sketches.by_month(none).count() == 0 and sketches.quantile_errors(none, sketches.by_month(none)).count() == 0
    assert sketches.merged(sketches.by_month(none)).first().n == 0


def test_edge_of_the_customer_report(spark, orders):
    row = sketches.edge_error(orders, "total_payment", 0.95).first()
    assert row.within and row.n == orders.where("total_payment IS NOT NULL").count()
