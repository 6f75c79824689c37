"""Master table and reports on hand-made rows for the awkward cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import orders as op
from ledgerloom.plans import eda, etl, reports, rfm

ORDER_SCHEMA = (
    "order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
    "order_estimated_delivery_date timestamp_ntz"
)


def at(day, hour=0):
    return dt.datetime(2018, 1, 1) + dt.timedelta(days=day - 1, hours=hour)


@pytest.fixture(scope="module")
def shop(spark):
    orders = [
        ("o1", "c1", "delivered", at(1, 10), at(5, 9), at(4)),  # late, 3 whole days
        ("o2", "c1", "delivered", at(2, 23), at(3, 1), at(9)),  # 0 days
        ("o3", "c2", "delivered", at(3), None, at(9)),  # no delivery date
        ("o4", "c2", "shipped", at(40), None, at(50)),
        ("o5", "c3", "delivered", at(5, 10), at(5, 5), at(9)),  # delivered before purchase
        ("o6", None, "delivered", at(6), at(8), None),  # no customer, no estimate
        ("o7", "c9", "delivered", at(7), at(9), at(9)),  # customer unknown, exactly on time
    ]
    payments = [
        ("o1", "voucher", 2, 10.0), ("o1", "boleto", 5, 5.0), ("o1", None, 1, 1.0),
        ("o2", None, 1, None),
        ("o5", "boleto", 1, 3.0), ("o5", "credit_card", 1, 3.0), ("o5", "credit_card", 1, 3.0),
        (None, "boleto", 1, 99.0),
    ]
    return {
        "orders": spark.createDataFrame(orders, ORDER_SCHEMA),
        "order_items": spark.createDataFrame(
            [("o1", 1, 10.0, 1.0), ("o1", 2, 20.0, None), ("o5", 1, 8.0, 0.5)],
            "order_id string, order_item_id int, price double, freight_value double",
        ),
        "order_payments": spark.createDataFrame(
            payments,
            "order_id string, payment_type string, payment_installments int, payment_value double",
        ),
        "order_reviews": spark.createDataFrame(
            [("o1", 4), ("o1", 5), ("o2", 1), ("o3", 5)], "order_id string, review_score int"
        ),
        "customers": spark.createDataFrame(
            [("c1", "u1", "SP", "x"), ("c2", "u1", "RJ", "y"), ("c3", "u3", None, "z")],
            "customer_id string, customer_unique_id string, customer_state string, "
            "customer_city string",
        ),
        "sellers": spark.createDataFrame([("s1",)], "seller_id string"),
    }


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_master_rows(shop):
    master = by_key(etl.build_master(shop), "order_id")
    assert sorted(master) == ["o1", "o2", "o5", "o6", "o7"]
    assert [master[o]["delivery_days"] for o in ("o1", "o2", "o5")] == [3, 0, -1]
    assert [master[o]["is_late"] for o in ("o1", "o2", "o6", "o7")] == [1, 0, 0, 0]
    assert master["o1"]["day_of_week"] == "Monday" and master["o1"]["hour"] == 10
    assert master["o1"]["order_value"] == 11.0 and master["o1"]["num_items"] == 2
    assert master["o1"]["avg_price"] == 15.0 and master["o1"]["review_score"] == 4.5
    assert master["o7"]["num_items"] is None and master["o7"]["customer_state"] is None
    assert master["o6"]["customer_city"] is None


def test_payments_per_order(shop):
    got = by_key(op.payments_per_order(shop["order_payments"]), "order_id")
    assert None not in got
    assert got["o1"]["payment_type"] == "boleto"  # tie: smallest name
    assert got["o1"]["total_payment"] == 16.0 and got["o1"]["installments"] == 5
    assert got["o2"]["payment_type"] is None and got["o2"]["total_payment"] == 0.0
    assert got["o5"]["payment_type"] == "credit_card"


def test_leaving_out_customers_changes_no_other_column(shop):
    full = by_key(etl.build_master(shop), "order_id")
    some = by_key(etl.build_master(shop, with_customers=False), "order_id")
    for row in full.values():
        del row["customer_state"], row["customer_city"]
    assert some == full


def test_rfm_base(shop):
    master = etl.build_master(shop)
    got = by_key(rfm.rfm_base(master, with_service=True), "customer_id")
    assert sorted(got) == ["c1", "c3", "c9"]  # no row for the missing customer
    assert got["c1"]["recency"] == 4 and got["c1"]["frequency"] == 2
    assert got["c1"]["monetary"] == 16.0 and got["c1"]["late_rate"] == 0.5
    assert got["c9"]["monetary"] == 0.0 and got["c9"]["recency"] == 0
    same = by_key(rfm.rfm_base(master, etl.snapshot_time(shop["orders"])), "customer_id")
    assert {k: v["recency"] for k, v in got.items()} == {k: v["recency"] for k, v in same.items()}


def test_preview_counts_from_the_last_order_of_any_status(shop):
    got = by_key(eda.customer_preview(shop["orders"], shop["order_payments"]), "customer_id")
    assert got["c1"]["recency"] == 37 and "c9" not in got


def test_reports_keep_the_null_group(shop):
    master = etl.build_master(shop)
    states = by_key(reports.top_states(master), "customer_state")
    assert states[None]["total_orders"] == 3 and states["SP"]["revenue"] == 16.0
    shares = [r["pct_orders"] for r in reports.payment_mix(master).collect()]
    assert sum(shares) == pytest.approx(100, abs=0.3)


def test_growth_after_a_month_without_revenue(spark):
    rows = [(2018, 1, 0.0), (2018, 2, 50.0), (2018, 3, 75.0)]
    master = spark.createDataFrame(rows, "year int, month int, total_payment double")
    got = reports.month_over_month(master).collect()
    assert [r["mom_growth_pct"] for r in got] == [None, None, 50.0]


def test_ties_at_a_limit_are_settled_by_key(spark):
    rows = [(f"s{i}", f"o{i}", 5.0, 4.0, 1, 0) for i in range(20)]
    master = spark.createDataFrame(
        rows,
        "customer_state string, order_id string, total_payment double, review_score double, "
        "delivery_days int, is_late int",
    ).repartition(6)
    got = [r["customer_state"] for r in reports.top_states(master).collect()]
    assert got == sorted(f"s{i}" for i in range(20))[:10]
    assert reports.delivery_by_state(master).count() == 0
    assert reports.delivery_by_state(master, min_orders=0).count() == 15


def test_funnel(shop):
    raw = by_key(reports.status_funnel(shop["orders"]), "order_status")
    assert raw["delivered"]["orders"] == 6 and raw["shipped"]["pct"] == 14.29
    processed = reports.status_funnel(op.delivered_orders(shop["orders"])).collect()
    assert [(r["order_status"], r["pct"]) for r in processed] == [("delivered", 100.0)]


def test_top_customers_exact_and_sketched(spark):
    rows = [(f"c{i:03d}", f"o{i}", float(i), 3.0, at(1)) for i in range(1, 101)]
    master = spark.createDataFrame(
        rows,
        "customer_id string, order_id string, total_payment double, review_score double, "
        "order_purchase_timestamp timestamp_ntz",
    )
    exact = [r["total_spend"] for r in reports.top_customers(master, exact=True).collect()]
    assert exact == [100.0, 99.0, 98.0, 97.0, 96.0]  # edge 95.05
    sketch = [r["total_spend"] for r in reports.top_customers(master).collect()]
    assert sketch[:5] == exact and len(sketch) in (5, 6)


def test_campaign_matches_joining_rows(spark):
    master = spark.createDataFrame(
        [("c1", "o1", 10.0), ("c1", "o2", None), ("c2", "o3", 4.0), ("c3", "o4", 1.0),
         (None, "o5", 9.0)],
        "customer_id string, order_id string, total_payment double",
    )
    assigned = spark.createDataFrame(
        [("c1", "test"), ("c1", "test"), ("c1", "control"), ("c2", "control"), (None, "test")],
        "customer_id string, variant string",
    )
    got = by_key(reports.campaign(master, assigned), "variant")
    joined = (
        master.join(assigned, "customer_id").groupBy("variant")
        .agg(
            F.countDistinct("customer_id").alias("users"),
            F.countDistinct("order_id").alias("orders"),
            F.sum("total_payment").alias("total_revenue"),
            F.round(F.avg("total_payment"), 2).alias("avg_order_value"),
        )
    )
    for variant, row in by_key(joined, "variant").items():
        assert {k: got[variant][k] for k in row} == row
    assert got["test"]["conversion_rate"] == 2.0 and got["test"]["revenue_per_user"] == 20.0


def test_monthly_trend_and_peak(shop):
    trend = eda.monthly_trend(shop["orders"], shop["order_payments"])
    rows = trend.collect()
    assert [(r["period"], r["order_count"]) for r in rows] == [(dt.date(2018, 1, 1), 6)]
    assert rows[0]["revenue"] == 25.0 and rows[0]["revenue_millions"] == pytest.approx(25e-6)
    assert eda.peak_month(trend).first()["label"] == "January 2018"
    early = eda.monthly_trend(shop["orders"], shop["order_payments"], before=dt.date(2018, 1, 1))
    assert early.count() == 0


def test_weekdays_without_orders_stay(shop):
    rows = eda.delivery_by_weekday(shop["orders"]).collect()
    assert [r["label"] for r in rows] == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert rows[0]["avg_days"] == 3.0 and rows[2]["avg_days"] is None  # o3 has no delivery date
    assert rows[4]["avg_days"] is None  # o5 has a negative time and is left out


def test_crosstab_counts_every_review(shop):
    rows = eda.late_by_review(shop["orders"], shop["order_reviews"]).collect()
    got = {(r["delivery"], r["review_score"]): r["n"] for r in rows}
    assert (got["Late", 4], got["Late", 5]) == (1, 1)
    assert (got["On-Time", 1], got["On-Time", 5]) == (1, 1)
    assert ("On-Time", 3) not in got


def test_crosstab_takes_scores_from_the_data(spark, shop):
    reviews = spark.createDataFrame(
        [(r["order_id"], s) for r in shop["orders"].collect() for s in (0, 10, None)],
        "order_id string, review_score int",
    )
    rows = eda.late_by_review(shop["orders"], reviews).collect()
    assert {r["review_score"] for r in rows} == {0, 10}


def test_null_profile_and_shapes(shop):
    got = {r["column_name"]: r["nulls"] for r in eda.null_profile(shop["orders"]).collect()}
    assert got == {
        "customer_id": 1, "order_delivered_customer_date": 2, "order_estimated_delivery_date": 1,
    }
    shapes = by_key(eda.shape_profile(shop), "table_name")
    assert shapes["orders"] == {"table_name": "orders", "n_rows": 7, "n_cols": 6}


def test_summary(shop):
    row = eda.summary(shop).first()
    assert row["total_orders"] == 7 and row["delivered_orders"] == 6
    assert row["unique_customers"] == 2 and row["unique_sellers"] == 1
    assert row["top_state"] == "SP" and row["top_payment"] == "boleto" and row["peak_hour"] == 0
    assert row["avg_review_score"] == 3.75
    assert eda.summary(shop, approximate_people=True).first()["unique_customers"] == 2


def test_value_counts_order(shop):
    got = [tuple(r) for r in eda.value_counts(shop["order_reviews"], "review_score").collect()]
    assert got == [(5, 2), (1, 1), (4, 1)]
    got = [r["review_score"] for r in
           eda.value_counts(shop["order_reviews"], "review_score", by_value=True).collect()]
    assert got == [1, 4, 5]


def test_partitioning_does_not_change_results(raw):
    scattered = {name: df.repartition(7) for name, df in raw.items()}
    for report in (reports.monthly_revenue, reports.weekday_pattern, reports.top_states):
        left = report(etl.build_master(raw)).collect()
        assert left == report(etl.build_master(scattered)).collect()


def test_shares_add_up(raw):
    master = etl.build_master(raw)
    for df, column in (
        (reports.hourly_pattern(master), "pct_of_orders"),
        (reports.weekday_pattern(master), "pct_of_orders"),
        (reports.status_funnel(raw["orders"]), "pct"),
        (eda.late_split(raw["orders"]), "pct"),
        (eda.review_distribution(raw["order_reviews"]), "pct"),
    ):
        assert df.agg(F.sum(column)).first()[0] == pytest.approx(100, abs=1.3)
