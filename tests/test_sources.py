"""CSV scan, typed reads, landing, processed tables, SQL registration."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import orders as op
from ledgerloom.plans import etl, reports, rfm
from ledgerloom.sources import artifacts, raw_files, tables, versions

CSV = {
    "olist_orders_dataset": (
        "order_id,customer_id,order_status,order_purchase_timestamp,"
        "order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2018-01-01 10:00:00,2018-01-05 09:00:00,2018-01-04\n"
        "o2,c2,delivered,2018-02-01 10:00:00,not a date,2018-02-04\n"
        "o3,c2,shipped,2018-03-01 10:00:00,,2018-03-04\n"
    ),
    "olist_order_items_dataset": (
        "price,order_id,order_item_id,freight_value,seller_id\n10.5,o1,1,1.5,s1\nbad,o1,2,1.0,s1\n"
    ),
    "olist_order_payments_dataset": (
        "order_id,payment_type,payment_installments,payment_value\no1,boleto,1,12.0\n"
    ),
    "olist_order_reviews_dataset": (
        'order_id,review_score,review_comment_message\no1,5,"two\nlines, and ""quotes"""\no2,1,\n'
    ),
    "olist_customers_dataset": (
        "customer_id,customer_unique_id,customer_state,customer_city\nc1,u1,SP,x\nc2,u2,RJ,y\n"
    ),
    "olist_products_dataset": "product_id\np1\n",
    "olist_sellers_dataset": "seller_id\ns1\n",
    "extra": "a,b\n1,2\n",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw")
    for name, text in CSV.items():
        (path / f"{name}.csv").write_text(text)
    (path / "README.md").write_text("not a table")
    return str(path)


def test_scan_folder(spark, folder):
    found = raw_files.load_raw(spark, folder)
    assert set(found) == {*schemas.RAW_TYPES, "extra"}
    orders = {r["order_id"]: r for r in found["orders"].collect()}
    assert orders["o1"]["order_purchase_timestamp"] == dt.datetime(2018, 1, 1, 10)
    assert orders["o2"]["order_delivered_customer_date"] is None
    assert orders["o1"]["order_estimated_delivery_date"] == dt.datetime(2018, 1, 4)
    items = {r["order_item_id"]: r for r in found["order_items"].collect()}
    assert items[1]["price"] == 10.5 and items[2]["price"] is None and items[1]["seller_id"] == "s1"
    reviews = found["order_reviews"].collect()
    assert [r["review_score"] for r in reviews] == [5, 1]
    assert reviews[0]["review_comment_message"] == 'two\nlines, and "quotes"'
    assert [tuple(r) for r in found["extra"].collect()] == [("1", "2")]


def test_known_tables(spark, folder, tmp_path):
    known = raw_files.load_known(spark, folder)
    assert list(known) == list(schemas.RAW_TYPES) and known["customers"].count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        raw_files.load_known(spark, str(tmp_path))


def test_land_raw(spark, folder, tmp_path):
    found = raw_files.scan_text(spark, folder)
    for _ in range(2):  # a second landing replaces the first
        raw_files.land_raw(found, str(tmp_path))
    landed = raw_files.scan_text(spark, str(tmp_path))
    assert set(landed) == set(found)
    for name, text in found.items():
        assert landed[name].exceptAll(text).count() == 0 and landed[name].count() == text.count()
    dates = [r["order_delivered_customer_date"] for r in landed["orders"].orderBy("order_id").collect()]
    assert dates == ["2018-01-05 09:00:00", "not a date", None]  # as delivered, not as cast
    typed, again = raw_files.load_raw(spark, folder), raw_files.load_raw(spark, str(tmp_path))
    assert again["orders"].exceptAll(typed["orders"]).count() == 0


def test_files_of_one_table_with_other_column_orders(spark, tmp_path):
    (tmp_path / "orders.csv").write_text("order_id,customer_id\no1,c1\n")
    (tmp_path / "olist_orders_dataset.csv").write_text("customer_id,order_id,order_status\nc2,o2,shipped\n")
    rows = raw_files.load_raw(spark, str(tmp_path))["orders"].orderBy("order_id").collect()
    assert [(r["order_id"], r["customer_id"], r["order_status"]) for r in rows] == [
        ("o1", "c1", None), ("o2", "c2", "shipped"),
    ]


def test_part_files_must_share_a_header(spark, tmp_path):
    parts = tmp_path / "orders"
    parts.mkdir()
    (parts / "part-0.csv").write_text("order_id,customer_id\no1,c1\n")
    (parts / "part-1.csv").write_text("customer_id,order_id\nc2,o2\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw_files.load_raw(spark, str(tmp_path))["orders"].collect()


def test_etl_from_csv(spark, folder, tmp_path):
    out = str(tmp_path)
    found = raw_files.load_raw(spark, folder)
    with pytest.raises(ValueError, match="recency"):  # one customer: no quartiles
        tables.run_etl(spark, found, out)
    tables.write_processed({"master": etl.build_master(found)}, out)
    row = tables.read_table(spark, out, "master").first()
    assert row["order_id"] == "o1" and row["total_payment"] == 12.0 and row["order_value"] == 12.0


def test_etl_stores_what_it_computes(spark, raw, tmp_path):
    stored = tables.run_etl(spark, raw, str(tmp_path))
    master = etl.build_master(raw)
    spend = rfm.rfm_base(etl.build_master(raw, with_customers=False), etl.snapshot_time(raw["orders"]))
    built = {
        "master": master, "orders": op.delivered_orders(raw["orders"]),
        "items": op.item_totals(raw["order_items"]), "rfm": rfm.score_by_quartiles(spend, ties="value"),
    }
    assert set(stored) == {"master", "rfm", "orders", "items", "payments"}
    for name in ("orders", "items", "rfm"):
        left, right = stored[name], built[name]
        if name == "rfm":  # sums of doubles may differ in the last digit
            left, right = (d.withColumn("monetary", F.round("monetary", 6)) for d in (left, right))
        assert left.count() == right.count() and left.exceptAll(right).count() == 0
    months = list(tmp_path.glob("version-*/master/year=*/month=*"))
    files = [len(list(m.glob("*.parquet"))) for m in months]
    assert len(files) == 80 and max(files) == 1  # rebalanced: no small files per task
    one_month = stored["master"].where("year = 1995 and month = 3")
    plan = one_month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    left = reports.monthly_revenue(stored["master"]).collect()
    assert left == reports.monthly_revenue(built["master"]).collect()


def test_sql_over_registered_tables(spark, raw):
    processed = {"master": etl.build_master(raw), "orders": raw["orders"]}
    tables.save_tables(spark, processed, "processed", buckets=4)
    tables.save_tables(spark, processed, "processed", buckets=4)
    got = spark.sql(
        "SELECT year, month, ROUND(SUM(total_payment), 2) AS revenue FROM processed.master "
        "GROUP BY year, month"
    )
    want = reports.month_over_month(processed["master"]).select("year", "month", "revenue")
    assert got.exceptAll(want).count() == 0
    top = spark.sql(
        "WITH s AS (SELECT customer_id, SUM(total_payment) AS spend FROM processed.master "
        "GROUP BY customer_id), p AS (SELECT APPROX_PERCENTILE(spend, 0.95) AS p95 FROM s) "
        "SELECT s.* FROM s, p WHERE s.spend >= p.p95"
    )
    assert top.count() > 0
    joined = spark.table("processed.master").join(spark.table("processed.orders"), "order_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan  # co-located by bucket
    tables.register_views(processed, prefix="v_")
    assert spark.sql("SELECT COUNT(*) AS n FROM v_master").first()["n"] == 485


def test_reports_and_exports_as_csv(spark, raw, tmp_path):
    result = reports.status_funnel(raw["orders"])
    tables.write_report(result, str(tmp_path / "funnel"))
    parts = [f for f in os.listdir(tmp_path / "funnel") if f.endswith(".csv")]
    assert len(parts) == 1
    back = tables.read_table(spark, str(tmp_path), "funnel", "csv")
    assert back.columns == result.columns and back.count() == 3
    tables.write_export(raw["orders"], str(tmp_path / "orders"))
    assert tables.read_table(spark, str(tmp_path), "orders", "csv").count() == 1500


def test_a_failed_run_leaves_the_tables_before(spark, raw, tmp_path, monkeypatch):
    """The third write breaks: readers still see all five tables of the run before."""
    root = str(tmp_path)
    before = tables.run_etl(spark, raw, root)
    sizes = {name: df.count() for name, df in before.items()}
    assert before.record["raw_orders_rows"] == raw["orders"].count() and before.record["duplicate_customers"] == 0
    assert {name: before.record[f"{name}_rows"] for name in sizes} == sizes
    written, real = [], tables.write_table

    def breaking(df, path, *rest):
        written.append(path)
        if len(written) == 3:
            raise OSError("disk full")
        real(df, path, *rest)

    monkeypatch.setattr(tables, "write_table", breaking)
    few = {**raw, "orders": raw["orders"].where("order_id < 100")}
    with pytest.raises(OSError, match="disk full"):
        tables.run_etl(spark, few, root)
    monkeypatch.undo()
    for name, n in sizes.items():
        assert tables.read_table(spark, root, name).count() == n
    assert versions.current(spark, root).number == 1 and len(list(tmp_path.glob("version-*"))) == 1
    after = tables.run_etl(spark, few, root, ties="rank")
    assert after.version.number == 2 and after["orders"].count() < sizes["orders"]
    assert tables.read_table(spark, root, "orders").count() == after["orders"].count()
    assert versions.forget(spark, root, keep=1) == 1 and len(list(tmp_path.glob("version-*"))) == 1
    assert tables.read_table(spark, root, "orders").count() == after["orders"].count()


def test_duplicate_customers_are_counted(spark, raw, tmp_path):
    twice = {**raw, "customers": raw["customers"].union(raw["customers"].limit(3))}
    run = tables.run_etl(spark, twice, str(tmp_path))
    assert run.record["duplicate_customers"] == run["master"].count() - run["orders"].count() > 0


def test_sql_over_files_where_they_lie(spark, raw, tmp_path):
    """No second copy, months as partitions, and a new version or month is followed."""
    root = str(tmp_path)
    run = tables.run_etl(spark, raw, root)
    files = {f for f in tmp_path.rglob("*.parquet")}
    tables.register_external(spark, root, ["master", "orders"], "where_they_lie")
    query = spark.sql("SELECT COUNT(*) AS n FROM where_they_lie.master WHERE year = 1995 AND month = 3")
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and {f for f in tmp_path.rglob("*.parquet")} == files
    assert query.first()["n"] == run["master"].where("year = 1995 and month = 3").count() > 0
    plain = tmp_path / "plain"
    tables.write_processed({"master": run["master"].where("month < 3")}, str(plain))
    tables.register_external(spark, str(plain), ["master"], "where_they_lie")
    some = spark.table("where_they_lie.master").count()
    month = run["master"].where("year = 1995 and month = 3").drop("year", "month")
    month.write.parquet(str(plain / "master" / "year=1995" / "month=3"))
    tables.register_external(spark, str(plain), ["master"], "where_they_lie")
    assert spark.table("where_they_lie.master").count() == some + month.count()


def test_commits_take_the_next_free_number(spark, tmp_path):
    root = str(tmp_path)
    assert versions.current(spark, root) is None
    for n in (1, 2, 3):
        folder = versions.stage(root)
        spark.range(n).write.parquet(f"{folder}/t")
        assert versions.commit(spark, root, folder, ["t"], {"n": n}).number == n
    latest = versions.current(spark, root)
    assert latest.details == {"n": 3} and spark.read.parquet(latest.path("t")).count() == 3
    with pytest.raises(FileNotFoundError):
        artifacts.current_model(spark, str(tmp_path / "none"))
