"""Demand panel, models, clusters, scoring in batch and as a stream."""

from __future__ import annotations

import math
import threading

import pandas as pd
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ledgerloom.functions import segments
from ledgerloom.operators.orders import derive_orders
from ledgerloom.plans import clusters, demand, etl, forecast, rfm, scoring
from ledgerloom.sources import artifacts
from ledgerloom.sources.artifacts import load_model, save_model
from ledgerloom.streaming import requests as stream

PANEL = (
    "customer_state string, year int, month int, order_id string, total_payment double, "
    "review_score double, is_late int, delivery_days int, customer_id string"
)


@pytest.fixture(scope="module")
def panel(raw):
    return demand.build_features(etl.build_master(raw))


@pytest.fixture(scope="module")
def trained(spark):
    """A panel with a clear trend: orders grow by one per month, per state offset."""
    rows = [
        (s, 2016 + m // 12, m % 12 + 1, f"{s}{m}-{i}", 10.0, 4.0, 0, 5, f"c{i}")
        for k, s in enumerate(("AA", "BB", "CC", "DD"))
        for m in range(24)
        for i in range(3 + m + 5 * k)
    ]
    built = demand.build_features(spark.createDataFrame(rows, PANEL))
    return built, forecast.train(built, forecast.default_models(trees=10, boosts=5))


class Together(LinearRegression):
    """Fits only when all fits have begun."""

    begun = threading.Barrier(12)

    def fit(self, dataset, params=None):
        self.begun.wait(60)
        return super().fit(dataset, params)


def test_all_fits_run_at_once(trained):
    """Two models on the training side and on five folds each: twelve fits side by side."""
    models = {n: Together(featuresCol="features", labelCol=demand.TARGET) for n in ("one", "two")}
    found = forecast.train(trained[0], models).leaderboard.collect()
    assert [r.cv_r2 for r in found] == [pytest.approx(found[0].cv_r2)] * 2


def test_lags_go_by_row_and_incomplete_rows_drop(spark):
    months = [1, 2, 4, 5, 6]  # March is missing
    rows = [
        ("SP", 2018, m, f"o{m}-{i}", 2.0, 4.0, 1, 3, "c1") for m in months for i in range(m)
    ] + [("RJ", 2018, 1, "x", 1.0, None, 0, 1, "c2"), (None, 2018, 1, "y", 1.0, 1.0, 0, 1, "c3")]
    got = demand.build_features(spark.createDataFrame(rows, PANEL))
    features = {r["month"]: r for r in got.features.collect()}
    assert sorted(features) == [5, 6]
    assert [features[5][f"lag_{k}_orders"] for k in (1, 2, 3)] == [4, 2, 1]
    assert features[5]["rolling_3m"] == pytest.approx(7 / 3)
    assert features[6]["rolling_3m"] == pytest.approx(11 / 3)
    assert features[5]["num_customers"] == 1 and features[5]["total_revenue"] == 10.0
    assert got.encoder.labels == ["RJ", "SP"] and features[5]["state_enc"] == 1


def test_forecast_inputs_roll_over_the_year(spark):
    row = {
        "customer_state": "SP", "year": 2017, "month": 11, "order_count": 40, "lag_1_orders": 30,
        "lag_2_orders": 20, "lag_3_orders": 10, "rolling_3m": 20.0, "avg_order_val": 1.0,
        "avg_review": 4.0, "late_rate": 0.1, "avg_delivery": 9.0, "num_customers": 5,
        "state_enc": 0,
    }
    older = {**row, "month": 10, "order_count": 1}
    features = spark.createDataFrame(pd.DataFrame([older, row]))
    got = [r.asDict() for r in demand.forecast_inputs(features).orderBy("ahead").collect()]
    assert [(r["out_year"], r["out_month"]) for r in got] == [(2017, 12), (2018, 1), (2018, 2)]
    assert {r["year"] for r in got} == {2017}
    assert [r["quarter"] for r in got] == [4, 1, 1] and [r["is_q4"] for r in got] == [1, 0, 0]
    for r in got:
        assert [r[f"lag_{k}_orders"] for k in (1, 2, 3)] == [40, 30, 20]
        assert r["rolling_3m"] == 20.0
        assert r["month_sin"] == pytest.approx(math.sin(2 * math.pi * r["out_month"] / 12))


def test_split_is_repeatable_and_about_a_fifth(panel):
    sides = forecast.split(panel.features).select("customer_state", "year", "month", "is_test")
    again = forecast.split(panel.features.repartition(7)).select(*sides.columns)
    assert sides.exceptAll(again).count() == 0
    share = sides.agg(F.avg(F.col("is_test").cast("int"))).first()[0]
    assert 0.12 < share < 0.28


def test_folds_are_contiguous(panel):
    rows = forecast.contiguous_folds(panel.features).toPandas()
    rows = rows.sort_values(["customer_state", "year", "month"])
    n = len(rows)
    sizes = [n // 5 + (i < n % 5) for i in range(5)]
    assert rows["fold"].tolist() == [i for i, s in enumerate(sizes) for _ in range(s)]


def test_training(trained, spark):
    built, result = trained
    board = result.leaderboard.collect()
    assert {r["model"] for r in board} == {
        "Linear Regression", "Random Forest", "Gradient Boosting"
    }
    best = [r for r in board if r["is_best"]]
    assert len(best) == 1 and best[0]["r2"] == max(r["r2"] for r in board) > 0.9
    assert all(r["rmse"] >= r["mae"] >= 0 for r in board)
    got = forecast.forecast(built.features, result.model).collect()
    assert len(got) == 12 and all(r["predicted_orders"] >= 0 for r in got)
    assert [r["month"] for r in got[:3]] == [1, 2, 3] and got[0]["year"] == 2018


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (6.0, 5.0)], "order_count double, prediction double")
    got = forecast.regression_metrics(df)
    assert got["mae"] == pytest.approx(2 / 3) and got["rmse"] == pytest.approx(math.sqrt(2 / 3))
    assert got["r2"] == pytest.approx(1 - 2 / 14)


def test_feature_importance(trained, spark):
    built, _ = trained
    forest = {"Random Forest": forecast.default_models(trees=5)["Random Forest"]}
    fitted = forecast.train(built, forest, folds=2)
    rows = forecast.feature_importance(fitted.model, spark).collect()
    weights = [r["importance"] for r in rows]
    assert len(rows) == 12 and weights == sorted(weights, reverse=True) and sum(weights) <= 1.0001
    linear = {"Linear Regression": forecast.default_models()["Linear Regression"]}
    assert forecast.feature_importance(forecast.train(built, linear, 2).model, spark).count() == 0


@pytest.fixture(scope="module")
def clustered(spark):
    """Three clear groups by spend, on top of each other in the other measures."""
    rows = [
        (f"c{g}{i}", 10 * g + i % 3, g + 1, 1000.0 * g + i) for g in range(3) for i in range(30)
    ]
    schema = "customer_id string, recency int, frequency int, monetary double"
    base = spark.createDataFrame(rows, schema)
    return clusters.cluster_customers(base, ks=range(2, 5), restarts=2)


def test_clusters(clustered):
    assert clustered.best_k == 3
    labels = {
        r["customer_id"][:2]: r["cluster_label"] for r in clustered.customers.collect()
    }
    assert labels == {"c0": "Hibernating", "c1": "Promising", "c2": "Loyal"}
    curve = clustered.selection.collect()
    assert [r["k"] for r in curve] == [2, 3, 4]
    assert curve[0]["inertia"] > curve[1]["inertia"]
    assert all(-1 <= r["silhouette"] <= 1 for r in curve)
    profile = {r["cluster_label"]: r for r in clustered.profile.collect()}
    assert profile["Loyal"]["customers"] == 30 and profile["Loyal"]["avg_monetary"] == 2014.5


def test_inertia_is_in_population_units(spark):
    """Two points per cluster: scaled by the population deviation the inertia is known."""
    rows = [("a", 0, 0, 0.0), ("b", 0, 0, 1.0), ("c", 0, 0, 10.0), ("d", 0, 0, 11.0)]
    base = spark.createDataFrame(
        rows, "customer_id string, recency int, frequency int, monetary double"
    )
    got = clusters.cluster_customers(base, ks=[2], restarts=1).selection.first()
    variance = sum((v - 5.5) ** 2 for v in (0, 1, 10, 11)) / 4
    assert got["inertia"] == pytest.approx(1.0 / variance)


def test_clusters_beyond_the_names_stay_unnamed(spark):
    stage = clusters.label_stage({0: "Loyal"})
    df = spark.createDataFrame([(0,), (4,)], "cluster int")
    assert [r["cluster_label"] for r in stage.transform(df).collect()] == ["Loyal", None]


def demand_rows(spark):
    return spark.createDataFrame(
        [
            ("r1", "AA", "3", "2018", None),
            ("r2", "ZZ", "3", "2018", None),
            ("r3", None, "3", "2018", None),
            ("r4", "BB", None, "2018", None),
            ("r5", "BB", "x", "2018", None),
            ("r6", "CC", "12", "2018", "30"),
        ],
        "request_id string, state string, month string, year string, lag_1_orders string",
    )


def test_score_demand(trained, spark):
    scored = scoring.score_demand(demand_rows(spark), trained[1].model, keep=["request_id"])
    got = {r["request_id"]: r for r in scored.collect()}
    assert {k: r["error"] for k, r in got.items()} == {
        "r1": None, "r2": "Unknown state: ZZ", "r3": "Missing field: state",
        "r4": "Missing field: month", "r5": "Invalid field: month", "r6": None,
    }
    assert got["r1"]["predicted_orders"] >= 0 and got["r2"]["predicted_orders"] is None
    assert got["r1"]["confidence_note"] == scoring.DEMAND_NOTE and got["r6"]["month"] == 12
    valid, invalid = scoring.split_valid(scored)
    assert (valid.count(), invalid.count()) == (2, 4)


def test_defaults_fill_missing_fields(trained, spark):
    bare = spark.createDataFrame([("AA", 3, 2018)], "state string, month int, year int")
    full = bare.withColumns({k: F.lit(v) for k, v in scoring.DEMAND_DEFAULTS.items()})
    model = trained[1].model
    assert scoring.score_demand(bare, model).collect() == scoring.score_demand(full, model).collect()


def test_score_segment(clustered, spark):
    rows = spark.createDataFrame(
        [("r1", 20.0, 3.0, 2010.0), ("r2", 0.0, 1.0, None), ("r3", 1.0, 1.0, 5.0)],
        "request_id string, recency double, frequency double, monetary double",
    )
    got = {r["request_id"]: r for r in
           scoring.score_segment(rows, clustered.model, keep=["request_id"]).collect()}
    assert got["r1"]["segment"] == "Loyal" and got["r3"]["segment"] == "Hibernating"
    assert got["r1"]["recommendation"] == segments.REQUEST_ADVICE["Loyal"]
    assert got["r2"]["error"] == "Missing field: monetary" and got["r2"]["cluster"] is None
    assert got["r1"]["input_rfm"]["monetary"] == 2010.0


def test_models_survive_a_round_trip(trained, clustered, spark, tmp_path):
    save_model(trained[1].model, str(tmp_path / "demand"))
    save_model(clustered.model, str(tmp_path / "segments"))
    rows = demand_rows(spark)
    assert (
        scoring.score_demand(rows, load_model(str(tmp_path / "demand"))).collect()
        == scoring.score_demand(rows, trained[1].model).collect()
    )
    loaded = load_model(str(tmp_path / "segments"))
    customers = clustered.customers.select("customer_id", *clusters.MEASURES)
    assert loaded.transform(customers).where("cluster_label = 'Loyal'").count() == 30


def test_published_models_come_back_with_their_metrics(trained, clustered, spark, tmp_path):
    root = str(tmp_path)
    artifacts.publish_model(spark, root, clustered.model, {"k": clustered.best_k}, clusters.MEASURES)
    artifacts.publish_model(spark, root, trained[1].model, {"r2": 0.5}, demand.FEATURES)
    model, version = artifacts.current_model(spark, root)
    assert version.number == 2 and version.details == {"metrics": {"r2": 0.5}, "inputs": list(demand.FEATURES)}
    again = forecast.forecast(trained[0].features, model).collect()
    assert again == forecast.forecast(trained[0].features, trained[1].model).collect()


def test_streamed_scores_equal_batch_scores(trained, clustered, spark, tmp_path):
    requests = (
        '{"request_id": "r1", "state": "AA", "month": 3, "year": 2018, "lag_1_orders": 12.5}\n'
        '{"request_id": "r2", "state": "ZZ", "month": 3, "year": 2018}\n'
        "this is not JSON\n"
    )
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(requests)
    fields = ("request_id", *stream.DEMAND_FIELDS)
    incoming = stream.json_requests(spark, str(tmp_path / "in"), fields)

    def run():
        stream.start_scoring(
            incoming, scoring.score_demand, trained[1].model, str(tmp_path / "out"),
            str(tmp_path / "checkpoint"), keep=["request_id"],
        ).awaitTermination(120)
        return spark.read.parquet(str(tmp_path / "out"))

    batch = scoring.score_demand(
        scoring.parse_requests(spark.read.text(str(tmp_path / "in")), "value", fields),
        trained[1].model, keep=["request_id"],
    )
    first = run()
    assert first.count() == 3 and first.exceptAll(batch).count() == 0
    assert {r["error"] for r in first.collect()} == {
        None, "Unknown state: ZZ", "Missing field: state"
    }
    (tmp_path / "in" / "b.json").write_text('{"request_id": "r4", "state": "BB", "month": 1, "year": 2018}\n')
    assert run().count() == 4  # earlier files are not scored again


def test_streamed_segments_equal_batch(clustered, spark, tmp_path):
    customers = clustered.customers.select("customer_id", *clusters.MEASURES)
    customers.write.parquet(str(tmp_path / "in"))
    incoming = stream.table_requests(spark, str(tmp_path / "in"), customers.schema)
    stream.start_scoring(
        incoming, scoring.score_segment, clustered.model, str(tmp_path / "out"),
        str(tmp_path / "checkpoint"), keep=["customer_id"],
    ).awaitTermination(120)
    batch = scoring.score_segment(customers, clustered.model, keep=["customer_id"])
    streamed = spark.read.parquet(str(tmp_path / "out"))
    assert streamed.count() == 90 and streamed.exceptAll(batch).count() == 0


def test_a_failed_batch_counts_once(clustered, spark, tmp_path):
    """The second batch breaks and is written again: no request is lost or there twice."""
    for n, value in enumerate(["5", "often", "9"]):
        part = spark.createDataFrame([(n, "3", value, "20.0")], "request_id int, recency string, frequency string, monetary string")
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    incoming = stream.table_requests(spark, str(tmp_path / "in"), part.schema, files_per_batch=1)

    def broken(requests, model, keep):
        bad = F.when(F.col("request_id") == 1, F.raise_error(F.lit("no power")).cast("int")).otherwise(F.col("request_id"))
        return scoring.score_segment(requests.withColumn("request_id", bad), model, keep)

    def run(score):
        return stream.start_split_scoring(
            incoming, score, clustered.model, str(tmp_path / "out"), str(tmp_path / "checkpoint"), ["request_id"]
        ).awaitTermination(120)

    with pytest.raises(Exception, match="no power"):
        run(broken)
    for _ in range(2):
        run(scoring.score_segment)
        scored, refused = stream.outcomes(spark, str(tmp_path / "out"))
        assert sorted(r.request_id for r in scored.collect()) == [0, 2]
        assert [(r.request_id, r.error) for r in refused.collect()] == [(1, "Invalid field: frequency")]


def test_advice(spark, raw):
    spend = etl.build_master(raw, with_customers=False)
    scored = rfm.add_advice(rfm.score_by_rules(rfm.rfm_base(spend)))
    for r in scored.select("rfm_segment", "recommendation").distinct().collect():
        assert r["recommendation"] == segments.SEGMENT_ADVICE[r["rfm_segment"]]
    assert derive_orders(raw["orders"]).count() == raw["orders"].count()
