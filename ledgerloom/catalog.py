"""Every query of the library, runnable on a folder of the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.segments import CLUSTER_NAMES
from ledgerloom.operators import kmeans, least_squares, ordered
from ledgerloom.operators import orders as op
from ledgerloom.plans import (
    clusters, contingency, demand, eda, etl, experiments, forecast, reports, rfm, scoring, sketches,
)
from ledgerloom.session import delete_at_exit, scratch_root, spool
from ledgerloom.sources import benchmark_tables as bench
from ledgerloom.sources import artifacts, raw_files, tables
from ledgerloom.streaming import requests as stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _master(spark: SparkSession, folder: str, customers: bool = False) -> DataFrame:
    sides = [bench.orders, bench.order_items, bench.order_payments, bench.order_reviews]
    if customers:
        sides.append(bench.customers)
    tables = {side.__name__: side(spark, folder) for side in sides}
    return etl.build_master(tables, with_customers=customers)


def _rfm_base(spark: SparkSession, folder: str, with_service: bool = False) -> DataFrame:
    snapshot = etl.snapshot_time(bench.orders(spark, folder))
    return rfm.rfm_base(_master(spark, folder), snapshot, with_service=with_service)


def _units(spark: SparkSession, folder: str) -> DataFrame:
    return bench.experiment(spark, folder)


# ---- tables ---------------------------------------------------------------------------------

@query
def master(spark, folder):
    return _rounded(
        _master(spark, folder, customers=True),
        order_value=6, avg_price=6, total_payment=6, review_score=6,
    )


@query
def processed_orders(spark, folder):
    return op.delivered_orders(bench.orders(spark, folder))


@query
def processed_items(spark, folder):
    items = op.item_totals(bench.order_items(spark, folder))
    return _rounded(items, freight_value=6, item_total=6)


@query
def payments_per_order(spark, folder):
    return _rounded(op.payments_per_order(bench.order_payments(spark, folder)), total_payment=6)


@query
def reviews_per_order(spark, folder):
    return op.reviews_per_order(bench.order_reviews(spark, folder))


@query
def items_per_order(spark, folder):
    return _rounded(
        op.items_per_order(bench.order_items(spark, folder)), order_value=6, avg_price=6
    )


@query
def rfm_base(spark, folder):
    return _rounded(_rfm_base(spark, folder), monetary=6)


@query
def rfm_etl_scored(spark, folder):
    return _rounded(rfm.score_by_quartiles(_rfm_base(spark, folder), ties="value"), monetary=6)


@query
def rfm_ml_scored(spark, folder):
    scored = rfm.score_by_rules(_rfm_base(spark, folder, with_service=True))
    return _rounded(scored, monetary=6, avg_review=6, late_rate=6)


@query
def rfm_recommendations(spark, folder):
    scored = rfm.add_advice(rfm.score_by_rules(_rfm_base(spark, folder)))
    return scored.select("customer_id", "rfm_score", "rfm_segment", "recommendation")


@query
def rfm_segment_counts(spark, folder):
    return eda.value_counts(rfm.score_by_rules(_rfm_base(spark, folder)), "rfm_segment")


# ---- the twelve reports -----------------------------------------------------------------------

@query
def q01_monthly_revenue(spark, folder):
    return reports.monthly_revenue(_master(spark, folder))


@query
def q02_top_states(spark, folder):
    return reports.top_states(_master(spark, folder, customers=True))


@query
def q03_payment_mix(spark, folder):
    return reports.payment_mix(_master(spark, folder))


@query
def q04_delivery_by_state(spark, folder):
    return reports.delivery_by_state(_master(spark, folder, customers=True))


@query
def q05_review_vs_delivery(spark, folder):
    return reports.review_vs_delivery(_master(spark, folder))


@query
def q06_hourly(spark, folder):
    return reports.hourly_pattern(_master(spark, folder))


@query
def q07_weekday(spark, folder):
    return reports.weekday_pattern(_master(spark, folder))


@query
def q08_top_customers(spark, folder):
    return reports.top_customers(_master(spark, folder), exact=True)


@query
def q08_top_customers_approx(spark, folder):
    return reports.top_customers(_master(spark, folder))


@query
def q08_edge_error(spark, folder):
    """How far the approximate report's percentile is off, in ranks."""
    spend = reports.customer_spend(_master(spark, folder))
    return _rounded(sketches.edge_error(spend, "total_spend", 0.95).drop("rank_error"), share=6)


def _stored_sketches(spark, folder):
    """The sketches of all months, stored and read back, and the orders behind them."""
    orders = spool(_master(spark, folder).select("year", "month", "customer_id", "total_payment"), "sketched")
    path = f"{scratch_root(spark)}/sketches-{uuid.uuid4().hex}"
    sketches.store(sketches.by_month(orders), path)
    delete_at_exit(spark, path)
    return orders, sketches.read(spark, path)


@query
def month_sketches(spark, folder):
    _, stored = _stored_sketches(spark, folder)
    return sketches.merged(stored, ["year", "month"]).select("year", "month", "n")


@query
def year_quantile_errors(spark, folder):
    """Quantiles of each year from its months' sketches: is their true rank within the tolerance?"""
    found = sketches.quantile_errors(*_stored_sketches(spark, folder))
    return found.select("year", "n", "share", "within")


@query
def year_customer_errors(spark, folder):
    """Customers of each year from its months' sketches: are they within the tolerance?"""
    found = sketches.customer_errors(*_stored_sketches(spark, folder))
    return found.select("year", "customers", "within")


@query
def q09_status_funnel(spark, folder):
    return reports.status_funnel(bench.orders(spark, folder))


@query
def q10_mom_growth(spark, folder):
    return reports.month_over_month(_master(spark, folder))


@query
def q11_segment_summary(spark, folder):
    return reports.segment_summary(rfm.score_by_quartiles(_rfm_base(spark, folder), ties="value"))


@query
def q12_campaign(spark, folder):
    return reports.campaign(
        _master(spark, folder), bench.experiment_assignments(spark, folder)
    )


# ---- exploration --------------------------------------------------------------------------------

@query
def shape_profile(spark, folder):
    return eda.shape_profile(bench.domain_tables(spark, folder))


@query
def null_profile(spark, folder):
    return eda.null_profile(bench.orders(spark, folder))


@query
def status_counts(spark, folder):
    return eda.value_counts(bench.orders(spark, folder), "order_status")


@query
def delivery_overview(spark, folder):
    return eda.delivery_overview(bench.orders(spark, folder))


@query
def monthly_trend(spark, folder):
    return _rounded(
        eda.monthly_trend(bench.orders(spark, folder), bench.order_payments(spark, folder)),
        revenue=4, revenue_millions=6,
    )


@query
def peak_month(spark, folder):
    return eda.peak_month(
        eda.monthly_trend(bench.orders(spark, folder), bench.order_payments(spark, folder))
    )


@query
def delivery_histogram(spark, folder):
    return eda.delivery_histogram(bench.orders(spark, folder))


@query
def late_split(spark, folder):
    return eda.late_split(bench.orders(spark, folder))


@query
def delivery_by_weekday(spark, folder):
    return _rounded(eda.delivery_by_weekday(bench.orders(spark, folder)), avg_days=6)


@query
def hourly_peak_flags(spark, folder):
    return eda.hourly_peaks(bench.orders(spark, folder))


@query
def peak_hour(spark, folder):
    return eda.peak_hour(bench.orders(spark, folder))


@query
def payment_type_rows(spark, folder):
    return _rounded(
        eda.payment_types(bench.order_payments(spark, folder)),
        total_value=4, avg_value=6, total_millions=6,
    )


@query
def review_dist(spark, folder):
    return eda.review_distribution(bench.order_reviews(spark, folder))


@query
def review_overview(spark, folder):
    return eda.review_overview(bench.order_reviews(spark, folder))


@query
def late_by_review_crosstab(spark, folder):
    return eda.late_by_review(bench.orders(spark, folder), bench.order_reviews(spark, folder))


@query
def state_stats(spark, folder):
    return _rounded(
        eda.state_stats(
            bench.orders(spark, folder),
            bench.order_payments(spark, folder),
            bench.customers(spark, folder),
        ),
        revenue=4, avg_delivery=6, revenue_millions=6,
    )


@query
def top_states_by_orders(spark, folder):
    return state_stats(spark, folder).select("customer_state", "orders", "revenue").limit(10)


@query
def distinct_states(spark, folder):
    return eda.distinct_values(bench.customers(spark, folder), "customer_state")


@query
def distinct_people(spark, folder):
    return eda.distinct_people(bench.customers(spark, folder))


def _preview(spark, folder):
    return eda.customer_preview(bench.orders(spark, folder), bench.order_payments(spark, folder))


@query
def rfm_preview(spark, folder):
    return _rounded(_preview(spark, folder), monetary=6)


@query
def rfm_histograms(spark, folder):
    return _rounded(
        eda.customer_histograms(_preview(spark, folder)), bin_low=6, bin_high=6
    )


@query
def rfm_describe(spark, folder):
    return eda.describe(_preview(spark, folder), ["recency", "frequency", "monetary"])


@query
def eda_summary(spark, folder):
    return eda.summary(bench.domain_tables(spark, folder))


# ---- demand ----------------------------------------------------------------------------------------

def _panel(spark, folder) -> demand.DemandPanel:
    return demand.build_features(_master(spark, folder, customers=True))


_PANEL_DIGITS = {
    "total_revenue": 4, "avg_order_val": 6, "avg_review": 6, "late_rate": 6, "avg_delivery": 6,
    "rolling_3m": 6, "month_sin": 6, "month_cos": 6,
}


@query
def demand_features(spark, folder):
    return _rounded(_panel(spark, folder).features, **_PANEL_DIGITS)


@query
def forecast_inputs(spark, folder):
    digits = {k: v for k, v in _PANEL_DIGITS.items() if k != "total_revenue"}
    return _rounded(demand.forecast_inputs(_panel(spark, folder).features), **digits)


# ---- experiments ------------------------------------------------------------------------------------

@query
def experiment_population(spark, folder):
    units = _units(spark, folder)
    both = experiments.population(
        units.where("variant = 'control'"), units.where("variant = 'test'")
    )
    return _rounded(both, revenue=6)


@query
def ab_metrics(spark, folder):
    return _rounded(
        experiments.metrics(_units(spark, folder)),
        total_revenue=4, avg_revenue=6, conversion_rate=6, revenue_per_user=6,
    )


@query
def ab_duplicate_units(spark, folder):
    return experiments.duplicate_units(_units(spark, folder), ["variant", "user_id"])


@query
def ab_ztest_stats(spark, folder):
    return _rounded(
        experiments.conversion_stats(_units(spark, folder)),
        control_cvr=6, test_cvr=6, lift_pct=6, z_stat=6,
    )


@query
def ab_welch_stats(spark, folder):
    return _rounded(
        experiments.revenue_stats(_units(spark, folder)),
        control_avg=6, test_avg=6, var_control=4, var_test=4, t_stat=6, degrees=4, lift_pct=6,
    )


@query
def ab_mannwhitney_stats(spark, folder):
    return _rounded(experiments.pages_stats(_units(spark, folder)), z_stat=6)


@query
def ab_daily_mannwhitney(spark, folder):
    return _rounded(experiments.pages_stats(_units(spark, folder), by=["day"]), z_stat=6)


@query
def ab_tests(spark, folder):
    return experiments.run_tests(spool(_units(spark, folder), "units"))


@query
def ab_chi_square(spark, folder):
    """Variant against pages seen and against conversion, over all days."""
    units = spool(_units(spark, folder), "units")
    found = [
        contingency.chi_square_test(units, "variant", column).withColumn("category", F.lit(column))
        for column in ("session_pages", "converted")
    ]
    return found[0].unionByName(found[1])


@query
def ab_daily_chi_square(spark, folder):
    stats = contingency.chi_square_stats(_units(spark, folder), "variant", "session_pages", by=["day"])
    return _rounded(stats, statistic=6)


@query
def power_check(spark, folder):
    return _rounded(
        experiments.power_check(_units(spark, folder), by=["day"]), control_cvr=6
    )


@query
def revenue_p99(spark, folder):
    limits = ordered.quantiles(_units(spark, folder), "revenue", [0.99], by=["variant"])
    return _rounded(limits.select("variant", "n", F.col("quantiles")[0].alias("p99")), p99=6)


@query
def revenue_histogram(spark, folder):
    units = spool(_units(spark, folder).select("variant", "revenue"), "units")
    return _rounded(experiments.revenue_histogram(units), bin_low=6, bin_high=6)


@query
def kpi_records(spark, folder):
    """All metrics, stored as a table, read back as records. Money is rounded to whole units."""
    rows = experiments.metrics(_units(spark, folder)).select(
        "variant", "users", "conversions",
        *[F.round(c).cast("bigint").alias(c) for c in ("total_revenue", "avg_revenue")],
        F.round("conversion_rate", 4).alias("conversion_rate"),
        F.round("revenue_per_user").cast("bigint").alias("revenue_per_user"),
    )
    folder = f"{scratch_root(spark)}/kpi-{uuid.uuid4().hex}"
    tables.write_table(rows, f"{folder}/ab_metrics")
    delete_at_exit(spark, folder)
    records = experiments.kpi_records(tables.read_table(spark, folder, "ab_metrics"))
    return records.select("record", F.col("last_updated").isNotNull().alias("has_time"))


# ---- models -------------------------------------------------------------------------------------------
# Fits take minutes; the queries of a session share them.

_fits: dict[tuple, object] = {}


def _shared_fit(kind: str, spark, folder, fit):
    key = (kind, spark.sparkContext.applicationId, folder)
    if key not in _fits:
        _fits[key] = fit()
    return _fits[key]


def _training(spark, folder) -> tuple[demand.DemandPanel, forecast.DemandTraining]:
    def fit():
        panel = _panel(spark, folder)
        return panel, forecast.train(panel)

    return _shared_fit("demand", spark, folder, fit)


@query
def demand_leaderboard(spark, folder):
    return _training(spark, folder)[1].leaderboard


@query
def feature_importance(spark, folder):
    return forecast.feature_importance(_training(spark, folder)[1].model, spark)


@query
def demand_forecast(spark, folder):
    panel, trained = _training(spark, folder)
    return forecast.forecast(panel.features, trained.model)


def _clustering(spark, folder) -> clusters.Clustering:
    return _shared_fit(
        "clusters", spark, folder, lambda: clusters.cluster_customers(_rfm_base(spark, folder))
    )


@query
def cluster_selection(spark, folder):
    return _clustering(spark, folder).selection


@query
def customer_clusters(spark, folder):
    return _clustering(spark, folder).customers


@query
def cluster_profile(spark, folder):
    return _clustering(spark, folder).profile


# ---- scoring ------------------------------------------------------------------------------------------

def _demand_requests(spark, folder) -> DataFrame:
    """One request per customer: next month in the customer's state. Regions in place of states,
    and customers without a state, make requests that cannot be served."""
    nations = bench.read_source(spark, folder, "nation")
    regions = bench.read_source(spark, folder, "region")
    people = (
        bench.read_source(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    state = (
        F.when(segment == "MACHINERY", F.col("r_name"))
        .when(segment != "BUILDING", F.col("n_name"))
    )
    return people.select(
        key.alias("request_id"),
        state.alias("state"),
        F.when(F.col("c_acctbal") >= 0, key % 12 + 1).cast("int").alias("month"),
        F.lit(2001).alias("year"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("avg_order_val"),
    )


@query
def request_validation(spark, folder):
    encoder = demand.fit_state_encoder(distinct_states(spark, folder))
    return scoring.validate_demand(_demand_requests(spark, folder), encoder)


def _segment_requests(spark, folder) -> DataFrame:
    """One request per customer as text fields, some missing and some unreadable."""
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    return bench.read_source(spark, folder, "customer").select(
        key.alias("request_id"),
        F.when(segment != "MACHINERY", (key % 90).cast("string")).alias("recency"),
        F.when(segment == "BUILDING", "often").otherwise((key % 7 + 1).cast("string")).alias("frequency"),
        F.when(key % 11 > 0, F.concat(key.cast("string"), F.lit(".5"))).alias("monetary"),
    )


@query
def segment_request_validation(spark, folder):
    return scoring.validate_segment(_segment_requests(spark, folder))


@query
def score_demand(spark, folder):
    model = _training(spark, folder)[1].model
    return scoring.score_demand(_demand_requests(spark, folder), model, keep=["request_id"])


@query
def score_segment(spark, folder):
    model = _clustering(spark, folder).model
    return scoring.score_segment(_rfm_base(spark, folder), model, keep=["customer_id"])


@query
def score_segment_stream(spark, folder):
    """The customers as a stream of request files; the scores are read back from the sink."""
    place = f"{scratch_root(spark)}/stream-{uuid.uuid4().hex}"
    delete_at_exit(spark, place)
    model = _clustering(spark, folder).model
    customers = _rfm_base(spark, folder)
    customers.write.parquet(f"{place}/in")
    incoming = stream.table_requests(spark, f"{place}/in", customers.schema)
    stream.start_scoring(
        incoming, scoring.score_segment, model, f"{place}/out", f"{place}/checkpoint",
        keep=["customer_id"],
    ).awaitTermination()
    return spark.read.parquet(f"{place}/out")


@query
def split_segment_stream(spark, folder):
    """Requests as a stream, scored by given centres: how many were scored, and why others were not."""
    place = f"{scratch_root(spark)}/split-{uuid.uuid4().hex}"
    delete_at_exit(spark, place)
    rows = _segment_requests(spark, folder)
    rows.write.parquet(f"{place}/in")
    nearest = clusters.cluster_stage([40.0, 4.0, 700.0], [25.0, 2.0, 400.0], FIXED_CENTRES)
    model = PipelineModel([nearest, clusters.label_stage(dict(enumerate(CLUSTER_NAMES)))])
    incoming = stream.table_requests(spark, f"{place}/in", rows.schema, files_per_batch=1)
    stream.start_split_scoring(
        incoming, scoring.score_segment, model, f"{place}/out", f"{place}/checkpoint", keep=["request_id"]
    ).awaitTermination()
    scored, refused = stream.outcomes(spark, f"{place}/out")
    both = scored.select(F.lit("scored").alias("outcome"), "error").unionByName(
        refused.select(F.lit("refused").alias("outcome"), "error")
    )
    return both.groupBy("outcome", "error").agg(F.count("*").alias("n"))


# ---- whole jobs ---------------------------------------------------------------------------------------

def _written_and_read(spark, df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    folder = f"{scratch_root(spark)}/job-{uuid.uuid4().hex}"
    delete_at_exit(spark, folder)
    tables.write_table(df, f"{folder}/{name}", fmt)
    return tables.read_table(spark, folder, name, fmt, schema=df.schema)


@query
def customer_segments(spark, folder):
    """Scores, rule segment, cluster, its name and advice per customer, written as CSV and read."""
    clustered = _clustering(spark, folder).customers.select("customer_id", "cluster", "cluster_label")
    scored = rfm.add_advice(rfm.score_by_rules(_rfm_base(spark, folder)))
    return _written_and_read(spark, scored.join(clustered, "customer_id"), "customer_segments", "csv")


@query
def experiment_report(spark, folder):
    """Metrics, decisions and sample size of the experiment in long form, written as CSV and read."""
    found = experiments.report(spool(_units(spark, folder), "units"))
    return _written_and_read(
        spark, _rounded(found, control_value=6, test_value=6), "experiment_report", "csv"
    )


@query
def demand_job(spark, folder):
    """The whole demand job: the trained model is published with its metrics, read back, and its
    forecast is written as CSV and read."""
    panel, trained = _training(spark, folder)
    root = f"{scratch_root(spark)}/demand-{uuid.uuid4().hex}"
    delete_at_exit(spark, root)
    best = trained.leaderboard.where("is_best").first().asDict()
    artifacts.publish_model(spark, root, trained.model, best, demand.FEATURES)
    model, version = artifacts.current_model(spark, root)
    rows = forecast.forecast(panel.features, model).withColumn("model", F.lit(version.details["metrics"]["model"]))
    return _written_and_read(spark, rows, "demand_forecast", "csv")


@query
def cluster_job(spark, folder):
    """The whole segmentation job: the model is published with its curve and read back, and the
    summary of the clusters it gives is written as CSV and read."""
    found = _clustering(spark, folder)
    root = f"{scratch_root(spark)}/clusters-{uuid.uuid4().hex}"
    delete_at_exit(spark, root)
    curve = {str(r["k"]): r["silhouette"] for r in found.selection.collect()}
    artifacts.publish_model(spark, root, found.model, {"k": found.best_k, "silhouettes": curve}, clusters.MEASURES)
    model, version = artifacts.current_model(spark, root)
    summary = clusters.cluster_profile(model.transform(_rfm_base(spark, folder)))
    summary = summary.withColumn("k", F.lit(version.details["metrics"]["k"]))
    return _written_and_read(spark, summary, "cluster_summary", "csv")


def _etl(spark, folder) -> tuple[str, tables.EtlRun]:
    def run():
        root = f"{scratch_root(spark)}/etl-{uuid.uuid4().hex}"
        delete_at_exit(spark, root)
        return root, tables.run_etl(spark, bench.domain_tables(spark, folder), root, ties="rank")

    return _shared_fit("etl", spark, folder, run)


@query
def etl_record(spark, folder):
    """What the ETL counted while it ran."""
    record = _etl(spark, folder)[1].record
    return spark.createDataFrame(sorted(record.items()), "counted string, n long")


@query
def stored_master_by_sql(spark, folder):
    """Plain SQL over the stored tables where they lie."""
    root, _ = _etl(spark, folder)
    name = f"stored_{uuid.uuid4().hex}"
    tables.register_external(spark, root, ["master", "orders"], name)
    return spark.sql(
        f"SELECT m.year, m.month, COUNT(*) AS n, CAST(SUM(m.is_late) AS BIGINT) AS late "
        f"FROM {name}.master m JOIN {name}.orders o ON m.order_id = o.order_id "
        f"WHERE m.year BETWEEN 1993 AND 1996 GROUP BY m.year, m.month"
    )


@query
def raw_landing(spark, folder):
    """Orders as raw text files, landed unchanged, read again and counted per status and month."""
    orders = bench.orders(spark, folder)
    place = f"{scratch_root(spark)}/raw-{uuid.uuid4().hex}"
    delete_at_exit(spark, place)
    texts = orders.select([F.col(c).cast("string") for c in orders.columns])
    tables.write_export(texts, f"{place}/in/orders")
    raw_files.land_raw(raw_files.scan_text(spark, f"{place}/in"), f"{place}/landed")
    landed = raw_files.load_raw(spark, f"{place}/landed")["orders"]
    month = F.date_format("order_purchase_timestamp", "yyyy-MM")
    return landed.groupBy("order_status", month.alias("month")).agg(
        F.count("*").alias("n"), F.count("order_delivered_customer_date").alias("delivered")
    )


@query
def stored_master_by_month(spark, folder):
    """The master table written by month, read back and counted."""
    place = f"{scratch_root(spark)}/stored-{uuid.uuid4().hex}"
    delete_at_exit(spark, place)
    tables.write_processed({"master": _master(spark, folder)}, place)
    master = tables.read_table(spark, place, "master")
    return master.groupBy("year", "month").agg(
        F.count("*").alias("n"), F.sum("is_late").cast("bigint").alias("late")
    )


# ---- fitted arithmetic with given numbers -------------------------------------------------------------

@query
def naive_forecast_metrics(spark, folder):
    """Errors of the forecast that repeats the month before."""
    features = _panel(spark, folder).features.withColumn("prediction", F.col("lag_1_orders"))
    found = forecast.metric_columns(features)
    return _rounded(found, mae=6, rmse=6, r2=6)


@query
def demand_folds(spark, folder):
    folds = forecast.contiguous_folds(_panel(spark, folder).features)
    return folds.groupBy("fold").agg(
        F.count("*").alias("n"),
        F.min(F.struct("customer_state", "year", "month")).alias("first"),
    ).select("fold", "n", "first.*")


@query
def fixed_model_forecast(spark, folder):
    """The forecast of a linear model with given coefficients."""
    panel = _panel(spark, folder)
    rule = "0.61 * lag_1_orders + 0.13 * rolling_3m + 0.29 * month - 37.3"
    return forecast.forecast(panel.features, _given_model(panel.encoder, rule))


@query
def fixed_model_scores(spark, folder):
    """Scores of demand requests by a linear model with given coefficients."""
    encoder = demand.fit_state_encoder(distinct_states(spark, folder))
    rule = "0.001 * avg_order_val + 3.17 * month + 0.37 * state_enc + 0.01 * num_customers - 20.13"
    model = _given_model(encoder, rule)
    return scoring.score_demand(_demand_requests(spark, folder), model, keep=["request_id"])


def _given_model(encoder, rule: str) -> PipelineModel:
    statement = f"SELECT *, CAST({rule} AS DOUBLE) AS prediction FROM __THIS__"
    return PipelineModel([encoder, SQLTransformer(statement=statement)])


@query
def scaled_measures(spark, folder):
    """Mean and population deviation that standardisation uses."""
    measures = _rfm_base(spark, folder).unpivot(
        [], [F.col(c).cast("double").alias(c) for c in clusters.MEASURES], "measure", "value"
    )
    return _rounded(
        measures.groupBy("measure").agg(
            F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation")
        ),
        mean=6, deviation=6,
    )


@query
def demand_covariances(spark, folder):
    """The sums from which a linear demand model is solved, pair by pair."""
    columns = ["lag_1_orders", "lag_2_orders", "month", demand.TARGET]
    found = least_squares.covariances(_panel(spark, folder).features, columns)
    pairs = [c for c in found.columns if c.startswith("cov_")]
    return _rounded(found.unpivot(["n"], pairs, "pair", "covariance"), covariance=6)


@query
def linear_demand(spark, folder):
    """A linear demand model from those sums: coefficients by input."""
    found = least_squares.fit(_panel(spark, folder).features, ["lag_1_orders"], demand.TARGET)
    rows = [("lag_1_orders", found.coefficients[0], found.r2), ("intercept", found.intercept, found.r2)]
    return _rounded(spark.createDataFrame(rows, "input string, coefficient double, r2 double"), coefficient=6, r2=6)


FIXED_CENTRES = [[-0.8, 0.9, 1.1], [0.3, -0.2, -0.1], [1.7, -1.1, -1.3]]


@query
def fixed_centre_clusters(spark, folder):
    """Clusters by given centres in standardised units, and their squared distances."""
    base = spool(_rfm_base(spark, folder), "rfm")
    values = [F.col(c).cast("double") for c in clusters.MEASURES]
    found = base.agg(*[f(v) for v in values for f in (F.avg, F.stddev_pop)]).first()
    stage = clusters.cluster_stage(found[0::2], found[1::2], FIXED_CENTRES)
    scaled = [(v - m) / d for v, m, d in zip(values, found[0::2], found[1::2])]
    nearest = F.array_min(kmeans.squared_distances(scaled, FIXED_CENTRES))
    clustered = stage.transform(base.withColumn("distance", nearest))
    return _rounded(
        clustered.groupBy("cluster").agg(F.count("*").alias("customers"), F.sum("distance").alias("inertia")), inertia=6
    )


@query
def rule_cluster_profile(spark, folder):
    """Profile and spend order of clusters given by a rule on the key, named by mean spend."""
    customers = _rfm_base(spark, folder).withColumn("cluster", (F.col("customer_id") % 4).cast("int"))
    order = Window.orderBy("avg_monetary", "cluster")  # four rows
    names = clusters.mean_spend(customers).withColumn("place", F.row_number().over(order))
    label = F.element_at(F.array(*map(F.lit, CLUSTER_NAMES)), F.col("place"))
    named = customers.join(names.select("cluster", label.alias("cluster_label")), "cluster")
    return clusters.cluster_profile(named)


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round columns, so that engines that add numbers in another order give equal tables."""
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})
