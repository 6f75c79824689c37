"""Monthly demand per state: the feature panel and the inputs of a forecast."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import dates
from ledgerloom.session import spool

TARGET = "order_count"

# Model inputs, in the order the feature vector holds them.
FEATURES = (
    "year", "month", "quarter", "is_q4", "month_sin", "month_cos", "state_enc",
    "lag_1_orders", "lag_2_orders", "lag_3_orders", "rolling_3m",
    "avg_order_val", "avg_review", "late_rate", "avg_delivery", "num_customers",
)


class DemandPanel(NamedTuple):
    features: DataFrame
    encoder: StringIndexerModel


def monthly_demand(master: DataFrame) -> DataFrame:
    """One row per month and state. The distinct count makes Spark reduce by (month, state,
    customer) first, so a state with much of the data is still spread over many tasks."""
    return (
        master.dropna(subset=["year", "month", "customer_state"])
        .groupBy("year", "month", "customer_state")
        .agg(
            F.count("order_id").alias("order_count"),
            F.coalesce(F.sum("total_payment"), F.lit(0.0)).alias("total_revenue"),
            F.avg("total_payment").alias("avg_order_val"),
            F.avg("review_score").alias("avg_review"),
            F.avg("is_late").alias("late_rate"),
            F.avg("delivery_days").alias("avg_delivery"),
            F.countDistinct("customer_id").alias("num_customers"),
        )
    )


def with_lags(panel: DataFrame) -> DataFrame:
    """Orders of the three previous rows of a state and their mean. Rows, not calendar months:
    a month without orders has no row and is skipped. A group holds one row per month."""
    history = Window.partitionBy("customer_state").orderBy("year", "month")
    last_three = history.rowsBetween(-3, -1)
    lags = {f"lag_{k}_orders": F.lag("order_count", k).over(history) for k in (1, 2, 3)}
    rolling = F.when(
        F.count("order_count").over(last_three) == 3, F.avg("order_count").over(last_three)
    )
    return panel.withColumns({**lags, "rolling_3m": rolling})


def fit_state_encoder(panel: DataFrame, output: str = "state_enc") -> StringIndexerModel:
    """State to its position in alphabetical order; unseen states get one extra code."""
    return StringIndexer(
        inputCol="customer_state",
        outputCol=output,
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    ).fit(panel)


def build_features(master: DataFrame) -> DemandPanel:
    """The feature panel, complete rows only, and the state encoder fitted on all states.

    The monthly aggregate is spooled: it is tiny next to ``master``, and the encoder, the
    training runs and the forecast all read it.
    """
    panel = spool(monthly_demand(master), "panel")
    encoder = fit_state_encoder(panel)
    seasonal = with_lags(panel).withColumns(dates.season_columns(F.col("month")))
    encoded = encoder.transform(seasonal).withColumn("state_enc", F.col("state_enc").cast("int"))
    return DemandPanel(encoded.dropna("any"), encoder)


def latest_per_state(features: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct(*features.columns), F.struct("year", "month"))
    return features.groupBy("customer_state").agg(newest.alias("row")).select("row.*")


def forecast_inputs(features: DataFrame, horizon: int = 3) -> DataFrame:
    """Model inputs for the months after each state's latest row.

    Lags move up once and then stay flat over the horizon; the rolling mean is carried over.
    The ``year`` input stays the latest row's year even where the forecast month (reported in
    ``out_year``) lies in the next one.
    """
    ahead = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("ahead")
    rows = latest_per_state(features).select("*", ahead)
    target = dates.month_ahead(F.col("year"), F.col("month"), F.col("ahead"))
    season = dates.season_columns(F.col("out_month"))
    return (
        rows.withColumns({"out_year": F.year(target), "out_month": F.month(target)})
        .select(
            "customer_state",
            "ahead",
            "out_year",
            "out_month",
            "year",
            F.col("out_month").alias("month"),
            *[c.alias(name) for name, c in season.items()],
            "state_enc",
            F.col("order_count").alias("lag_1_orders"),
            F.col("lag_1_orders").alias("lag_2_orders"),
            F.col("lag_2_orders").alias("lag_3_orders"),
            "rolling_3m",
            "avg_order_val",
            "avg_review",
            "late_rate",
            "avg_delivery",
            "num_customers",
        )
    )
