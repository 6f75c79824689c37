"""Score request tables with trained models; the same code serves batch and streaming frames.

A request that cannot be scored stays in the output with a text in ``error`` and nulls instead of
results. There is one pass and no shuffle: bad rows are given neutral inputs for the model and
their results are blanked afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates, segments
from ledgerloom.functions.numbers import at_least_zero, even_round
from ledgerloom.plans.clusters import MEASURES

DEMAND_REQUIRED = ("state", "month", "year")

# What an optional field of a demand request counts as when it is missing.
DEMAND_DEFAULTS = {
    "lag_1_orders": 500.0,
    "lag_2_orders": 480.0,
    "lag_3_orders": 460.0,
    "rolling_3m": 480.0,
    "avg_order_val": 150.0,
    "avg_review": 4.0,
    "late_rate": 0.1,
    "avg_delivery": 12.0,
    "num_customers": 400.0,
}

_OPTIONAL_KINDS = {f: "int" if f == "num_customers" else "double" for f in DEMAND_DEFAULTS}

# Fixed value: the note that accompanies a demand prediction.
DEMAND_NOTE = "Based on Random Forest / Gradient Boosting model"


def parse_requests(df: DataFrame, column: str, fields: Sequence[str]) -> DataFrame:
    """One text column per field of a JSON object; absent fields and bad JSON give nulls."""
    parsed = F.from_json(F.col(column), "map<string,string>")
    others = [c for c in df.columns if c != column]
    return df.select(*others, parsed.alias("_json")).select(
        *others, *[F.try_element_at("_json", F.lit(f)).alias(f) for f in fields]
    )


def _field(df: DataFrame, name: str, kind: str) -> Column:
    """The field as ``kind``, null if absent or unreadable. Whole numbers may be written with a
    point (``3.0``) and are cut."""
    if name not in df.columns:
        return F.lit(None).cast(kind)
    value = F.col(name)
    return value.try_cast("double").try_cast(kind) if kind == "int" else value.try_cast(kind)


def _field_errors(df: DataFrame, fields: Sequence[str], kinds: dict[str, str]) -> list[Column]:
    """Per field a text if it is missing or unreadable, else null; in the order to report."""
    missing = [
        F.when(_field(df, f, "string").isNull(), F.lit(f"Missing field: {f}")) for f in fields
    ]
    unreadable = [
        F.when(_field(df, f, kinds[f]).isNull(), F.lit(f"Invalid field: {f}"))
        for f in fields
        if f in kinds
    ]
    return missing + unreadable


def validate_demand(requests: DataFrame, encoder: StringIndexerModel) -> DataFrame:
    """Adds ``error``: required fields present and readable, state among those the encoder was
    trained on, optional fields absent or readable."""
    state = _field(requests, "state", "string")
    coded = encoder.copy().setInputCol("_state").setOutputCol("_code").setHandleInvalid("keep")
    # An unknown or missing state gets the code behind the last one.
    checked = coded.transform(requests.withColumn("_state", state))
    unknown = F.when(
        F.col("_code") >= len(encoder.labels), F.concat(F.lit("Unknown state: "), F.col("_state"))
    )
    checks = _field_errors(requests, DEMAND_REQUIRED, {"month": "int", "year": "int"})
    missing, unreadable = checks[: len(DEMAND_REQUIRED)], checks[len(DEMAND_REQUIRED) :]
    optional = [
        F.when(
            _field(requests, f, "string").isNotNull() & _field(requests, f, kind).isNull(),
            F.lit(f"Invalid field: {f}"),
        )
        for f, kind in _OPTIONAL_KINDS.items()
    ]
    return checked.withColumn("error", F.coalesce(*missing, unknown, *unreadable, *optional)).drop(
        "_state", "_code"
    )


def validate_segment(requests: DataFrame) -> DataFrame:
    """Adds ``error``: the three measures present and readable."""
    checks = _field_errors(requests, MEASURES, {m: "double" for m in MEASURES})
    return requests.withColumn("error", F.coalesce(*checks))


def score_demand(
    requests: DataFrame, model: PipelineModel, keep: Sequence[str] = ()
) -> DataFrame:
    """Predicted orders per request; ``keep`` names request columns to carry along."""
    checked = validate_demand(requests, model.stages[0])
    month = F.coalesce(_field(requests, "month", "int"), F.lit(1))
    inputs = checked.select(
        *keep,
        "error",
        _field(requests, "state", "string").alias("customer_state"),
        _field(requests, "year", "int").alias("_year"),
        _field(requests, "month", "int").alias("_month"),
        F.coalesce(_field(requests, "year", "int"), F.lit(0)).alias("year"),
        month.alias("month"),
        *[c.alias(name) for name, c in dates.season_columns(month).items()],
        *[
            F.coalesce(_field(requests, f, _OPTIONAL_KINDS[f]).cast("double"), F.lit(default)).alias(f)
            for f, default in DEMAND_DEFAULTS.items()
        ],
    )
    predicted = at_least_zero(even_round(F.col("prediction"), 0)).cast("bigint")
    valid = F.col("error").isNull()
    return model.transform(inputs).select(
        *keep,
        F.col("customer_state").alias("state"),
        F.col("_year").alias("year"),
        F.col("_month").alias("month"),
        F.when(valid, predicted).alias("predicted_orders"),
        F.when(valid, F.lit(DEMAND_NOTE)).alias("confidence_note"),
        "error",
    )


def score_segment(
    requests: DataFrame, model: PipelineModel, keep: Sequence[str] = ()
) -> DataFrame:
    """Cluster, its trained name and advice per request."""
    checked = validate_segment(requests)
    given = F.struct(*[_field(requests, m, "double").alias(m) for m in MEASURES])
    inputs = checked.select(
        *keep,
        "error",
        given.alias("input_rfm"),
        *[F.coalesce(_field(requests, m, "double"), F.lit(0.0)).alias(m) for m in MEASURES],
    )
    valid = F.col("error").isNull()
    segment = F.coalesce("cluster_label", F.concat(F.lit("Cluster "), F.col("cluster")))
    advice = segments.lookup(segment, segments.REQUEST_ADVICE, segments.REQUEST_ADVICE_DEFAULT)
    return model.transform(inputs).select(
        *keep,
        F.when(valid, F.col("cluster")).alias("cluster"),
        F.when(valid, segment).alias("segment"),
        F.when(valid, advice).alias("recommendation"),
        "input_rfm",
        "error",
    )


def split_valid(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with and without a result."""
    return scored.where(F.col("error").isNull()), scored.where(F.col("error").isNotNull())
