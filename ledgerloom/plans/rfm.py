"""Recency / frequency / monetary tables and their scores."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates, segments
from ledgerloom.operators import ordered
from ledgerloom.session import spool

_QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)


def rfm_base(
    master: DataFrame,
    snapshot: Column | None = None,
    customer_col: str = "customer_id",
    with_service: bool = False,
) -> DataFrame:
    """Days since the last purchase, number of orders and spend per customer.

    ``with_service`` adds the mean review score and the share of late orders. ``snapshot``
    defaults to the latest purchase in ``master``; pass a scalar from a narrower source when
    ``master`` is not stored. A customer with very many orders is reduced on the map side.
    """
    if snapshot is None:
        snapshot = master.agg(F.max("order_purchase_timestamp").alias("t")).scalar()
    measures = [
        F.max("order_purchase_timestamp").alias("_last"),
        F.count("order_id").alias("frequency"),
        F.coalesce(F.sum("total_payment"), F.lit(0.0)).alias("monetary"),
    ]
    extra = []
    if with_service:
        extra = ["avg_review", "late_rate"]
        measures += [
            F.avg("review_score").alias("avg_review"),
            F.avg("is_late").alias("late_rate"),
        ]
    grouped = master.where(F.col(customer_col).isNotNull()).groupBy(customer_col).agg(*measures)
    return grouped.select(
        customer_col,
        dates.whole_days(snapshot, F.col("_last")).alias("recency"),
        "frequency",
        "monetary",
        *extra,
    )


def _quartile_edges(base: DataFrame, columns: list[str]) -> dict[str, list[float]]:
    """All five quartile edges of each column of a stored table."""
    values = base.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "feature", "value"
    )
    rows = ordered.quantiles(values, "value", _QUARTILES, by=["feature"], stored=True).collect()
    return {r["feature"]: list(r["quantiles"]) for r in rows}


def _edges_and_cuts(
    base: DataFrame, columns: list[str], customer_col: str
) -> tuple[dict[str, list[float]], Column]:
    """Quartile edges of ``columns`` and the frequency score by rank, found at the same time."""
    run = inheritable_thread_target(base.sparkSession)
    with ThreadPoolExecutor(2) as pool:
        edges = pool.submit(run(_quartile_edges), base, columns)
        score = pool.submit(run(_rank_score), base, customer_col)
        return edges.result(), score.result()


def _inner(edges: dict[str, list[float]], column: str) -> list[float]:
    """The three inner edges; coinciding edges leave a score undefined."""
    found = edges.get(column, [])
    if len(set(found)) < len(found):
        raise ValueError(f"quartile edges of {column} are not unique: {found}")
    return found[1:-1]


def _rank_score(base: DataFrame, customer_col: str) -> Column:
    order = ["frequency", customer_col]
    return ordered.first_rank_score(order, ordered.first_rank_cuts(base, order))


def score_by_quartiles(
    base: DataFrame, ties: str, customer_col: str = "customer_id"
) -> DataFrame:
    """Quartile scores per dimension, their sum and the three-way interval segment.

    ``ties`` says how frequency is scored. ``value``: quartiles of the count, an error if many
    equal counts make two edges coincide. ``rank``: quartiles of the rank, ties by customer.

    The customer table is spooled: quartile edges and scores must come from the same sums.
    """
    if ties not in ("value", "rank"):
        raise ValueError(f"unknown ties policy: {ties}")
    base = spool(base, "rfm")
    if ties == "rank":
        edges, frequency_score = _edges_and_cuts(base, ["recency", "monetary"], customer_col)
    else:
        edges, frequency_score = _quartile_edges(base, ["recency", "frequency", "monetary"]), None
    scored = base.withColumns(
        {
            "recency_score": ordered.quantile_score(
                "recency", _inner(edges, "recency"), best_low=True
            ),
            "frequency_score": ordered.quantile_score("frequency", _inner(edges, "frequency"))
            if frequency_score is None
            else frequency_score,
            "monetary_score": ordered.quantile_score("monetary", _inner(edges, "monetary")),
        }
    ).withColumn(
        "rfm_score",
        F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"),
    )
    return scored.withColumn("segment", segments.segment_by_interval(F.col("rfm_score")))


def score_by_rules(base: DataFrame, customer_col: str = "customer_id") -> DataFrame:
    """R, F and M scores (frequency by rank), their sum and the four-way rule segment."""
    base = spool(base, "rfm")
    edges, frequency_score = _edges_and_cuts(base, ["recency", "monetary"], customer_col)
    scored = base.withColumns(
        {
            "R": ordered.quantile_score("recency", _inner(edges, "recency"), best_low=True),
            "F": frequency_score,
            "M": ordered.quantile_score("monetary", _inner(edges, "monetary")),
        }
    ).withColumn("rfm_score", F.col("R") + F.col("F") + F.col("M"))
    return scored.withColumn("rfm_segment", segments.segment_by_rules(F.col("rfm_score")))


def add_advice(scored: DataFrame) -> DataFrame:
    return scored.withColumn(
        "recommendation", segments.lookup(F.col("rfm_segment"), segments.SEGMENT_ADVICE)
    )
