"""Segment labels and recommendations derived from RFM scores."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names given to clusters in ascending order of mean spend.
CLUSTER_NAMES = ("Hibernating", "Promising", "Loyal", "Champions")

# What to do with a rule-based segment (batch output).
SEGMENT_ADVICE = {
    "Champions": "Reward with loyalty program. Ask for reviews. Early access to new products.",
    "Loyal Customers": "Upsell higher-value products. Offer membership benefits.",
    "Promising": "Send personalized recommendations. Offer first-time bundle deals.",
    "At-Risk": "Send win-back email campaign with discount. Survey for dissatisfaction.",
    "Hibernating": "Send aggressive re-engagement offer. Consider removing from active list.",
    "Lost": "Final re-engagement attempt. Otherwise suppress from campaigns.",
}

# What to do with a scored request's cluster (scoring output).
REQUEST_ADVICE = {
    "Champions": "Reward with loyalty program. Early access to new products.",
    "Loyal": "Upsell higher-value products. Offer membership benefits.",
    "Promising": "Send personalized recommendations. Offer bundle deals.",
    "Hibernating": "Send aggressive re-engagement offer with discount.",
}
REQUEST_ADVICE_DEFAULT = "Monitor and engage."


def segment_by_rules(score: Column) -> Column:
    """Four-way ladder on the summed score."""
    # Limits and names.
    return (
        F.when(score >= 10, "Champions")
        .when(score >= 7, "Loyal Customers")
        .when(score >= 5, "At-Risk")
        .otherwise("Lost")
    )


def segment_by_interval(score: Column) -> Column:
    """Right-closed intervals (2,5], (5,8], (8,12]; anything else is null."""
    # Limits and names.
    return (
        F.when((score > 2) & (score <= 5), "At-Risk")
        .when((score > 5) & (score <= 8), "Potential")
        .when((score > 8) & (score <= 12), "Champions")
    )


def lookup(key: Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """Literal-map lookup; a key that is not in the map gives ``default`` (null if none)."""
    literal_map = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.coalesce(F.try_element_at(literal_map, key), F.lit(default))
