"""Independence of two categories: the chi-square test on a table of counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import even_round
from ledgerloom.functions.pvalues import chi_square_tail
from ledgerloom.plans.experiments import ALPHA, PLAIN_DECISION


def chi_square_stats(
    units: DataFrame, row: str, column: str, by: Sequence[str] = ()
) -> DataFrame:
    """Statistic and degrees of freedom of ``row`` against ``column``, one row per experiment.

    The cells that occur are counted once; with row total r, column total c and n units, the
    statistic is n times the sum of o² / (r·c), less n, to which empty cells add nothing, so the
    table is never filled up. Units without one of the categories are left out.
    """
    by = list(by)
    keys = by or ["_all"]
    known = units.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    if not by:
        known = known.withColumn("_all", F.lit(0))
    cells = known.groupBy(*keys, F.col(row).alias("_row"), F.col(column).alias("_column")).agg(F.count("*").alias("o"))
    rows = cells.groupBy(*keys, "_row").agg(F.sum("o").alias("r"))
    columns = cells.groupBy(*keys, "_column").agg(F.sum("o").alias("c"))
    found = (
        cells.join(rows, [*keys, "_row"]).join(columns, [*keys, "_column"])
        .groupBy(*keys).agg(
            F.sum(F.col("o").cast("double") * F.col("o") / F.col("r") / F.col("c")).alias("share"),
            F.sum("o").alias("n"),
            # The shares of a row's cells add up to one, so all of them to the number of rows.
            F.round(F.sum(F.col("o") / F.col("r"))).cast("long").alias("n_rows"),
            F.round(F.sum(F.col("o") / F.col("c"))).cast("long").alias("n_columns"),
        )
    )
    return found.select(
        *by, "n", "n_rows", "n_columns",
        F.greatest(F.lit(0.0), F.col("n") * (F.col("share") - 1)).alias("statistic"),
        ((F.col("n_rows") - 1) * (F.col("n_columns") - 1)).alias("degrees"),
    )


def chi_square_test(
    units: DataFrame, row: str, column: str, by: Sequence[str] = ()
) -> DataFrame:
    """The test's decision; no answer where one of the categories has a single value."""
    p = chi_square_tail(F.col("statistic"), F.col("degrees"))
    tested = chi_square_stats(units, row, column, by).withColumn("p_value", p)
    significant = F.col("p_value") < ALPHA
    reject, keep = PLAIN_DECISION
    return tested.select(
        *by, "n", "degrees",
        even_round(F.col("statistic"), 4).alias("statistic"),
        even_round(F.col("p_value"), 6).alias("p_value"),
        significant.alias("significant"),
        F.when(significant, reject).when(~significant, keep).alias("decision"),
    )
