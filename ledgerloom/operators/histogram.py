"""Equal-width histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import spool


def _bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based bin. Left-closed bins, the last one closed on both sides."""
    step = (high - low) / bins
    guess = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    # The division can land one bin off when a value sits on an edge; compare with the edges.
    return (
        F.when(value < low + guess * step, guess - 1)
        .when((guess < bins - 1) & (value >= low + (guess + 1) * step), guess + 1)
        .otherwise(guess)
    )


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts per bin between each group's minimum and maximum, empty bins included.

    Returns the ``by`` columns, ``bin`` (0-based), ``bin_low``, ``bin_high`` and ``n``. Null and NaN
    are left out.
    """
    by = list(by)
    x = F.col(value).cast("double")
    present = df.where(x.isNotNull() & ~F.isnan(x)).select(*by, x.alias("_x"))
    # A single distinct value gets a unit-wide range around it.
    limits = spool(
        present.groupBy(*by)
        .agg(F.min("_x").alias("_min"), F.max("_x").alias("_max"))
        .where(F.col("_min").isNotNull())
        .select(
            *by,
            F.when(F.col("_min") == F.col("_max"), F.col("_min") - 0.5)
            .otherwise(F.col("_min")).alias("_low"),
            F.when(F.col("_min") == F.col("_max"), F.col("_max") + 0.5)
            .otherwise(F.col("_max")).alias("_high"),
        ),
        "limits",
    )
    if by:
        bounded = present.join(limits, by)
    else:
        ends = limits.select(F.struct("_low", "_high").alias("ends")).scalar()
        bounded = present.withColumns(
            {"_low": ends.getField("_low"), "_high": ends.getField("_high")}
        )
    counts = bounded.groupBy(
        *by, _bin_index(F.col("_x"), F.col("_low"), F.col("_high"), bins).alias("bin")
    ).agg(F.count("*").alias("_n"))
    step = (F.col("_high") - F.col("_low")) / bins
    frame = limits.select(
        *by, "_low", "_high", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return frame.join(counts, [*by, "bin"], "left").select(
        *by,
        "bin",
        (F.col("_low") + F.col("bin") * step).alias("bin_low"),
        (F.col("_low") + (F.col("bin") + 1) * step).alias("bin_high"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"),
    )
