"""Experiment metrics and significance tests.

Input: one row per unit with ``variant`` (control or test), ``converted``, ``revenue`` and
``session_pages``. Every test is one grouped aggregation over the units, so that many
experiments (``by`` columns) are evaluated in the same job, followed by arithmetic on one row
per experiment.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import clip_above, even_round, percent, ratio
from ledgerloom.functions.pvalues import (
    normal_two_sided,
    rank_sum_two_sided,
    student_two_sided,
)
from ledgerloom.operators import ordered
from ledgerloom.operators.histogram import histogram
from ledgerloom.session import hadoop_path, spool

ALPHA = 0.05

# The decision texts, significant and not, and the titles of the tests.
PLAIN_DECISION = ("REJECT H₀", "FAIL TO REJECT H₀")
CONVERSION_DECISION = (
    "REJECT H₀ — significant difference",
    "FAIL TO REJECT H₀ — no significant difference",
)
REVENUE_DECISION = (
    "REJECT H₀ — significant revenue difference",
    "FAIL TO REJECT H₀ — no significant revenue difference",
)
CONVERSION_TITLE = "Z-test (conversion rate)"
REVENUE_TITLE = "Welch t-test (revenue per user)"
PAGES_TITLE = "Mann-Whitney U (session pages)"


def population(control: DataFrame, test: DataFrame) -> DataFrame:
    """Both variants in one table, by column name."""
    return control.unionByName(test)


def duplicate_units(units: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur in more than one row; metrics count rows and expect none."""
    return units.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def metrics(units: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Users, conversions and revenue per variant. ``users`` counts rows."""
    return (
        units.where(F.col("variant").isNotNull())
        .groupBy(*by, "variant")
        .agg(
            F.count("user_id").alias("users"),
            F.sum("converted").alias("conversions"),
            F.sum("revenue").alias("total_revenue"),
            F.avg("revenue").alias("avg_revenue"),
        )
        .withColumn("conversion_rate", ratio(F.col("conversions"), F.col("users")))
        .withColumn("revenue_per_user", ratio(F.col("total_revenue"), F.col("users")))
    )


def _in(variant: str, value: Column) -> Column:
    return F.when(F.col("variant") == variant, value)


def _decision(texts: tuple[str, str], both: Column) -> list[Column]:
    """p-value, whether it is significant, and the decision: null unless ``both`` variants have
    rows."""
    significant = F.col("p_value") < ALPHA
    reject, keep = texts
    return [
        even_round(F.col("p_value"), 6).alias("p_value"),
        significant.alias("significant"),
        F.when(both, F.when(significant, reject).otherwise(keep)).alias("decision"),
    ]


def _both() -> Column:
    return (F.col("n_control") > 0) & (F.col("n_test") > 0)


def _conversion_sums() -> list[Column]:
    return [
        column
        for v in ("control", "test")
        for column in (
            F.count(_in(v, F.lit(1))).alias(f"n_{v}"),
            F.sum(_in(v, F.col("converted"))).alias(f"x_{v}"),
        )
    ]


def _revenue_sums() -> list[Column]:
    return [
        column
        for v in ("control", "test")
        for column in (
            F.count(_in(v, F.col("revenue"))).alias(f"paid_{v}"),
            F.avg(_in(v, F.col("revenue"))).alias(f"{v}_avg"),
            F.var_samp(_in(v, F.col("revenue"))).alias(f"var_{v}"),
        )
    ]


# ---- conversion: pooled two-proportion z ------------------------------------------------

def _conversion_stats(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    n1, n2 = F.col("n_control"), F.col("n_test")
    pooled = (F.col("x_control") + F.col("x_test")) / (n1 + n2)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n2))
    return (
        sums.select(*by, "n_control", "n_test", "x_control", "x_test")
        .withColumn("control_cvr", ratio(F.col("x_control"), n1))
        .withColumn("test_cvr", ratio(F.col("x_test"), n2))
        .withColumn(
            "lift_pct", percent(F.col("test_cvr") - F.col("control_cvr"), F.col("control_cvr"))
        )
        .withColumn("z_stat", F.try_divide(F.col("test_cvr") - F.col("control_cvr"), spread))
    )


def conversion_stats(units: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _conversion_stats(units.groupBy(*by).agg(*_conversion_sums()), by)


def _conversion_test(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    return (
        _conversion_stats(sums, by)
        .withColumn("p_value", normal_two_sided(F.col("z_stat")))
        .select(
            *by,
            even_round(F.col("control_cvr"), 4).alias("control_cvr"),
            even_round(F.col("test_cvr"), 4).alias("test_cvr"),
            even_round(F.col("lift_pct"), 2).alias("lift_pct"),
            even_round(F.col("z_stat"), 4).alias("z_stat"),
            *_decision(CONVERSION_DECISION, _both()),
        )
    )


def conversion_test(units: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Two-sided z-test for the difference of conversion rates; lift is test over control."""
    return _conversion_test(units.groupBy(*by).agg(*_conversion_sums()), by)


# ---- revenue: Welch's t -----------------------------------------------------------------

def _revenue_stats(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    n1, n2 = F.col("paid_control"), F.col("paid_test")
    e1 = F.try_divide(F.col("var_control"), n1)
    e2 = F.try_divide(F.col("var_test"), n2)
    freedom = F.try_divide(
        (e1 + e2) * (e1 + e2),
        F.try_divide(e1 * e1, n1 - 1) + F.try_divide(e2 * e2, n2 - 1),
    )
    difference = F.col("control_avg") - F.col("test_avg")
    return (
        sums.select(
            *by, "paid_control", "control_avg", "var_control", "paid_test", "test_avg", "var_test"
        )
        .withColumn("t_stat", F.try_divide(difference, F.sqrt(e1 + e2)))
        .withColumn("degrees", freedom)
        .withColumn("lift_pct", percent(-difference, F.col("control_avg")))
        .withColumnsRenamed({"paid_control": "n_control", "paid_test": "n_test"})
    )


def revenue_stats(units: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``t_stat`` is control minus test while ``lift_pct`` is test over control, so the two
    have opposite signs."""
    return _revenue_stats(units.groupBy(*by).agg(*_revenue_sums()), by)


def _revenue_test(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    return (
        _revenue_stats(sums, by)
        .withColumn("p_value", student_two_sided(F.col("t_stat"), F.col("degrees")))
        .select(
            *by,
            even_round(F.col("control_avg"), 2).alias("control_avg"),
            even_round(F.col("test_avg"), 2).alias("test_avg"),
            even_round(F.col("lift_pct"), 2).alias("lift_pct"),
            even_round(F.col("t_stat"), 4).alias("t_stat"),
            *_decision(REVENUE_DECISION, _both()),
        )
    )


def revenue_test(units: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Two-sided Welch t-test for the difference of mean revenue."""
    return _revenue_test(units.groupBy(*by).agg(*_revenue_sums()), by)


# ---- pages: Mann-Whitney U --------------------------------------------------------------

def pages_stats(units: DataFrame, by: Sequence[str] = (), value: str = "session_pages") -> DataFrame:
    """U of the control sample, medians and the tie-corrected normal statistic.

    Equal values are counted first; ranks come from running totals over the distinct values,
    so neither a frequent value nor a large experiment gathers in one task. With ``c`` and ``t``
    control and test rows at a value and ``T`` test rows below it, U is the sum of c·(T + t/2).
    """
    by = list(by)
    counted = (
        units.where(F.col(value).isNotNull() & F.col("variant").isin("control", "test"))
        .groupBy(*by, value)
        .agg(
            F.count(_in("control", F.lit(1))).alias("c"), F.count(_in("test", F.lit(1))).alias("t")
        )
    )
    totals = ordered.running_totals(
        counted, [value], {"c": "c_upto", "t": "t_upto"}, by, {"c": "n_c", "t": "n_t"}
    )
    c, t = F.col("c").cast("double"), F.col("t").cast("double")
    tied = c + t

    def median(upto: str, here: str, size: str) -> Column:
        def at(index: Column) -> Column:
            hit = (index < F.col(upto)) & (index >= F.col(upto) - F.col(here))
            return F.max(F.when(hit, F.col(value).cast("double")))

        middle = (F.col(size) - 1) / 2
        return (at(F.floor(middle)) + at(F.ceil(middle))) / 2

    sums = totals.groupBy(*by).agg(
        F.max("n_c").alias("n_control"),
        F.max("n_t").alias("n_test"),
        F.sum(c * (F.col("t_upto") - F.col("t") + t / 2)).alias("u_stat"),
        F.sum(tied * tied * tied - tied).alias("tie_sum"),
        median("c_upto", "c", "n_c").alias("control_median"),
        median("t_upto", "t", "n_t").alias("test_median"),
    )
    n1, n2 = F.col("n_control").cast("double"), F.col("n_test").cast("double")
    n = n1 + n2
    spread = F.sqrt(n1 * n2 / 12 * (n + 1 - F.try_divide(F.col("tie_sum"), n * (n - 1))))
    larger = F.greatest(F.col("u_stat"), n1 * n2 - F.col("u_stat"))
    return sums.where("n_control is not null").withColumn(
        "z_stat", F.try_divide(larger - n1 * n2 / 2 - 0.5, spread)
    )


def pages_test(units: DataFrame, by: Sequence[str] = (), method: str = "auto") -> DataFrame:
    """Two-sided Mann-Whitney test. ``method``: ``exact``, ``normal`` (with continuity correction,
    capped at one), or ``auto``: exact when one sample is tiny and no value is tied."""
    inputs = map(F.col, ("u_stat", "n_control", "n_test", "tie_sum", "z_stat"))
    p = rank_sum_two_sided(*inputs, method=method)
    return (
        pages_stats(units, by)
        .withColumn("p_value", p)
        .select(
            *by,
            "control_median",
            "test_median",
            even_round(F.col("u_stat"), 2).alias("u_stat"),
            *_decision(PLAIN_DECISION, _both()),
        )
    )


# ---- everything together ----------------------------------------------------------------

def run_tests(units: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per experiment and test: effect, statistic, p-value and decision. Reads the units
    twice: once for the moments of two tests, once for the value counts of the third."""
    by = list(by)
    sums = spool(units.groupBy(*by).agg(*_conversion_sums(), *_revenue_sums()), "moments")
    results = [
        (_conversion_test(sums, by), CONVERSION_TITLE, "control_cvr", "test_cvr", "z_stat"),
        (_revenue_test(sums, by), REVENUE_TITLE, "control_avg", "test_avg", "t_stat"),
        (pages_test(units, by), PAGES_TITLE, "control_median", "test_median", "u_stat"),
    ]
    tables = []
    for result, title, control, test, statistic in results:
        lift = F.col("lift_pct") if "lift_pct" in result.columns else F.lit(None).cast("double")
        tables.append(
            result.select(
                *by,
                F.lit(title).alias("test"),
                F.col(control).alias("control_value"),
                F.col(test).alias("test_value"),
                lift.alias("lift_pct"),
                F.col(statistic).alias("statistic"),
                "p_value",
                "significant",
                "decision",
            )
        )
    return reduce(DataFrame.unionByName, tables)


def required_sample_size(
    baseline: Column, effect: float = 0.02, alpha: float = ALPHA, power: float = 0.8
) -> Column:
    """Units per variant needed to detect an absolute change of ``effect`` in a rate; null if the
    rate or the changed rate is not strictly between 0 and 1."""
    z_alpha = NormalDist().inv_cdf(1 - alpha / 2)
    z_beta = NormalDist().inv_cdf(power)
    changed = baseline + effect
    mean = (baseline + changed) / 2
    root = z_alpha * F.sqrt(2 * mean * (1 - mean)) + z_beta * F.sqrt(
        baseline * (1 - baseline) + changed * (1 - changed)
    )
    possible = (baseline > 0) & (changed > 0) & (baseline < 1) & (changed < 1)
    return F.when(possible, F.ceil(root * root / (effect * effect)))


def power_check(
    units: DataFrame,
    by: Sequence[str] = (),
    effect: float = 0.02,
    alpha: float = ALPHA,
    power: float = 0.8,
) -> DataFrame:
    """Observed against required units per variant, from each experiment's control rate. No answer
    if a variant is absent or no number is required."""
    required = required_sample_size(F.col("control_cvr"), effect, alpha, power)
    return (
        conversion_stats(units, by)
        .select(*by, "n_control", "n_test", "control_cvr", required.alias("required_n"))
        .withColumn(
            "enough",
            F.when(_both(), (F.least("n_control", "n_test") >= F.col("required_n")).cast("int")),
        )
    )


def revenue_histogram(units: DataFrame, bins: int = 50, share: float = 0.99) -> DataFrame:
    """Revenue distribution per variant, clipped at each variant's own exact percentile.

    The limits, one per variant, enter as a map, so that the units are not joined on two keys.
    """
    limits = spool(
        ordered.quantiles(units, "revenue", [share], by=["variant"]).select(
            "variant", F.col("quantiles")[0].alias("limit")
        ),
        "limits",
    )
    by_variant = limits.agg(
        F.map_from_entries(F.collect_list(F.struct("variant", "limit"))).alias("limits")
    ).scalar()
    clipped = units.where(F.col("variant").isNotNull()).select(
        "variant", clip_above(F.col("revenue"), F.try_element_at(by_variant, F.col("variant"))).alias("revenue")
    )
    return histogram(clipped, "revenue", bins, by=["variant"])


def report(units: DataFrame) -> DataFrame:
    """The whole result of an experiment in long form: each metric and each test of both variants,
    and the required against the observed sample size. Reads the units once for the metrics, twice
    for the tests and once for the sample size."""
    found = metrics(units)
    names = [c for c in found.columns if c != "variant"]
    long = found.select("variant", *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        ["variant"], names, "name", "value"
    )
    none = F.lit(None).cast("double")
    measured = long.groupBy("name").agg(
        F.max(_in("control", F.col("value"))).alias("control_value"), F.max(_in("test", F.col("value"))).alias("test_value")
    ).select(
        F.concat(F.lit("Metric: "), F.col("name")).alias("section"), "control_value", "test_value",
        even_round(100 * F.try_divide(F.col("test_value") - F.col("control_value"), F.col("control_value")), 2).alias("lift_pct"),
        none.alias("p_value"), F.lit(None).cast("string").alias("decision"),
    )
    tested = run_tests(units).select(
        F.col("test").alias("section"), "control_value", "test_value", "lift_pct", "p_value", "decision"
    )
    sizes = power_check(units).select(
        F.concat(F.lit("Sample size, required: "), F.coalesce(F.col("required_n").cast("string"), F.lit("unknown"))).alias("section"),
        F.col("n_control").cast("double").alias("control_value"), F.col("n_test").cast("double").alias("test_value"),
        none.alias("lift_pct"), none.alias("p_value"),
        F.when(F.col("enough") == 1, "ENOUGH").when(F.col("enough") == 0, "TOO FEW").alias("decision"),
    )
    return measured.unionByName(tested).unionByName(sizes)


def kpi_records(table: DataFrame) -> DataFrame:
    """The metrics table as JSON records with the time of the read."""
    return table.select(
        F.to_json(F.struct(*table.columns)).alias("record"),
        F.current_timestamp().alias("last_updated"),
    )


# Fixed value: what a reader of the metrics gets while there are none.
NO_KPIS = "KPI data not found"


def read_kpis(spark: SparkSession, path: str) -> DataFrame:
    """``record``, ``last_updated`` and ``error``: the stored metrics, or, while no table lies at
    ``path``, one row that says so."""
    files, place = hadoop_path(spark, path)
    if files.exists(place):
        return kpi_records(spark.read.parquet(path)).withColumn("error", F.lit(None).cast("string"))
    return spark.range(1).select(
        F.lit(None).cast("string").alias("record"), F.current_timestamp().alias("last_updated"), F.lit(NO_KPIS).alias("error")
    )
