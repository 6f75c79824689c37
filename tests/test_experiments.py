"""Experiment statistics: closed-form pins, brute force, and properties."""

from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import experiments as ex

UNIT = "variant string, user_id long, converted int, revenue double, session_pages int"


def frame(spark, control, test):
    """Rows of (converted, revenue, pages) per variant."""
    rows = [("control", i, *r) for i, r in enumerate(control)]
    rows += [("test", len(control) + i, *r) for i, r in enumerate(test)]
    return spark.createDataFrame(rows, UNIT)


def test_conversion_pin(spark):
    units = (
        spark.range(10_000)
        .select(
            F.when(F.col("id") < 5000, "control").otherwise("test").alias("variant"),
            F.col("id").alias("user_id"),
            F.when(F.col("id") < 5000, F.col("id") < 601)
            .otherwise(F.col("id") < 5692).cast("int").alias("converted"),
        )
    )
    stats = ex.conversion_stats(units).first()
    assert stats["z_stat"] == pytest.approx(2.712113, abs=1e-6)
    assert stats["lift_pct"] == pytest.approx(15.1414, abs=1e-4)
    row = ex.conversion_test(units).first()
    assert row["p_value"] == 0.006686 and row["significant"]
    assert (row["control_cvr"], row["test_cvr"], row["z_stat"]) == (0.1202, 0.1384, 2.7121)
    assert row["decision"] == "REJECT H₀ — significant difference"


def test_welch_by_hand(spark):
    """Control 1..5 (mean 3, variance 2.5), test 2,4,6,8 (mean 5, variance 20/3)."""
    units = frame(spark, [(0, float(v), 0) for v in range(1, 6)],
                  [(0, float(v), 0) for v in (2, 4, 6, 8)])
    row = ex.revenue_stats(units).first()
    e1, e2 = 2.5 / 5, (20 / 3) / 4
    assert row["t_stat"] == pytest.approx(-2 / math.sqrt(e1 + e2))
    assert row["degrees"] == pytest.approx((e1 + e2) ** 2 / (e1**2 / 4 + e2**2 / 3))
    assert row["lift_pct"] == pytest.approx(200 / 3)
    shown = ex.revenue_test(units).first()
    assert shown["t_stat"] < 0 < shown["lift_pct"] and not shown["significant"]
    assert shown["decision"] == "FAIL TO REJECT H₀ — no significant revenue difference"


def test_welch_without_spread(spark):
    units = frame(spark, [(0, 1.0, 0)] * 3, [(0, 1.0, 0)] * 3)
    row = ex.revenue_test(units).first()
    assert row["t_stat"] is None and row["p_value"] is None


def brute_u(control, test):
    return sum((c > t) + 0.5 * (c == t) for c in control for t in test)


@pytest.mark.parametrize("seed", [1, 2])
def test_mann_whitney_against_pairs(spark, seed):
    rng = random.Random(seed)
    control = [rng.choice([3, 3, 3, rng.randint(0, 12)]) for _ in range(60)]  # 3 is hot
    test = [rng.choice([3, rng.randint(0, 14)]) for _ in range(45)]
    units = frame(spark, [(0, 0.0, v) for v in control], [(0, 0.0, v) for v in test]).repartition(5)
    row = ex.pages_stats(units).first()
    u = brute_u(control, test)
    assert row["u_stat"] == u
    assert row["control_median"] == sorted(control)[29] / 2 + sorted(control)[30] / 2
    assert row["test_median"] == sorted(test)[22]
    n1, n2 = len(control), len(test)
    n = n1 + n2
    ties = sum(t**3 - t for t in ((control + test).count(v) for v in set(control + test)))
    sigma = math.sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sigma
    assert row["z_stat"] == pytest.approx(z)
    swapped = units.withColumn(
        "variant", F.when(F.col("variant") == "test", "control").otherwise("test")
    )
    assert ex.pages_stats(swapped).first()["u_stat"] + u == n1 * n2
    shown = ex.pages_test(units).first()
    assert shown["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)), abs=1e-6)


@pytest.mark.parametrize("n1, n2, seed", [(3, 4, 1), (4, 6, 2), (8, 5, 3), (2, 9, 4)])
def test_small_tie_free_samples_use_the_exact_distribution(spark, n1, n2, seed):
    """Against every way of assigning the ranks to the control sample."""
    rng = random.Random(seed)
    values = rng.sample(range(100), n1 + n2)
    control, test = values[:n1], values[n1:]
    units = frame(spark, [(0, 0.0, v) for v in control], [(0, 0.0, v) for v in test])
    u = brute_u(control, test)
    ranks = range(1, n1 + n2 + 1)
    all_u = [sum(c) - n1 * (n1 + 1) / 2 for c in itertools.combinations(ranks, n1)]
    extreme = max(u, n1 * n2 - u)
    p = min(1.0, 2 * sum(v >= extreme for v in all_u) / len(all_u))
    row = ex.pages_test(units).first()
    assert row["u_stat"] == u and row["p_value"] == pytest.approx(p, abs=1e-6)


def test_one_empty_sample(spark):
    row = ex.pages_test(frame(spark, [(0, 0.0, 3)], [])).first()
    assert row["p_value"] is None and row["test_median"] is None


def test_mann_whitney_of_equal_samples_is_capped(spark):
    pages = [(0, 0.0, v) for v in range(12)]
    row = ex.pages_test(frame(spark, pages, pages)).first()
    assert row["u_stat"] == 72 and row["p_value"] == 1.0 and row["decision"] == "FAIL TO REJECT H₀"


def test_ranks_over_ranges(spark):
    """Two experiments and a value shared by a third of the rows."""
    rng = random.Random(8)
    rows = [
        ("ab"[i % 2], rng.choice(["control", "test"]), i, 0, 0.0,
         50 if i % 3 == 0 else rng.randint(0, 400))
        for i in range(900)
    ]
    units = spark.createDataFrame(rows, "experiment string, " + UNIT)
    large = ex.pages_stats(units, ["experiment"]).orderBy("experiment").collect()
    assert len(large) == 2
    for row in large:
        c, t = (
            [r[5] for r in rows if (r[0], r[1]) == (row["experiment"], v)]
            for v in ("control", "test")
        )
        assert row["u_stat"] == brute_u(c, t)


def test_many_experiments_in_one_job(spark):
    rng = random.Random(3)
    rows = [
        (f"e{i % 3}", "control" if rng.random() < 0.5 else "test", i, int(rng.random() < 0.3),
         rng.random() * 9, rng.randint(0, 6))
        for i in range(300)
    ]
    units = spark.createDataFrame(rows, "experiment string, " + UNIT)
    together = {
        (r["experiment"], r["test"]): (r["statistic"], r["p_value"])
        for r in ex.run_tests(units, by=["experiment"]).collect()
    }
    assert len(together) == 9
    alone = units.where("experiment = 'e1'")
    for r in ex.run_tests(alone).collect():
        assert together["e1", r["test"]] == (r["statistic"], r["p_value"])


def test_metrics(spark):
    units = frame(spark, [(1, 4.0, 1), (0, 0.0, 1)], [(1, 9.0, 2)])
    rows = {r["variant"]: r for r in ex.metrics(units).collect()}
    assert rows["control"]["conversion_rate"] == 0.5 and rows["control"]["avg_revenue"] == 2.0
    assert rows["test"]["revenue_per_user"] == 9.0 and rows["test"]["users"] == 1
    record = ex.kpi_records(ex.metrics(units)).where("record like '%control%'").first()
    assert '"users":2' in record["record"] and record["last_updated"] is not None


def test_population_and_duplicates(spark):
    control = frame(spark, [(1, 4.0, 1)], [])
    test = frame(spark, [], [(1, 9.0, 2), (0, 0.0, 0)])
    both = ex.population(control, test.select(*reversed(test.columns)))
    assert both.groupBy("variant").count().count() == 2
    assert [tuple(r) for r in ex.duplicate_units(both, ["user_id"]).collect()] == [(0, 2)]


def test_required_sample_size(spark):
    got = spark.range(1).select(ex.required_sample_size(F.lit(0.12)).alias("n")).first()["n"]
    assert got == 4438


def test_power_check(spark):
    units = frame(spark, [(i % 2, 0.0, 0) for i in range(10)], [(1, 0.0, 0)] * 8)
    row = ex.power_check(units, effect=0.4).first()
    assert row["control_cvr"] == 0.5 and row["n_test"] == 8 and row["enough"] in (0, 1)
    assert ex.power_check(units).first()["enough"] == 0


def test_power_check_without_an_answer(spark):
    """No sample shows a rate over one, and an absent variant is not enough."""
    certain = frame(spark, [(1, 0.0, 0)] * 4, [(1, 0.0, 0)])
    row = ex.power_check(certain).first()
    assert row["control_cvr"] == 1.0 and row["required_n"] is None and row["enough"] is None
    alone = ex.power_check(frame(spark, [(i % 2, 0.0, 0) for i in range(10)], [])).first()
    assert alone["n_test"] == 0 and alone["required_n"] is not None and alone["enough"] is None


def test_no_decision_without_both_variants(spark):
    rows = ex.run_tests(frame(spark, [(1, 2.0, i) for i in range(5)], [])).collect()
    assert rows and all(r["decision"] is None for r in rows)


def test_rank_test_method(spark):
    units = frame(spark, [(0, 0.0, 2 * v) for v in range(12)], [(0, 0.0, 2 * v + 9) for v in range(12)])
    exact, normal = (ex.pages_test(units, method=m).first()["p_value"] for m in ("exact", "normal"))
    assert exact != normal and exact == pytest.approx(normal, abs=0.02)
    with pytest.raises(ValueError, match="method"):
        ex.pages_test(units, method="other")


def test_revenue_histogram_clips_per_variant(spark):
    control = [(0, float(v), 0) for v in range(200)]
    units = frame(spark, control, [(0, v * 10, 0) for _, v, _ in control])
    rows = ex.revenue_histogram(units, bins=10).collect()
    tops = {}
    for r in rows:
        tops[r["variant"]] = max(tops.get(r["variant"], 0), r["bin_high"])
    assert tops["control"] == pytest.approx(197.01) and tops["test"] == pytest.approx(1970.1)
    assert sum(r["n"] for r in rows) == 400


def test_metrics_that_are_not_there(spark, tmp_path):
    path = str(tmp_path / "metrics")
    missing = ex.read_kpis(spark, path).first()
    assert missing.record is None and missing.error == ex.NO_KPIS and missing.last_updated is not None
    spark.createDataFrame([("control", 3)], "variant string, users long").write.parquet(path)
    found = ex.read_kpis(spark, path).collect()
    assert [(r.record, r.error) for r in found] == [('{"variant":"control","users":3}', None)]
