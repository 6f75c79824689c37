"""Running totals, quantiles, ranks and histograms against brute force."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators import ordered
from ledgerloom.operators.histogram import histogram
from ledgerloom.plans import rfm


def hot_frame(spark, n=600):
    """Two groups; one value holds a third of all rows."""
    rng = random.Random(5)
    rows = [
        ("a" if i % 4 else "b", 7.0 if i % 3 == 0 else round(rng.uniform(0, 50), 1))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "g string, v double"), pd.DataFrame(rows, columns=["g", "v"])


def test_running_totals(spark):
    rng = random.Random(1)
    rows = [(g, i, rng.randint(0, 9)) for g in "abc" for i in rng.sample(range(1000), 200)]
    df = spark.createDataFrame(rows, "g string, k int, w int").repartition(5)
    got = ordered.running_totals(df, ["k"], {"w": "upto"}, ["g"], {"w": "all"}).toPandas()
    want = pd.DataFrame(rows, columns=["g", "k", "w"]).sort_values(["g", "k"])
    want["upto"] = want.groupby("g")["w"].cumsum()
    want["all"] = want.groupby("g")["w"].transform("sum")
    got = got.sort_values(["g", "k"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want.reset_index(drop=True), check_dtype=False)


def test_row_numbers_are_global(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k")).repartition(7)
    rows = ordered.row_numbers(df, ["k"]).orderBy("row_number").collect()
    assert [r["row_number"] for r in rows] == list(range(1, 1001))
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)


def test_quantiles_with_a_hot_value(spark):
    df, pdf = hot_frame(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    for row in ordered.quantiles(df, "v", probs, by=["g"]).collect():
        values = pdf[pdf.g == row["g"]].v
        assert row["n"] == len(values)
        assert row["quantiles"] == pytest.approx(list(values.quantile(probs)))
    assert ordered.quantile_values(df, "v", probs) == pytest.approx(list(pdf.v.quantile(probs)))


def test_brackets_hold_the_wanted_positions(spark):
    """Large enough for brackets narrower than the group; a third of the rows share a value."""
    rng = random.Random(2)
    rows = [(7.0 if i % 3 == 0 else rng.gauss(0, 30),) for i in range(40_000)]
    df = spark.createDataFrame(rows, "v double").repartition(6)
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.95, 0.9999, 1.0]
    want = pd.Series([v for v, in rows]).quantile(probs)
    assert ordered.quantile_values(df, "v", probs) == pytest.approx(list(want))


def test_quantiles_skip_nulls_and_empty_input(spark):
    df = spark.createDataFrame([(None,), (1.0,), (3.0,)], "v double")
    assert ordered.quantile_values(df, "v", [0.5]) == [2.0]
    assert ordered.quantile_values(df.where("v > 9"), "v", [0.5]) == []


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=40))
def test_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    want = np.quantile(np.array(values, float), [0.25, 0.5, 0.75])
    assert ordered.quantile_values(df, "v", [0.25, 0.5, 0.75]) == pytest.approx(list(want))


@pytest.mark.parametrize("n", [4, 7, 10, 11, 13, 40])
def test_first_rank_score_matches_quartiles_of_ranks(spark, n):
    """Checked against quartiles of ranks 1..n; plain ntile(4) differs for n = 10 and 11."""
    rng = random.Random(n)
    pdf = pd.DataFrame({"f": [rng.randint(1, 3) for _ in range(n)], "id": range(n)})
    df = spark.createDataFrame(pdf).repartition(3)
    order = ["f", "id"]
    score = ordered.first_rank_score(order, ordered.first_rank_cuts(df, order))
    got = {r["id"]: r["s"] for r in df.select("id", score.alias("s")).collect()}
    ranks = pdf.sort_values(order)["f"].rank(method="first")
    want = pd.qcut(ranks, 4, labels=[1, 2, 3, 4]).astype(int)
    assert got == dict(zip(pdf.loc[want.index, "id"], want))


def test_rank_cuts_with_text_keys(spark):
    rows = [(1, f"c{i:02d}") for i in range(11)]
    df = spark.createDataFrame(rows, "f int, id string")
    cuts = ordered.first_rank_cuts(df, ["f", "id"])
    assert cuts == [(1, "c02"), (1, "c05"), (1, "c07")]


def base_frame(spark, frequencies):
    rows = [(f"c{i:03d}", i * 3, f, float(i * i + 1)) for i, f in enumerate(frequencies)]
    schema = "customer_id string, recency int, frequency bigint, monetary double"
    return spark.createDataFrame(rows, schema), pd.DataFrame(rows, columns=[
        "customer_id", "recency", "frequency", "monetary"])


def test_scores_match_quantile_cuts(spark):
    df, pdf = base_frame(spark, [1 + i % 9 for i in range(60)])
    got = rfm.score_by_quartiles(df, ties="value").toPandas().set_index("customer_id")
    pdf = pdf.set_index("customer_id")
    for column, labels in (
        ("recency", [4, 3, 2, 1]), ("frequency", [1, 2, 3, 4]), ("monetary", [1, 2, 3, 4]),
    ):
        want = pd.qcut(pdf[column], 4, labels=labels).astype(int)
        assert got[f"{column}_score"].to_dict() == want.to_dict()
    total = got[["recency_score", "frequency_score", "monetary_score"]].sum(axis=1)
    assert (got["rfm_score"] == total).all() and got["rfm_score"].between(3, 12).all()


def test_coinciding_edges(spark):
    """Nearly all customers ordered once: quartiles of the count do not exist."""
    df, pdf = base_frame(spark, [1] * 36 + [2] * 4)
    with pytest.raises(ValueError, match="frequency"):
        rfm.score_by_quartiles(df, ties="value").count()
    with pytest.raises(ValueError, match="policy"):
        rfm.score_by_quartiles(df, ties="other")
    got = rfm.score_by_quartiles(df, ties="rank").toPandas().set_index("customer_id")["frequency_score"]
    ranks = pdf.set_index("customer_id")["frequency"].rank(method="first")
    assert got.to_dict() == pd.qcut(ranks, 4, labels=[1, 2, 3, 4]).astype(int).to_dict()


def test_histogram_matches_numpy(spark):
    df, pdf = hot_frame(spark)
    for bins in (5, 40):
        rows = histogram(df, "v", bins).orderBy("bin").collect()
        counts, edges = np.histogram(pdf.v, bins=bins)
        assert [r["n"] for r in rows] == list(counts)
        assert [r["bin_low"] for r in rows] == pytest.approx(list(edges[:-1]))
        assert [r["bin_high"] for r in rows] == pytest.approx(list(edges[1:]))


def test_histogram_by_group_and_single_value(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", 5.0), ("a", None)], "g string, v double"
    )
    rows = {(r["g"], r["bin"]): r for r in histogram(df, "v", 2, by=["g"]).collect()}
    assert {k: r["n"] for k, r in rows.items()} == {
        ("a", 0): 1, ("a", 1): 1, ("b", 0): 0, ("b", 1): 2,
    }
    assert rows["b", 0]["bin_low"] == 4.5 and rows["b", 1]["bin_high"] == 5.5


@pytest.mark.parametrize("collected", [10_000, 20])
def test_selection_in_rounds(spark, monkeypatch, collected):
    """Brackets are narrowed until they are short; half of the rows share a value, NaN is left out."""
    monkeypatch.setattr(ordered, "COLLECTED", collected)
    rng = random.Random(3)
    rows = [("a" if i % 5 else "b", 0.0 if i % 2 else rng.gauss(0, 30)) for i in range(30_000)]
    rows += [("a", float("inf")), ("a", float("-inf")), ("c", float("nan")), ("c", 1.0), ("c", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    probs = [0.0, 0.0001, 0.2, 0.25, 0.5, 0.7501, 0.95, 1.0]
    got = {r["g"]: list(r["quantiles"]) for r in ordered.quantiles(df, "v", probs, by=["g"]).collect()}
    for g in "ab":
        values = sorted(v for group, v in rows if group == g)
        for p, found in zip(probs, got[g]):
            at = p * (len(values) - 1)
            low, high = values[int(at)], values[-int(-at // 1)]
            assert found == (low if low == high else pytest.approx(low + (high - low) * (at % 1)))
    assert got["c"][0] == 1.0 and got["c"][-1] == 2.0


@pytest.mark.parametrize("collected", [10_000, 400])
def test_rank_cuts_in_rounds(spark, monkeypatch, collected):
    monkeypatch.setattr(ordered, "COLLECTED", collected)
    monkeypatch.setattr(ordered, "SAMPLE", 200)
    rng = random.Random(4)
    rows = [(1 + (i % 7 == 0), f"é{rng.randrange(10**6):06d}x{i}") for i in range(8_000)]
    df = spark.createDataFrame(rows, "f int, id string").repartition(5)
    ranked = sorted(rows)
    for buckets in (4, 9):
        ends = [int(1 + (len(rows) - 1) * k / buckets) for k in range(1, buckets)]
        assert ordered.first_rank_cuts(df, ["f", "id"], buckets) == [ranked[e - 1] for e in ends]


def test_rank_cuts_of_nothing(spark):
    assert ordered.first_rank_cuts(spark.createDataFrame([], "f int, id string"), ["f", "id"]) == []


def test_no_sort_and_no_window_over_a_bracket(spark):
    plan = ordered.quantiles(hot_frame(spark)[0], "v", [0.25, 0.5], by=["g"])._jdf.queryExecution().toString()
    assert "Window" not in plan and "Sort [" not in plan
