from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from factorframe import operators as ops
from factorframe.functions import bin_rating, kl_divergence


@pytest.mark.parametrize(
    "p, q, expected",
    [
        ([10, 20, 30, 25, 15], [5, 10, 30, 35, 20], 0.080673784074618),
        ([1, 2, 3, 4, 5], [1, 2, 3, 4, 5], 0.0),
        ([1, 0, 0, 0, 0], [0, 0, 0, 0, 1], 23.0258509),
        ([0, 0, 0, 0, 0], [0, 0, 0, 0, 0], 0.0),
    ],
)
def test_kl_divergence(spark, p, q, expected):
    df = spark.createDataFrame([(p, q)], "p array<bigint>, q array<bigint>")
    got = df.select(kl_divergence(F.col("p"), F.col("q"))).first()[0]
    assert got == pytest.approx(expected, abs=1e-7)


def test_bins_round_half_up_and_clip(spark):
    df = spark.createDataFrame([(x,) for x in (2.5, 0.2, -3.0, 4.49, 9.0, None)], "x double")
    assert [r[0] for r in df.select(bin_rating(F.col("x"))).collect()] == [3, 1, 1, 4, 5, None]


def test_data_drift_counts_domain_but_averages_all(make_ratings):
    original = make_ratings([(1, i, r, "2005-01-01") for i, r in enumerate([1, 2, 3, 9])])
    current = make_ratings([(1, i, r, "2005-01-01") for i, r in enumerate([5, 5, None])])
    row = ops.data_drift(original, current).first()
    assert row["original_counts"] == [1, 1, 1, 0, 0] and row["current_counts"] == [0, 0, 0, 0, 2]
    assert row["original_mean"] == 3.75 and row["current_mean"] == 5.0
    assert row["original_total"] == 4 and row["current_total"] == 3
    assert row["current_median"] == 5.0


def test_data_drift_is_reduced_before_the_shuffle(make_ratings):
    df = make_ratings([(1, 1, 1, "2005-01-01")])
    plan = ops.data_drift(df, df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_percentile_approx" in plan and "SortAggregate" not in plan


def test_data_drift_of_nothing(make_ratings):
    nothing = make_ratings([(1, 1, 1, "2005-01-01")]).where("RATING > 1")
    row = ops.data_drift(nothing, nothing).first()
    assert row["original_counts"] == [0] * 5 and row["original_total"] == 0
    assert row["original_mean"] is None and row["current_median"] is None


def test_median_of_even_count_is_the_lower(make_ratings):
    df = make_ratings([(1, i, r, "2005-01-01") for i, r in enumerate([1, 2, 4, 5, None])])
    assert ops.data_drift(df, df).first()["current_median"] == 2.0


def test_prediction_drift_skips_rows_without_prediction(spark):
    df = spark.createDataFrame([(1.4,), (2.6,), (None,), (float("nan"),)], "prediction double")
    row = ops.prediction_drift(df, df).first()
    assert row["original_pred_counts"] == [1, 0, 1, 0, 0] and row["original_total"] == 2
    assert row["original_pred_mean"] == pytest.approx(2.0) and row["kl_divergence"] == 0.0


def report(spark, kl, mean, median, column="data_drift"):
    infix = "" if column == "data_drift" else "pred_"
    one = spark.createDataFrame(
        [(kl, 3.0, 3.0 + mean, 3.0, 3.0 + median)],
        f"kl_divergence double, original_{infix}mean double, current_{infix}mean double, "
        f"original_{infix}median double, current_{infix}median double",
    )
    return one


def test_decision_boundary_is_not_a_retrain(spark):
    row = ops.retrain_decision(ops.drift_report(report(spark, 0.2, 0.0, 0.0))).first()
    assert row["drift_score"] == 1.0 and row["should_retrain"] is False
    assert row["reasons"] == ["Data KL divergence (0.2000) exceeds threshold (0.1)"]
    assert row["model_drift_score"] is None
    row = ops.retrain_decision(ops.drift_report(report(spark, 0.2001, 0.0, 0.0))).first()
    assert row["should_retrain"] is True


def test_decision_takes_the_larger_score(spark):
    both = ops.drift_report(
        report(spark, 0.0, -0.1, 0.0), report(spark, 0.3, 0.4, 1.0, "model_drift")
    )
    row = ops.retrain_decision(both).first()
    assert row["data_drift_score"] == pytest.approx(0.15)
    assert row["drift_score"] == row["model_drift_score"] == pytest.approx(1.5 + 0.6 + 0.4)
    assert row["reasons"] == [
        "Model KL divergence (0.3000) exceeds threshold (0.1)",
        "Model mean shift (0.4000) exceeds threshold (0.2)",
        "Model median shift (1.0000) exceeds threshold (0.5)",
    ]
    assert row["thresholds"] == {"kl_divergence": 0.1, "mean_shift": 0.2, "median_shift": 0.5}
    assert row["weights"] == {"kl": 0.5, "mean": 0.3, "median": 0.2}


def test_decision_refuses_bad_input(spark):
    with pytest.raises(ValueError):
        ops.drift_report()
    with pytest.raises(ValueError):
        ops.retrain_decision(ops.drift_report(report(spark, 0.0, 0.0, 0.0)), kl_weight=0.4)


def test_ranking_worked_example(spark):
    test = spark.createDataFrame(
        [(1, 2, 5), (1, 4, 4), (1, 3, 3), (2, 9, 5), (3, 1, 1)], "CUST_ID int, MOVIE_ID int, RATING int"
    )
    recommended = spark.createDataFrame(
        [(1, 1, 0.9), (1, 2, 0.8), (1, 3, 0.7), (1, 4, 0.1), (3, 1, 1.0)],
        "CUST_ID int, MOVIE_ID int, score double",
    )
    row = ops.ranking_metrics(test, recommended, k=3).first()
    assert row["n_users"] == 1
    assert row["precision"] == pytest.approx(1 / 3) and row["recall"] == pytest.approx(1 / 2)
    assert row["ndcg"] == pytest.approx(0.386853, abs=1e-6)


def test_ranking_counts_repeated_ratings_in_recall_only(spark):
    test = spark.createDataFrame([(1, 2, 5), (1, 2, 4), (1, 5, 4)], "CUST_ID int, MOVIE_ID int, RATING int")
    recommended = spark.createDataFrame([(1, 2, 1.0), (1, 7, 0.5)], "CUST_ID int, MOVIE_ID int, score double")
    row = ops.ranking_per_user(test, recommended, k=10).first()
    assert (row["hits"], row["n_recommended"], row["n_relevant"]) == (1, 2, 3)
    assert row["precision"] == 0.5 and row["recall"] == pytest.approx(1 / 3)
    ideal = sum(1 / math.log2(i + 2) for i in range(3))
    assert row["ndcg"] == pytest.approx(1 / ideal)


def test_ranking_of_nobody_is_zero(spark):
    test = spark.createDataFrame([(1, 2, 1)], "CUST_ID int, MOVIE_ID int, RATING int")
    recommended = spark.createDataFrame([(1, 2, 1.0)], "CUST_ID int, MOVIE_ID int, score double")
    assert tuple(ops.ranking_metrics(test, recommended).first()) == (0.0, 0.0, 0.0, 0)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(3, 2.0), (5, 5.0), (1, None), (None, 1.0)], "RATING int, prediction double")
    row = ops.regression_metrics(df).first()
    assert row["rmse"] == pytest.approx(math.sqrt(0.5)) and row["mae"] == 0.5 and row["n"] == 2


def test_data_drift_of_very_many_values_has_no_window(spark):
    """A million distinct values a side: one row per task is shuffled, no side is sorted in one task."""
    first = spark.range(1_000_000).select((F.col("id") / 7).alias("RATING"))
    second = first.select((F.col("RATING") + 1).alias("RATING"))
    report = ops.data_drift(first, second)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange ") <= 1
    row = report.first()
    assert abs(row["original_median"] - 500_000 / 7) < 200 and row["current_total"] == 1_000_000
