from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexmill.operators import metrics, review
from lexmill.sources import artifacts

# Six judged predictions: two right, two of a known class wrong, two of classes the model lacks.
PRED = "wheat rye oats wheat barley rye".split()
TRUE = "wheat rye wheat oats millet spelt".split()
KNOWN = "wheat rye oats barley".split()


def frame(spark, pred, true):
    return spark.createDataFrame(list(zip(pred, true)), "y_pred string, y_true string")


def known(spark, labels):
    return spark.createDataFrame([(x,) for x in labels], "label string")


def test_feedback_golden(spark):
    df = frame(spark, PRED, TRUE)
    assert tuple(review.feedback_report(df, known(spark, KNOWN)).first()) == ("33.33%", 2, 6, 4, 2, 2, "50.00%")
    more = df.unionByName(frame(spark, ["rye"], ["spelt"]))
    assert [tuple(r) for r in review.unknown_labels(more, known(spark, KNOWN)).collect()] == [("spelt", 2), ("millet", 1)]


def test_no_errors_gives_no_share(spark):
    report = review.feedback_report(frame(spark, ["new"], ["new"]), known(spark, KNOWN)).first()
    assert report["n_unknown_rows"] == 1 and report["unknown_share_of_errors"] is None


def test_unknown_labels_tie_by_name(spark):
    df = frame(spark, ["a"] * 4, ["z", "y", "z", "y"])
    assert [r["label"] for r in review.unknown_labels(df, known(spark, ["a"])).collect()] == ["y", "z"]


def baseline(spark, mean, tolerance):
    history = spark.createDataFrame([(1, mean, mean)], "epoch bigint, accuracy double, val_accuracy double")
    return metrics.baseline_metrics(history, F.lit(0.9), tolerance)


@pytest.mark.parametrize(
    "mean,labels,retrain,below,unknown",
    [
        (0.77, ["a", "b"], True, True, False),  # accuracy equals the threshold: at most counts
        (0.76, ["a", "b"], False, False, False),
        (0.10, ["a"], True, False, True),
        (0.90, ["a"], True, True, True),
    ],
)
def test_decision_rules(spark, mean, labels, retrain, below, unknown):
    df = frame(spark, ["a", "a", "b", "b"], ["a", "a", "b", "a"])
    row = review.retrain_decision(df, baseline(spark, mean, 0.02), known(spark, labels)).first()
    assert row["retrain"] is retrain
    assert (row["evaluated_accuracy"] is not None) is below
    assert (row["n_unknown_labels"] is not None) is unknown
    assert (review.unknown_labels(df, known(spark, labels)).count() > 0) is unknown
    assert (row["not_needed_text"] is None) is retrain


def test_decision_lists_unknown_labels_by_count_then_name(spark):
    df = frame(spark, ["a"] * 6, ["z", "y", "z", "y", "x", "a"])
    decision = review.retrain_decision(df, baseline(spark, 0.5, 0.02), known(spark, ["a"]))
    unknown = review.unknown_labels(df, known(spark, ["a"]))
    assert artifacts.with_labels(decision, unknown, "unknown_labels", ";").first()["unknown_labels"] == "y=2;z=2;x=1"
    assert artifacts.with_labels(decision, unknown.where("n > 9"), "unknown_labels", ";").first()["unknown_labels"] is None
    assert artifacts.with_labels(decision, known(spark, ["b", "a"]), "known").first()["known"] == "a,b"


def test_hot_label_is_counted_before_the_exchange(spark):
    df = spark.range(3000).select(F.lit("a").alias("y_pred"), F.when(F.col("id") % 3 == 0, "hot").otherwise("a").alias("y_true"))
    plan = review.label_counts(df, known(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert review.feedback_report(df, known(spark, ["a"])).first()["n_unknown_rows"] == 1000


def test_baseline_means_over_epochs(spark):
    rows = [(e, 0.5 + e / 40, 0.45 + e / 40) for e in range(1, 11)]
    history = spark.createDataFrame(rows, "epoch bigint, accuracy double, val_accuracy double")
    row = metrics.baseline_metrics(history, F.lit(0.8), 0.02).first()
    assert (row["mean_train_accuracy"], row["mean_val_accuracy"]) == pytest.approx((0.6375, 0.5875))


def test_batches(spark):
    df = spark.range(1, 251).select(F.col("id").alias("rn"), F.lit("a").alias("y_true"), F.when(F.col("id") <= 100, "a").otherwise("b").alias("y_pred"))
    got = sorted(tuple(r) for r in metrics.batch_accuracy(df, "rn", 100).collect())
    assert got == [(0, 100, 100, 1.0), (1, 100, 0, 0.0), (2, 50, 0, 0.0)]
