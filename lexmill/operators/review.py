"""User feedback, labels the model never saw, and the decision to retrain.

Rows are first counted per true label; everything after works on that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.display import percent_text


NOT_NEEDED = "the accuracy is above the threshold and every label is known: no retrain is needed"


def label_counts(df: DataFrame, known: DataFrame, true: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    """Per true label: rows, hits and whether the model knows it. ``known`` has one column ``label``."""
    counts = df.groupBy(F.col(true).alias("label")).agg(
        F.count("*").alias("n"), F.count_if(F.col(true) == F.col(predicted)).alias("n_correct")
    )
    marked = known.select("label").distinct().withColumn("is_known", F.lit(True))
    return counts.join(marked, "label", "left").withColumn("is_known", F.coalesce("is_known", F.lit(False)))


def unknown_labels(df: DataFrame, known: DataFrame, true: str = "y_true") -> DataFrame:
    """Labels the model was not trained on with their number of rows, most frequent first."""
    counts = df.groupBy(F.col(true).alias("label")).agg(F.count("*").alias("n"))
    return counts.join(known.select("label"), "label", "left_anti").orderBy(F.desc("n"), "label")


def _totals(counts: DataFrame) -> DataFrame:
    unknown = ~F.col("is_known")
    zero = F.lit(0)
    return counts.agg(
        F.coalesce(F.sum("n"), zero).alias("n_evaluated"),
        F.coalesce(F.sum("n_correct"), zero).alias("n_correct"),
        F.count_if(unknown).alias("n_unknown_labels"),
        F.coalesce(F.sum(F.when(unknown, F.col("n"))), zero).alias("n_unknown_rows"),
    ).withColumn("n_errors", F.col("n_evaluated") - F.col("n_correct"))


def feedback_report(df: DataFrame, known: DataFrame, true: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    """One row about predictions that users have judged.

    The share of errors due to unknown labels is null without errors or unknown labels.
    It can exceed 100 % when a caller's prediction is itself an unknown label.
    """
    share = F.try_divide("n_unknown_rows", "n_errors")
    return _totals(label_counts(df, known, true, predicted)).select(
        percent_text(F.try_divide("n_correct", "n_evaluated")).alias("accuracy"),
        "n_correct",
        "n_evaluated",
        "n_errors",
        "n_unknown_labels",
        "n_unknown_rows",
        F.when(F.col("n_unknown_labels") > 0, percent_text(share)).alias("unknown_share_of_errors"),
    )


def retrain_decision(
    df: DataFrame, baseline: DataFrame, known: DataFrame, true: str = "y_true", predicted: str = "y_pred"
) -> DataFrame:
    """Whether to retrain, and why.

    Retrain if the accuracy is at most the mean validation accuracy less the tolerance, or if
    a label unknown to the model occurs. Details of a rule are null unless that rule fired. Which labels those are, ``unknown_labels`` says, a
    row for each.
    """
    totals = _totals(label_counts(df, known, true, predicted))
    limit = baseline.select(F.struct("mean_val_accuracy", "accuracy_tolerance")).scalar()
    judged = totals.select(
        "*",
        F.try_divide("n_correct", "n_evaluated").alias("share"),
        (limit["mean_val_accuracy"] - limit["accuracy_tolerance"]).alias("threshold"),
        limit["accuracy_tolerance"].alias("tolerance"),
    ).select(
        "*",
        F.coalesce(F.col("share") <= F.col("threshold"), F.lit(False)).alias("below"),
        (F.col("n_unknown_labels") > 0).alias("unknown"),
    )
    four = lambda c: percent_text(F.col(c), 4)

    def only(rule: str, value: Column) -> Column:
        return F.when(F.col(rule), value)

    return judged.select(
        (F.col("below") | F.col("unknown")).alias("retrain"),
        "n_evaluated",
        "n_correct",
        "n_errors",
        four("threshold").alias("threshold"),
        only("below", four("share")).alias("evaluated_accuracy"),
        only(
            "below",
            F.format_string(
                "%d of %d labels were predicted correctly (%d errors)", "n_correct", "n_evaluated", "n_errors"
            ),
        ).alias("hits_text"),
        only(
            "below",
            F.concat(
                F.lit("accuracy is at or below that of the published model less "),
                four("tolerance"),
                F.lit(" (threshold "),
                four("threshold"),
                F.lit(")"),
            ),
        ).alias("accuracy_text"),
        only("unknown", F.col("n_unknown_labels")).alias("n_unknown_labels"),
        only("unknown", F.col("n_unknown_rows")).alias("n_unknown_rows"),
        only(
            "unknown",
            F.format_string("%d labels on %d rows were not in training", "n_unknown_labels", "n_unknown_rows"),
        ).alias("labels_text"),
        F.when(~F.col("below") & ~F.col("unknown"), F.lit(NOT_NEEDED)).alias("not_needed_text"),
    )
