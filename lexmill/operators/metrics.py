"""Accuracy, loss, and the records kept about a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.display import percent_text
from lexmill.operators.network import cross_entropy


def _hits(true: str, predicted: str) -> Column:
    return F.count_if(F.col(true) == F.col(predicted))


def accuracy(df: DataFrame, true: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    counts = df.agg(F.count("*").alias("n_evaluated"), _hits(true, predicted).alias("n_correct"))
    return counts.select(
        "n_evaluated",
        "n_correct",
        (F.col("n_evaluated") - F.col("n_correct")).alias("n_errors"),
        F.try_divide("n_correct", "n_evaluated").alias("accuracy"),
    )


def evaluate_report(df: DataFrame, true: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    return accuracy(df, true, predicted).select(percent_text(F.col("accuracy")).alias("accuracy"))


def batch_accuracy(
    df: DataFrame, row_number: str, size: int = 100_000, true: str = "y_true", predicted: str = "y_pred"
) -> DataFrame:
    """Accuracy per run of ``size`` consecutive rows, numbered from 1."""
    batch = F.floor((F.col(row_number) - 1) / size).cast("bigint").alias("batch_id")
    return (
        df.groupBy(batch)
        .agg(F.count("*").alias("n_rows"), _hits(true, predicted).alias("n_correct"))
        .withColumn("accuracy", F.col("n_correct") / F.col("n_rows"))
    )


def test_metrics(scored: DataFrame, target: str = "target_idx") -> DataFrame:
    """Mean loss and accuracy of scored rows carrying the true class index."""
    return scored.agg(
        F.avg(cross_entropy(F.col("scores"), F.col(target))).alias("loss"),
        F.avg((F.col("label_idx") == F.col(target)).cast("double")).alias("accuracy"),
    )


def split_shapes(assigned: DataFrame, n_columns: Column | int, split: str = "split") -> DataFrame:
    """Rows per split and the width its features have."""
    width = n_columns if isinstance(n_columns, Column) else F.lit(n_columns)
    return assigned.groupBy(split).agg(F.count("*").alias("n_rows")).withColumn("n_columns", width.cast("bigint"))


def baseline_metrics(history: DataFrame, test_accuracy: Column, tolerance: float) -> DataFrame:
    """What later evaluations are measured against; accuracies are means over the epochs.

    The labels that the model knows are rows of their own, the model's label table.
    """
    return history.agg(
        F.avg("accuracy").alias("mean_train_accuracy"), F.avg("val_accuracy").alias("mean_val_accuracy")
    ).select("*", test_accuracy.alias("test_accuracy"), F.lit(float(tolerance)).alias("accuracy_tolerance"))


def model_record(
    baseline: DataFrame, experiment: str, run_name: Column, run_id: Column, features: Sequence[str], target: str
) -> DataFrame:
    """The published description of a model."""
    return baseline.select(
        F.lit(experiment).alias("experiment"),
        run_name.alias("run_name"),
        run_id.alias("run_id"),
        percent_text(F.col("mean_train_accuracy")).alias("train_accuracy"),
        percent_text(F.col("mean_val_accuracy")).alias("val_accuracy"),
        percent_text(F.col("test_accuracy")).alias("test_accuracy"),
        F.array(*[F.lit(c) for c in features]).alias("features"),
        F.array(F.lit(target)).alias("targets"),
    )
