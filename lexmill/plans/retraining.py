"""Scoring fresh labelled data against a stored baseline."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.config import TrainingParams, require_keys
from lexmill.operators.metrics import batch_accuracy
from lexmill.operators.quality import repair
from lexmill.operators.review import retrain_decision, unknown_labels
from lexmill.plans.publishing import PublishedModel, predict_rows
from lexmill.sources.delimited import ROW_INDEX, dataset_uri, read_paired
from lexmill.sources.workspace import materialise

# Fixed value: rows per reported batch of an evaluation.
BATCH_ROWS = 100_000


def scored_pairs(rows: DataFrame, published: PublishedModel, params: TrainingParams, key: str = ROW_INDEX) -> DataFrame:
    """``(key, y_true, y_pred)`` of labelled rows, under the same missing-value policy as training."""
    judged = repair(rows, params.used_columns, params.drop_missing).withColumn("y_true", F.col(params.target_column))
    predicted = predict_rows(judged, published, params.feature_columns, key, ["y_true"])
    return predicted.select(key, "y_true", F.col("label").alias("y_pred"))


def evaluate_for_retraining(
    spark: SparkSession,
    published: PublishedModel,
    datasets: Mapping[str, str],
    baseline: DataFrame | None = None,
    known: DataFrame | None = None,
    params: TrainingParams | Mapping[str, Any] | None = None,
    batch_rows: int = BATCH_ROWS,
    provider: str | None = None,
    multi_line: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The decision row, the accuracy per batch and the labels the model does not know, of paired feature and target files.

    ``baseline`` and ``known`` labels are those of the model unless others are given.

    Without ``multi_line`` every line is a row, and large files are split among tasks.
    """
    require_keys(datasets, ["features", "targets"], "dataset")
    if params is None:
        params = published.params
    elif not isinstance(params, TrainingParams):
        params = TrainingParams.from_mapping(params)
    rows = read_paired(
        spark,
        dataset_uri(provider, datasets["features"]),
        dataset_uri(provider, datasets["targets"]),
        [c for c in params.used_columns if c != params.target_column],
        [params.target_column],
        params.separator,
        params.encoding,
        multi_line,
    )
    pairs = materialise(scored_pairs(rows, published, params), "scored_pairs")
    measured = published.baseline if baseline is None else baseline
    labels = published.known_labels if known is None else known
    decision = retrain_decision(pairs, measured, labels).withColumn("evaluated_run_id", published.info.select("run_id").scalar())
    numbered = pairs.withColumn("row_number", F.col(ROW_INDEX) + 1)
    return decision, batch_accuracy(numbered, "row_number", batch_rows), unknown_labels(pairs, labels)
