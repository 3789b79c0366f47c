"""A stored model in use: predictions, evaluation, feedback, information."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexmill.config import MISSING_FILL, TrainingParams
from lexmill.functions.folding import plain_field
from lexmill.functions.text import clean, plain
from lexmill.operators.metrics import evaluate_report
from lexmill.operators.network import Model, predict_labels
from lexmill.operators.review import feedback_report, unknown_labels
from lexmill.plans.training import params_of
from lexmill.sources.artifacts import current_version
from lexmill.sources.requests import EMPTY_REQUEST, request_problem, requests_from_list, watched, with_fields
from lexmill.sources.workspace import fits_broadcast, materialise


@dataclass(frozen=True)
class PublishedModel:
    """The tables of a stored run; ``words_fit`` says whether ``words`` may be broadcast, measured once."""

    name: str
    provider: str
    folder: str
    model: Model
    words: DataFrame
    info: DataFrame
    baseline: DataFrame
    params: TrainingParams
    words_fit: bool

    @property
    def known_labels(self) -> DataFrame:
        return self.model.labels.select("label")


def load_published(
    spark: SparkSession, folder: str, name: str = "text_classifier", provider: str = "local"
) -> PublishedModel:
    """The version published last under ``folder``; its tables are checked against the manifest."""
    tables = current_version(spark, folder)
    params = params_of(tables["training_params"])
    model = Model(
        tables["vocabulary"],
        tables["labels"],
        tables["hidden"],
        tables["network"],
        tables["corpus"].first()["n_docs"],
        params.neurons,
        params.num_words,
    )
    words = tables["scoring_words"]
    info, baseline = tables["model_info"], tables["baseline_metrics"]
    return PublishedModel(name, provider, folder, model, words, info, baseline, params, fits_broadcast(words))


def model_info(published: PublishedModel) -> dict[str, Any]:
    record = published.info.first()
    return record.asDict() if record else {"model_name": published.name}


def model_version(published: PublishedModel) -> str:
    return published.info.first()["run_id"]


def stop_words_of(params: TrainingParams) -> Sequence[str]:
    return params.stop_words if params.remove_stop_words else ()


def cleaned_rows(
    df: DataFrame, columns: Sequence[str], params: TrainingParams, key: str, keep: Sequence[str] = ()
) -> DataFrame:
    """``(key, clean)`` the way training cleaned its texts, with the columns in ``keep``; missing fields are filled.

    Stop words, ``stop_words_of(params)``, are still there: they are dropped while the words are counted.
    """
    filled = df.select(key, *keep, *columns).na.fill(MISSING_FILL, subset=list(columns))
    fields = [F.col(c) for c in columns]
    text = plain(fields) if stop_words_of(params) else clean(fields, (), params.remove_stop_words)
    return filled.select(key, *keep, text.alias("clean"))


def cleaned_lists(df: DataFrame, column: str, params: TrainingParams, keep: Sequence[str]) -> DataFrame:
    """``(keep, clean)`` of rows that hold their fields in a list, however many.

    Cleaning goes letter by letter and then by words, so the fields may be joined first; only where the words are not taken apart
    is each field trimmed by itself.
    """
    if params.remove_stop_words:
        text = df.select(*keep, F.array_join(column, " ").alias("_text"))
        return text.select(*keep, clean([F.col("_text")], params.stop_words).alias("clean"))
    fields = F.transform(column, lambda f: plain_field(f))
    return df.select(*keep, F.array_join(fields, " ").alias("clean"))


def predict_rows(
    df: DataFrame, published: PublishedModel, columns: Sequence[str], key: str, keep: Sequence[str] = ()
) -> DataFrame:
    """``(key, label, score)`` of rows that hold their features in columns, with the columns in ``keep``."""
    rows = cleaned_rows(df, columns, published.params, key, keep)
    stop = stop_words_of(published.params)
    return predict_labels(rows, published.model, key, published.words, keep, stop, fits=published.words_fit)


def _flat(split: DataFrame, width: int, keep: Sequence[str]) -> tuple[DataFrame, list[str]]:
    columns = [f"field_{i}" for i in range(width)]
    return split.select("request_id", *keep, *[F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(columns)]), columns


def predict(spark: SparkSession, published: PublishedModel, requests: Any, keep: Sequence[str] = ()) -> DataFrame | str:
    """Label delimited requests: a list of strings or a frame ``(request_id, request)``.

    Requests that cannot be scored give a message instead of a frame. ``keep`` names columns of the frame to pass on. The requests are
    read once: they are checked while they are scored, and the scores are stored.
    """
    if isinstance(requests, (list, tuple)):
        if not requests:
            return EMPTY_REQUEST
        if not all(isinstance(r, str) for r in requests):
            return "every request must be a string"
        requests = requests_from_list(spark, requests)
    if not isinstance(requests, DataFrame):
        return f"expected a list of strings or a DataFrame, got {type(requests).__name__}"
    seen = Observation()
    split = watched(with_fields(requests), seen)
    rows = cleaned_lists(split, "fields", published.params, ["request_id", *keep])
    scored = predict_labels(rows, published.model, "request_id", published.words, keep, fits=published.words_fit)
    stored = materialise(scored, "predicted")
    return request_problem(seen.get) or stored


def score_or_reject(published: PublishedModel, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scores of the requests that have a field for each feature column of the model, and the others with the reason.

    Every request is judged by itself, so one that is bad keeps no other from being scored.
    """
    width = len(published.params.feature_columns)
    split = with_fields(requests.select("request_id", "request"))
    found = F.size("fields")
    problem = F.when(F.col("request").isNull(), F.lit("the request holds no text")).when(
        found != width, F.format_string(f"expected {width} field(s), found %d", found)
    )
    judged = split.withColumn("reason", problem)
    flat, columns = _flat(judged.where(F.col("reason").isNull()), width, ())
    scored = predict_rows(flat, published, columns, "request_id")
    return scored, judged.where(F.col("reason").isNotNull()).select("request_id", "request", "reason")


def _uneven(left: Sequence[str], right: Sequence[str]) -> str | None:
    return None if len(left) == len(right) else f"lists of different length: {len(left)} and {len(right)}"


def evaluate(
    spark: SparkSession, published: PublishedModel, requests: DataFrame | Sequence[str], labels: Sequence[str] = ()
) -> DataFrame | str:
    """Accuracy over a frame ``(request_id, request, label)``, or over a list of texts and one of labels."""
    if not isinstance(requests, DataFrame):
        problem = _uneven(requests, labels)
        if problem or not requests:
            return problem or EMPTY_REQUEST
        rows = [(i, text, label) for i, (text, label) in enumerate(zip(requests, labels))]
        requests = spark.createDataFrame(rows, "request_id bigint, request string, label string")
    named = requests.select("request_id", "request", F.col("label").alias("y_true"))
    predicted = predict(spark, published, named, ["y_true"])
    return predicted if isinstance(predicted, str) else evaluate_report(predicted.withColumnRenamed("label", "y_pred"))


def judged_pairs(spark: SparkSession, y_pred: Sequence[str], y_true: Sequence[str]) -> DataFrame | str:
    """A feedback frame from two lists of labels."""
    problem = _uneven(y_pred, y_true)
    return problem or spark.createDataFrame(list(zip(y_pred, y_true)), "y_pred string, y_true string")


def feedback(published: PublishedModel, judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Report and unknown labels of a frame ``(y_pred, y_true)``; the model itself is not run."""
    known = published.known_labels
    return feedback_report(judged, known), unknown_labels(judged, known)
