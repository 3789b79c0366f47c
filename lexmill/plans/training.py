"""The training job: from labelled rows to a stored, registered model."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.config import ModelName, TrainingParams
from lexmill.functions.display import hours_minutes_seconds, run_name
from lexmill.functions.text import clean
from lexmill.operators.features import tfidf
from lexmill.operators.labels import encode_labels, fit_labels
from lexmill.operators.metrics import baseline_metrics, model_record, split_shapes
from lexmill.operators.network import Model, scoring_words
from lexmill.operators.order import (
    assign_split,
    cap_rows,
    head_rows,
    order_key,
    preview,
    require_non_empty_splits,
)
from lexmill.operators.quality import project_roles, repair
from lexmill.operators.trainer import Fitted, train_network
from lexmill.operators.vocabulary import (
    corpus_statistics,
    fit_vocabulary,
    index_width,
    top_entries,
    top_words,
    word_count_report,
)
from lexmill.sources.artifacts import (
    publish_version,
    register_run,
    save_readable,
    save_tables,
    version_folder,
    with_labels,
    write_word_counts,
)
from lexmill.sources.delimited import ROW_INDEX, FileRows, dataset_uri, file_rows, read_paired
from lexmill.sources.workspace import job_folder, materialise, new_path

# Fixed value: the name of a run that a retrain decision started.
RETRAIN_RUN = "self_training"

PARAMS_SCHEMA = T.StructType(
    [
        T.StructField("feature_columns", T.ArrayType(T.StringType())),
        T.StructField("target_column", T.StringType()),
        T.StructField("selected_columns", T.ArrayType(T.StringType())),
        T.StructField("separator", T.StringType()),
        T.StructField("encoding", T.StringType()),
        T.StructField("stop_words", T.ArrayType(T.StringType())),
        T.StructField("remove_stop_words", T.BooleanType()),
        T.StructField("drop_missing", T.BooleanType()),
        T.StructField("max_rows", T.LongType()),
        T.StructField("num_words", T.LongType()),
        T.StructField("holdout_share", T.DoubleType()),
        T.StructField("neurons", T.LongType()),
        T.StructField("use_dropout", T.BooleanType()),
        T.StructField("dropout_rate", T.DoubleType()),
        T.StructField("batch_size", T.LongType()),
        T.StructField("epochs", T.LongType()),
        T.StructField("accuracy_tolerance", T.DoubleType()),
        T.StructField("seed", T.LongType()),
        T.StructField("cap_seed", T.LongType()),
        T.StructField("shards", T.LongType()),
        T.StructField("averages_per_epoch", T.LongType()),
    ]
)


@dataclass(frozen=True)
class TrainingRun:
    """What a finished run left behind."""

    folder: str
    run_id: str
    model: Model
    history: DataFrame
    baseline: DataFrame
    info: DataFrame


def params_table(spark: SparkSession, params: TrainingParams) -> DataFrame:
    values = params.as_mapping()
    return spark.createDataFrame([tuple(values[f.name] for f in PARAMS_SCHEMA)], PARAMS_SCHEMA)


def params_of(table: DataFrame) -> TrainingParams:
    return TrainingParams.from_mapping(table.first().asDict())


def prepare(rows: DataFrame, params: TrainingParams, id_column: str, take_head: bool = False) -> DataFrame:
    """Stored ``(doc_id, split, label, clean, order_key)`` of the rows a run uses.

    ``take_head`` keeps the first rows in file order when there are too many; otherwise a
    seeded shuffle picks them. Of the rows that are not used only ids and missing values are looked at.
    """
    selected = [c for c in params.used_columns if c not in (*params.feature_columns, params.target_column)]
    roles = project_roles(rows, params.feature_columns, params.target_column, keep=[id_column, *selected])
    kept = head_rows(roles, id_column, params.max_rows) if take_head else roles
    repaired = repair(kept, params.used_columns, params.drop_missing)
    if not take_head:
        repaired = cap_rows(repaired, id_column, params.max_rows, params.cap_seed, roles.count())
    return _prepared(assign_split(repaired, id_column, params.holdout_share, params.seed), params, id_column)


def prepare_files(files: FileRows, params: TrainingParams) -> DataFrame:
    """``prepare`` for rows in files: the sample and its splits are found on positions alone, then the chosen rows are read again.

    Texts are written for at most ``max_rows`` rows.
    """
    complete = reduce(and_, [files.values[c].isNotNull() for c in params.used_columns])
    ids = files.ids(_complete=complete)
    usable = ids.where("_complete") if params.drop_missing else ids
    chosen = cap_rows(usable.drop("_complete"), ROW_INDEX, params.max_rows, params.cap_seed, files.n_rows)
    wanted = materialise(assign_split(materialise(chosen, "chosen"), ROW_INDEX, params.holdout_share, params.seed), "wanted")
    return _prepared(repair(files.rows(wanted), params.used_columns, params.drop_missing), params, ROW_INDEX)


def _prepared(split: DataFrame, params: TrainingParams, id_column: str) -> DataFrame:
    text = clean([F.col(c) for c in params.feature_columns], params.stop_words, params.remove_stop_words)
    return materialise(
        split.select(
            F.col(id_column).alias("doc_id"),
            "split",
            F.col(params.target_column).alias("label"),
            text.alias("clean"),
            order_key(id_column, params.seed).alias("order_key"),
        ),
        "prepared",
        by="split",
        compression="zstd",
    )


def feature_rows(
    prepared: DataFrame, vocab: DataFrame, labels: DataFrame, n_docs: int, num_words: int | None
) -> DataFrame:
    """``(doc_id, split, label_idx, idx, tfidf)``; documents without tokens keep one row."""
    targets = encode_labels(prepared.select("doc_id", "split", "label", "clean"), "label", labels, strict=True)
    return tfidf(targets, vocab, n_docs, num_words, keep=["split", "label_idx"], keep_empty=True)


def fit(prepared: DataFrame, params: TrainingParams, folder: str) -> tuple[Model, Fitted]:
    """Vocabulary, labels, features and network of one run, from its prepared rows.

    What the model needs is stored under ``folder``; all else is removed.
    """
    with job_folder(prepared.sparkSession):
        return _fit(prepared, params, folder)


def _fit(prepared: DataFrame, params: TrainingParams, folder: str) -> tuple[Model, Fitted]:
    counts = {r["split"]: r["count"] for r in prepared.groupBy("split").count().collect()}
    require_non_empty_splits(sum(counts.values()), params.holdout_share)
    n_docs = counts["train"]
    train = prepared.where(F.col("split") == "train")
    with job_folder(prepared.sparkSession):
        vocab = fit_vocabulary(train, "order_key", path=f"{folder}/vocabulary")
    labels = materialise(fit_labels(prepared, "label"), "labels", f"{folder}/labels")
    n_words, n_classes = vocab.count(), labels.count()
    features = feature_rows(prepared, vocab, labels, n_docs, params.num_words)
    fitted = train_network(
        features, vocab, n_words, n_classes, n_docs, params, new_path(prepared.sparkSession, "training")
    )
    hidden = materialise(fitted.hidden, "hidden", f"{folder}/hidden")
    network = materialise(fitted.network, "network", f"{folder}/network")
    return Model(vocab, labels, hidden, network, n_docs, params.neurons, params.num_words), fitted


def train_rows(
    rows: DataFrame,
    params: TrainingParams,
    model_name: ModelName,
    folder: str,
    id_column: str,
    registry: str | None = None,
    datasets: Mapping[str, str] | None = None,
    reasons: DataFrame | None = None,
    run_label: str | None = None,
    take_head: bool = False,
    new_labels: DataFrame | None = None,
) -> TrainingRun:
    """Train on a frame whose ``id_column`` is unique, then store and register the run."""
    with job_folder(rows.sparkSession):
        started = time.time()
        prepared = prepare(rows, params, id_column, take_head)
        return _train(prepared, started, params, model_name, folder, registry, datasets, reasons, run_label, new_labels)


def _train(
    prepared: DataFrame,
    started: float,
    params: TrainingParams,
    model_name: ModelName,
    folder: str,
    registry: str | None,
    datasets: Mapping[str, str] | None,
    reasons: DataFrame | None,
    run_label: str | None,
    new_labels: DataFrame | None = None,
) -> TrainingRun:
    spark = prepared.sparkSession
    run_id = uuid.uuid4().hex
    version = version_folder(folder, run_id)
    model, fitted = fit(prepared, params, version)
    baseline = materialise(
        baseline_metrics(fitted.history, F.lit(fitted.test_accuracy), params.accuracy_tolerance),
        "baseline",
        f"{version}/baseline_metrics",
    )
    label = F.lit(run_label) if run_label else run_name(F.lit(datetime.fromtimestamp(int(started))))
    info = materialise(
        model_record(
            baseline, model_name.experiment, label, F.lit(run_id), params.feature_columns, params.target_column
        ),
        "info",
        f"{version}/model_info",
    )
    tables = {"training_params": params_table(spark, params), "training_history": fitted.history}
    tables["corpus"] = spark.createDataFrame([(model.n_docs,)], "n_docs bigint")
    if datasets:
        tables["dataset_names"] = spark.createDataFrame(list(datasets.items()), "role string, uri string")
    if reasons is not None:
        tables["training_reasons"] = reasons
    if new_labels is not None:
        tables["new_labels"] = new_labels
    save_tables(version, {**tables, "scoring_words": scoring_words(model)})
    train = prepared.where(F.col("split") == "train")
    width = index_width(model.vocab.count(), params.num_words)
    reports = {
        "model_info": with_labels(info, model.labels.select("label"), "predictable_labels"),
        "baseline_metrics": baseline,
        "split_shapes": split_shapes(prepared, width),
        "corpus_statistics": corpus_statistics(prepared, train, model.vocab, "label"),
        "top_words": top_words(model.vocab),
        "first_entries": top_entries(model.vocab),
        "preview": preview(train.select("doc_id", "clean", "label", "order_key"), "order_key"),
    }
    if reasons is not None and new_labels is not None:
        reports["training_reasons"] = with_labels(reasons, new_labels, "unknown_labels", ";")
    save_readable(f"{folder}/readable", {**tables, **reports})
    write_word_counts(word_count_report(model.vocab, params.num_words), f"{folder}/readable/word_counts")
    stored = ["vocabulary", "labels", "hidden", "network", "scoring_words", "model_info", "baseline_metrics", *tables]
    publish_version(spark, folder, run_id, stored)
    if registry:
        _register(registry, model_name, run_id, folder, info, model.labels, fitted, time.time() - started, stored)
    return TrainingRun(folder, run_id, model, fitted.history, baseline, info)


def _register(
    registry: str,
    model_name: ModelName,
    run_id: str,
    folder: str,
    info: DataFrame,
    labels: DataFrame,
    fitted: Fitted,
    seconds: float,
    stored: Sequence[str],
) -> None:
    spark = info.sparkSession
    experiment, run = F.lit(model_name.experiment), F.lit(run_id)
    hours, minutes, rest = hours_minutes_seconds(F.lit(seconds))
    tags = F.lit(json.dumps(dict(model_name.tags), ensure_ascii=False))
    runs = info.select(
        "*",
        F.lit(model_name.name).alias("model_name"),
        F.lit(folder).alias("folder"),
        tags.alias("tags"),
        F.lit(fitted.test_loss).alias("test_loss"),
        hours.alias("hours"),
        minutes.alias("minutes"),
        rest.alias("seconds"),
    )
    metrics = fitted.history.select(experiment.alias("experiment"), run.alias("run_id"), "*")
    labels = labels.select(experiment.alias("experiment"), run.alias("run_id"), "label")
    artifacts = spark.createDataFrame([(a,) for a in stored], "artifact string").select(
        experiment.alias("experiment"), run.alias("run_id"), "artifact"
    )
    register_run(registry, runs, metrics, artifacts, labels)


def train_job(
    spark: SparkSession,
    uri: str,
    params: TrainingParams,
    model_name: ModelName,
    folder: str,
    registry: str | None = None,
    datasets: Mapping[str, str] | None = None,
    provider: str | None = None,
    multi_line: bool = True,
) -> TrainingRun:
    """Train from one delimited file set."""
    with job_folder(spark):
        started = time.time()
        where = dataset_uri(provider, uri)
        files = file_rows(spark, where, params.used_columns, params.separator, params.encoding, multi_line)
        prepared = prepare_files(files, params)
        return _train(prepared, started, params, model_name, folder, registry, datasets, None, None)


def retrain_job(
    spark: SparkSession,
    datasets: Mapping[str, str],
    params: TrainingParams,
    model_name: ModelName,
    folder: str,
    reasons: DataFrame | None = None,
    registry: str | None = None,
    provider: str | None = None,
    multi_line: bool = True,
    new_labels: DataFrame | None = None,
) -> TrainingRun:
    """Train again from paired feature and target files, on their first ``max_rows`` rows.

    ``reasons`` is the decision that led here, ``new_labels`` the labels (label, n) that it counted. The new model is stored and
    registered under ``folder``; the one in use is not touched.
    """
    with job_folder(spark):
        rows = read_paired(
            spark,
            dataset_uri(provider, datasets["features"]),
            dataset_uri(provider, datasets["targets"]),
            [c for c in params.used_columns if c != params.target_column],
            [params.target_column],
            params.separator,
            params.encoding,
            multi_line,
            first_rows=params.max_rows,
        )
        return train_rows(
            rows, params, model_name, folder, ROW_INDEX, registry, datasets, reasons, RETRAIN_RUN, take_head=True,
            new_labels=new_labels,
        )
