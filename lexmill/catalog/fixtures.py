"""Inputs of the registered queries, all derived from the given tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.config import TrainingParams
from lexmill.functions.text import clean
from lexmill.operators.labels import fit_labels
from lexmill.operators.network import Model, network_table
from lexmill.operators.order import assign_split, order_key
from lexmill.operators.vocabulary import fit_vocabulary
from lexmill.sources.delimited import MISSING_TOKENS
from lexmill.sources.workspace import materialise

# Fixed sizes of the check network.
NEURONS = 5
LIMIT = 200
SEED = 1
SHARE = 0.3
KNOWN = ("de", "en", "fr")
FEW_ROWS = 150  # what a job may use of a longer file

_FITTED: dict[tuple[str, str], "Fit"] = {}


@dataclass(frozen=True)
class Fit:
    """What several queries share: prepared documents and the tables fitted on their train split."""

    prepared: DataFrame
    vocab: DataFrame
    labels: DataFrame
    n_docs: int

    @property
    def train(self) -> DataFrame:
        return self.prepared.where(F.col("split") == "train")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def cleaned(spark: SparkSession, sf_dir: str, column: str = "text") -> DataFrame:
    """The documents with cleaned text."""
    return documents(spark, sf_dir).select("doc_id", "lang", clean([F.col(column)]).alias("clean"))


def prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = assign_split(cleaned(spark, sf_dir), "doc_id", SHARE, SEED)
    return materialise(
        split.withColumnRenamed("lang", "label").withColumn("order_key", order_key("doc_id", SEED)), "prepared", by="split"
    )


def fitted(spark: SparkSession, sf_dir: str) -> Fit:
    """Fit once per session and data folder; the stored tables serve every query after that."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        prepared = prepare(spark, sf_dir)
        train = prepared.where(F.col("split") == "train")
        vocab = fit_vocabulary(train, "order_key")
        labels = materialise(fit_labels(prepared, "label"), "labels")
        _FITTED[key] = Fit(prepared, vocab, labels, train.count())
    return _FITTED[key]


def forget() -> None:
    """Drop what was fitted, so that the next query pays for its own fit."""
    _FITTED.clear()


def _input_weight(divisor: float, j: int) -> F.Column:
    return (F.pmod(31 * F.col("idx") + 17 * j, F.lit(101)) - 50) / F.lit(divisor)


def fixed_model(spark: SparkSession, sf_dir: str, num_words: int | None = LIMIT, divisor: float = 500.0) -> Model:
    """A network whose weights follow a rule, so that its scores can be checked."""
    fit = fitted(spark, sf_dir)
    oov = spark.range(1).select(F.lit(1).cast("bigint").alias("idx"))
    indices = fit.vocab.select("idx").unionByName(oov)
    hidden = indices.select("idx", F.array(*[_input_weight(divisor, j) for j in range(NEURONS)]).alias("weights"))
    classes = fit.labels.count()
    network = network_table(
        spark,
        [j / 10 for j in range(NEURONS)],
        [[((13 * j + 7 * k) % 11 - 5) / 5 for j in range(NEURONS)] for k in range(classes)],
        [k / 100 for k in range(classes)],
    )
    return Model(fit.vocab, fit.labels, hidden, network, fit.n_docs, NEURONS, num_words)


def params(**changes: object) -> TrainingParams:
    return TrainingParams(**{"feature_columns": ("text",), "target_column": "lang", "num_words": LIMIT, **changes})


def with_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = F.array(*[F.lit(t) for t in MISSING_TOKENS])
    token = F.get(tokens, (F.floor(F.col("doc_id") / 11) % len(MISSING_TOKENS)).cast("int"))
    gone = F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") % 11 == 0, token).otherwise(F.col("text"))
    return documents(spark, sf_dir).select("doc_id", gone.alias("text"), "lang")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited requests: several fields on even ids, two on odd ones."""
    text = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit(". "), F.lit(";"))).otherwise(
        F.concat_ws(";", "source", "text")
    )
    return documents(spark, sf_dir).select("doc_id", text.alias("request"))


def coarse(c: Column) -> Column:
    """Ids as careless callers give them: many rows share one, some have none."""
    return F.when(c % 5 != 0, c % 17)


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions with users' labels: right, but for each fifth document and every Spanish one."""
    guess = F.when(F.col("doc_id") % 5 == 0, "en").when(F.col("lang") == "es", "de").otherwise(F.col("lang"))
    return documents(spark, sf_dir).select("doc_id", guess.alias("y_pred"), F.col("lang").alias("y_true"), "source")


def known_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).where(F.col("lang").isin(list(KNOWN))).select(F.col("lang").alias("label")).distinct()


def history(spark: SparkSession, sf_dir: str, *groups: str) -> DataFrame:
    """Ten epochs whose accuracies are those of the judged documents dealt to them."""
    hit = (F.col("y_true") == F.col("y_pred")).cast("double")
    odd = F.col("doc_id") % 2 == 1
    epoch = (F.floor(F.col("doc_id") / 2) % 10 + 1).cast("bigint").alias("epoch")
    return (
        judged(spark, sf_dir)
        .groupBy(*groups, epoch)
        .agg(F.avg(F.when(~odd, hit)).alias("accuracy"), F.avg(F.when(odd, hit)).alias("val_accuracy"))
    )
