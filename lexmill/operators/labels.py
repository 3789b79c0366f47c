"""Class labels: index, encoding, decoding, one-hot vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.config import JobConfigError
from lexmill.operators.features import lookup_words
from lexmill.operators.order import number_rows
from lexmill.sources.workspace import materialise


def distinct_labels(df: DataFrame, label: str) -> DataFrame:
    return df.select(F.col(label).alias("label")).distinct()


def fit_labels(df: DataFrame, label: str) -> DataFrame:
    """``labels(label, label_idx)``: sorted distinct labels from 0, over any number of them."""
    classes = materialise(distinct_labels(df, label).where(F.col("label").isNotNull()), "classes")
    require_classes(classes.count())
    return number_rows(classes, [F.col("label")], "label_idx", start=0)


def require_classes(n_classes: int) -> None:
    if n_classes < 1:
        raise JobConfigError("the target column holds no label")


def encode_labels(df: DataFrame, label: str, labels: DataFrame, strict: bool = False, **limits: int) -> DataFrame:
    """Add ``label_idx``. With ``strict`` a label unknown to the encoder raises when the row is read."""
    joined = lookup_words(df, labels.withColumnRenamed("label", label), ["label_idx"], on=label, **limits)
    if not strict:
        return joined
    problem = F.raise_error(F.concat(F.lit("label unknown to the encoder: "), F.coalesce(F.col(label), F.lit("null"))))
    return joined.withColumn("label_idx", F.coalesce("label_idx", problem.cast("bigint")))


def decode_labels(df: DataFrame, index: str, labels: DataFrame, name: str = "label", **limits: int) -> DataFrame:
    decoded = labels.select(F.col("label_idx").alias(index), F.col("label").alias(name))
    return lookup_words(df, decoded, [name], on=index, **limits)


def one_hot_entries(df: DataFrame, index: str, *keep: str) -> DataFrame:
    """The ones of the one-hot matrix as ``(keep, class_idx, hot)``; all other entries are zero."""
    known = df.where(F.col(index).isNotNull())
    return known.select(*keep, F.col(index).alias("class_idx"), F.lit(1.0).alias("hot"))
