"""Numeric expressions: TF-IDF weights, one-hot vectors and the network's activations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def term_weight(count: Column) -> Column:
    return 1 + F.log(count.cast("double"))


def inverse_document_frequency(n_docs: Column, doc_freq: Column) -> Column:
    return F.log(1 + n_docs / (1 + doc_freq))


def one_hot(index: Column, size: Column) -> Column:
    return F.transform(F.sequence(F.lit(0).cast("bigint"), size - 1), lambda i: F.when(i == index, 1.0).otherwise(0.0))


def relu(z: Column) -> Column:
    return F.greatest(z, F.lit(0.0))


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def arg_max(values: Column) -> Column:
    """Zero-based position of the largest value, the lowest one on ties."""
    return F.array_position(values, F.array_max(values)) - 1
