"""Prediction requests: delimited strings, and the checks made before they are scored."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.text import split_fields

EMPTY_REQUEST = "the request holds no rows"


def requests_from_list(spark: SparkSession, rows: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(rows)), "request_id bigint, request string")


def with_fields(df: DataFrame, column: str = "request", separator: str = ";") -> DataFrame:
    return df.withColumn("fields", split_fields(F.col(column), separator))


def long_fields(df: DataFrame, key: str) -> DataFrame:
    """One row per field, numbered from 0."""
    return df.select(key, F.posexplode_outer("fields").alias("position", "field"))


def width_profile(df: DataFrame) -> DataFrame:
    """How many requests have each number of fields."""
    return df.groupBy(F.size("fields").cast("bigint").alias("n_fields")).agg(F.count("*").alias("n_rows"))


def ragged_rows(df: DataFrame, key: str) -> DataFrame:
    """Requests whose number of fields differs from that of the first one (lowest key)."""
    first = df.agg(F.min_by(F.size("fields"), F.col(key)).alias("w")).scalar()
    width = F.size("fields")
    return df.where(width != first).select(key, width.cast("bigint").alias("n_fields"))


def watched(df: DataFrame, seen: Observation) -> DataFrame:
    """The rows, which tell ``seen`` in passing what ``request_problem`` needs."""
    return df.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("fields").isNull()).alias("n_null"),
        F.min(F.size("fields")).alias("lo"),
        F.max(F.size("fields")).alias("hi"),
    )


def request_problem(found: Mapping[str, Any]) -> str | None:
    """Why the requests that were seen cannot be scored, or None."""
    if not found or found["n"] == 0:
        return EMPTY_REQUEST
    if found["n_null"]:
        return f"{found['n_null']} request row(s) hold no text"
    if found["lo"] != found["hi"]:
        return f"requests must all have the same number of fields, found between {found['lo']} and {found['hi']}"
    return None
