"""Column roles, missing values and the cleaning report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.config import MISSING_FILL, require_columns
from lexmill.functions.display import percent_text


def project_roles(df: DataFrame, features: Sequence[str], target: str, keep: Sequence[str] = ()) -> DataFrame:
    require_columns(df.columns, [*keep, *features], "feature")
    require_columns(df.columns, [target], "target")
    return df.select(*keep, *features, target)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values per column, one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n_missing")


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(columns))


def fill_missing(df: DataFrame, columns: Sequence[str], filler: str = MISSING_FILL) -> DataFrame:
    return df.na.fill(filler, subset=list(columns))


def repair(df: DataFrame, columns: Sequence[str], drop: bool) -> DataFrame:
    """The one policy for missing values: drop the row or fill the field."""
    return drop_missing(df, columns) if drop else fill_missing(df, columns)


def cleaning_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What dropping rows with missing values would remove; empty if nothing."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    counts = df.agg(F.count("*").alias("rows_before"), F.count_if(complete).alias("rows_after"))
    removed = F.col("rows_before") - F.col("rows_after")
    return counts.where(removed > 0).select(
        "rows_before",
        removed.alias("rows_removed"),
        "rows_after",
        percent_text(removed / F.col("rows_before")).alias("share_removed"),
    )
