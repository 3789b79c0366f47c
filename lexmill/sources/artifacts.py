"""Stored runs: one parquet table per artifact, readable copies, and the run registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def save_tables(folder: str, tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    try:
        return spark.read.parquet(f"{folder}/{name}")
    except AnalysisException as e:
        raise FileNotFoundError(f"no artifact '{name}' under '{folder}'") from e


#: The columns of a manifest: a row for each table of a published version.
MANIFEST_SCHEMA = "version string, published_at string, artifact string, fields string, n_rows bigint"


def version_folder(folder: str, version: str) -> str:
    return f"{folder}/version-{version}"


def publish_version(spark: SparkSession, folder: str, version: str, artifacts: Sequence[str]) -> None:
    """Make a stored version the current one.

    The manifest names its tables with their columns and rows and is written last, as one file: until then the version before stays current.
    """
    at = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    rows = []
    for name in artifacts:
        df = load_table(spark, version_folder(folder, version), name)
        rows.append((version, at, name, df.schema.simpleString(), df.count()))
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/manifest")


def current_version(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the version published last, each checked against the manifest."""
    manifest = load_table(spark, folder, "manifest")
    last = manifest.agg(F.max(F.struct("published_at", "version")).alias("last")).select("last.*").first()
    tables = {}
    for row in manifest.where(F.col("version") == last["version"]).collect():  # a row for each kind of table
        df = load_table(spark, version_folder(folder, last["version"]), row["artifact"])
        found = df.schema.simpleString(), df.count()
        if found != (row["fields"], row["n_rows"]):
            raise BrokenVersionError(f"'{row['artifact']}' of version {last['version']} in '{folder}' is {found}, not {row[3:]}")
        tables[row["artifact"]] = df
    return tables


class BrokenVersionError(RuntimeError):
    """A published table is not what its manifest says."""


def save_readable(folder: str, tables: Mapping[str, DataFrame]) -> None:
    """JSON copies for people and other tools."""
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")


def with_labels(record: DataFrame, labels: DataFrame, name: str, separator: str = ",") -> DataFrame:
    """A record of one row with its labels as one text, for people: by falling count if they have one (``label=n``), then by label.

    Null if there are none.
    """
    if "n" in labels.columns:
        entries = "listagg(concat(label, '=', n), :s) WITHIN GROUP (ORDER BY n DESC, label)"
    else:
        entries = "listagg(label, :s) WITHIN GROUP (ORDER BY label)"
    return record.crossJoin(labels.agg(F.expr(entries.replace(":s", f"'{separator}'")).alias(name)))


def write_word_counts(report: DataFrame, path: str) -> None:
    """Word-count report as ``;``-separated text, rows in order across the part files."""
    (
        report.orderBy(F.desc("quantity"), "idx")
        # The report's column names.
        .select(
            F.col("word").alias("palavra"),
            F.col("quantity").alias("quantidade"),
            F.col("percent").alias("percentual"),
        )
        .write.mode("overwrite")
        .option("sep", ";")
        .option("header", True)
        .csv(path)
    )


def register_run(
    registry: str,
    runs: DataFrame,
    metrics: DataFrame | None = None,
    artifacts: DataFrame | None = None,
    labels: DataFrame | None = None,
) -> None:
    """Append a run and what belongs to it. The run's own row goes last, so a listed run is a complete one."""
    for name, df in (("metrics", metrics), ("artifacts", artifacts), ("labels", labels), ("runs", runs)):
        if df is not None:
            df.write.mode("append").partitionBy("experiment").parquet(f"{registry}/{name}")


def read_registry(spark: SparkSession, registry: str, name: str = "runs") -> DataFrame:
    return load_table(spark, registry, name)


def model_info(runs: DataFrame, run_id: str | Column) -> DataFrame:
    """The registered information of one run; its version is the run id."""
    return runs.where(F.col("run_id") == run_id).withColumn("version", F.col("run_id"))
