"""Delimited files: all-string scans, missing-token handling, row positions, paired files."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.config import JobConfigError, require_columns, require_keys
from lexmill.sources.workspace import fits_broadcast, materialise

# Field texts that count as missing, quoted or not.
MISSING_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

ROW_INDEX = "row_index"

# Fixed size: rows per written file. One task reads a file that may hold line breaks in its fields, and a head lies in the first files.
FILE_ROWS = 5_000

# URI scheme per storage provider.
PROVIDER_SCHEMES = {"local": "file://", "object_store": "s3a://"}


def dataset_uri(provider: str | None, path: str) -> str:
    """Where a dataset lies, by the name of its storage provider; a full URI, or any path without a provider, is left as it is."""
    if provider is None or "://" in path:
        return path
    require_keys(PROVIDER_SCHEMES, [provider], "storage provider")
    return PROVIDER_SCHEMES[provider] + path


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(list(MISSING_TOKENS)), c)


def normalise_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.withColumns({c: missing_to_null(F.col(c)) for c in columns or df.columns})


def _scan(spark: SparkSession, uri: str | list[str], separator: str, encoding: str, multi_line: bool = True) -> DataFrame:
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("sep", separator)
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(uri)
    )


def read_delimited(
    spark: SparkSession,
    uri: str | list[str],
    columns: Sequence[str] | None = None,
    separator: str = ",",
    encoding: str = "utf-8",
    with_index: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """Every column as string, missing tokens as null, only ``columns`` kept.

    With ``multi_line`` quoted fields may hold line breaks, and one file is read by one task: supply many
    files, or land them as parquet first. Without it every line is a row and large files are
    split. The URI scheme picks the storage provider.
    """
    raw = _scan(spark, uri, separator, encoding, multi_line)
    wanted = list(columns) if columns is not None else raw.columns
    require_columns(raw.columns, wanted, "selected")
    if not with_index:
        return normalise_missing(raw.select(*wanted))
    return indexed_rows(raw, {c: missing_to_null(F.col(c)) for c in wanted}).all()


@dataclass(frozen=True)
class FileRows:
    """The rows of a file set by their position in file order, files taken by name; nothing of their content is stored.

    ``splits`` is a stored table with a row for each file split: how many rows it has, and how many come before it. A split is read by one task
    from its beginning, so a row's place in it is counted while it passes, in whatever way the splits are packed into tasks.
    """

    scan: DataFrame
    values: Mapping[str, Column]
    splits: DataFrame
    n_rows: int

    def all(self) -> DataFrame:
        """``(row_index, columns)`` of every row."""
        return self._positions(self._placed(self.scan, self.values)).select(ROW_INDEX, *self.values)

    def head(self, n: int) -> DataFrame:
        """``(row_index, columns)`` of the first ``n`` rows: only the splits that hold them are read."""
        last = self.splits.where(F.col("_offset") < n).agg(F.max(F.struct("_file", "_block")).alias("last")).first()["last"]
        if last is None:
            return self.all()
        file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
        leading = self.scan.where((file < last["_file"]) | ((file == last["_file"]) & (block <= last["_block"])))
        rows = self._positions(self._placed(leading, self.values))
        return rows.where(F.col(ROW_INDEX) < n).select(ROW_INDEX, *self.values)

    def ids(self, **flags: Column) -> DataFrame:
        """Stored ``(row_index, flags)`` of every row; ``flags`` are made of ``values``."""
        ids = materialise(self._positions(self._placed(self.scan, flags)).select(ROW_INDEX, *flags), "ids")
        found = ids.agg(F.count("*").alias("rows"), F.coalesce(F.max(ROW_INDEX) + 1, F.lit(0)).alias("upto")).first()
        if tuple(found) != (self.n_rows, self.n_rows):
            raise RuntimeError(f"{found['rows']} rows got positions up to {found['upto']}, but the files held {self.n_rows}")
        return ids

    def rows(self, wanted: DataFrame) -> DataFrame:
        """``wanted``, a stored choice of ``ids``, with the columns of its rows; other rows go where they are read."""
        return self.all().join(F.broadcast(wanted) if fits_broadcast(wanted) else wanted, ROW_INDEX)

    def _positions(self, placed: DataFrame) -> DataFrame:
        """Rows with their position. Splits that do not begin where one was counted are an error, never a wrong position."""
        offsets = self.splits.select("_file", "_block", "_offset")
        if fits_broadcast(self.splits):
            offsets = F.broadcast(offsets)
        lost = F.raise_error(F.concat(F.lit("the files were split otherwise before: "), "_file", F.lit(" at "), F.col("_block")))
        offset = F.coalesce("_offset", lost.cast("bigint"))
        return placed.join(offsets, ["_file", "_block"], "left").withColumn(ROW_INDEX, offset + F.col("_place")).drop("_offset")

    @staticmethod
    def _placed(scan: DataFrame, values: Mapping[str, Column]) -> DataFrame:
        """``(_file, _block, values, _place)``, the place counted from 0 in each split."""
        file, block = _split()
        read = scan.select(file, block, *[v.alias(c) for c, v in values.items()])
        return read.mapInArrow(_count_places, T.StructType([*read.schema.fields, T.StructField("_place", T.LongType())]))


_LEAST_SPLITS = "spark.sql.files.minPartitionNum"


def _split() -> tuple[Column, Column]:
    return F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")


def _count_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split, passed = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        file, block = b.column(0), b.column(1)
        new = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
        starts = np.r_[0, np.flatnonzero(new.to_numpy(zero_copy_only=False)) + 1]
        place = np.arange(b.num_rows) - np.repeat(starts, np.diff(np.r_[starts, b.num_rows]))
        if split == (file[0].as_py(), block[0].as_py()):
            upto = int(starts[1]) if len(starts) > 1 else b.num_rows
            place[:upto] += passed
        split, passed = (file[-1].as_py(), block[-1].as_py()), int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place, pa.int64())], [*b.schema.names, "_place"])


def indexed_rows(scan: DataFrame, values: Mapping[str, Column]) -> FileRows:
    """A scan of files with row positions: the rows of each split are counted, without any column.

    The number of cores would else decide where large files are split, so it is held for the session's later scans.
    """
    spark = scan.sparkSession
    if spark.conf.get(_LEAST_SPLITS, None) is None:
        spark.conf.set(_LEAST_SPLITS, spark.sparkContext.defaultParallelism)
    counted = materialise(scan.groupBy(*_split()).agg(F.count("*").alias("_rows")), "split_counts")
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = materialise(
        counted.select("_file", "_block", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")), "splits"
    )
    return FileRows(scan, values, splits, splits.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).first()["n"])


def file_rows(
    spark: SparkSession,
    uri: str | list[str],
    columns: Sequence[str],
    separator: str = ",",
    encoding: str = "utf-8",
    multi_line: bool = True,
    what: str = "selected",
) -> FileRows:
    """Delimited files by row position, every column as string, missing tokens as null."""
    raw = _scan(spark, uri, separator, encoding, multi_line)
    require_columns(raw.columns, columns, what)
    return indexed_rows(raw, {c: missing_to_null(F.col(c)) for c in columns})


def add_row_index(scan: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero-based position of each row in file order, files taken by name."""
    return indexed_rows(scan, {c: F.col(c) for c in columns}).all()


def first_rows(scan: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in file order, with their position; later files are not read."""
    return indexed_rows(scan, {c: F.col(c) for c in columns}).head(n)


def pair_by_key(features: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    return features.join(targets, key)


def read_paired(
    spark: SparkSession,
    features_uri: str,
    targets_uri: str,
    feature_columns: Sequence[str],
    target_columns: Sequence[str],
    separator: str = ",",
    encoding: str = "utf-8",
    multi_line: bool = True,
    first_rows: int | None = None,
) -> DataFrame:
    """Features and targets kept in two file sets whose rows correspond by position.

    A blank target line is skipped by the reader and would shift every later label, which
    is why different numbers of rows are an error. ``first_rows`` keeps the rows before that
    position of either side; only the splits that hold them are read again, and the pairs are stored. These splits may be few,
    however many cores there are, so the pairs are dealt out by position.
    """
    x = file_rows(spark, features_uri, feature_columns, separator, encoding, multi_line, "feature")
    y = file_rows(spark, targets_uri, target_columns, separator, encoding, multi_line, "target")
    if x.n_rows != y.n_rows:
        raise JobConfigError(f"features have {x.n_rows} rows but targets have {y.n_rows}")
    if first_rows is None:
        return x.all().join(y.all(), ROW_INDEX)
    parts = 2 * spark.sparkContext.defaultParallelism
    heads = [side.head(first_rows).repartition(parts, ROW_INDEX) for side in (x, y)]
    return materialise(heads[0].join(heads[1], ROW_INDEX), "paired")


def write_delimited(df: DataFrame, path: str, separator: str = ",", compression: str | None = None) -> None:
    """Write so that ``read_delimited`` gives the same texts back, blanks included, in files of ``FILE_ROWS`` rows at most.

    The names of a task's files rise with its rows, up to 1 000 files a task. ``compression`` suits files that one task reads whole anyway.
    """
    (
        df.write.mode("overwrite")
        .option("compression", compression or "none")
        .option("maxRecordsPerFile", FILE_ROWS)
        .option("header", True)
        .option("sep", separator)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
