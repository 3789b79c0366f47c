"""Intermediate tables.

A frame that several later steps read is written once and read back: that cuts its
lineage, survives the loss of executors and lets later steps prune columns.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOCAL_BASE: dict[str, str] = {}


def scratch_base(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as the session names it in ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_BASE:
        _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="lexmill-")
    return _LOCAL_BASE[app]


_JOB: ContextVar[str | None] = ContextVar("job folder", default=None)
_SESSIONS: set[str] = set()


def session_folder(spark: SparkSession) -> str:
    """The session's own intermediate tables. Those behind results that are read later can't go with a job: they go when the program ends."""
    app = spark.sparkContext.applicationId
    folder = f"{scratch_base(spark)}/lexmill/session-{app}"
    if folder not in _SESSIONS:
        _SESSIONS.add(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        atexit.register(_remove_at_exit, files, path)
    return folder


def _remove_at_exit(files, path) -> None:
    with suppress(Exception):  # the JVM may be gone already
        files.delete(path, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A place of its own, inside the folder of the job that runs in this thread, if any, else in that of the session."""
    return f"{_JOB.get() or session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediate tables, wherever the session's file systems keep it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# The setting by which a query's shuffle files are removed when it ends, not when the driver happens to collect its garbage. Spark makes a lost one anew.
_REMOVED_AT_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for the intermediate tables of one job, removed when the job ends. Its shuffle files go as soon as a query has ended.

    What outlives the job must have been written elsewhere. Jobs in other threads have folders of their own.
    """
    shuffles = spark.conf.get(_REMOVED_AT_END, None)
    spark.conf.set(_REMOVED_AT_END, "true")
    folder = f"{_JOB.get() or session_folder(spark)}/job-{uuid.uuid4().hex}"
    token = _JOB.set(folder)
    try:
        yield folder
    finally:
        _JOB.reset(token)
        if shuffles is None:
            spark.conf.unset(_REMOVED_AT_END)
        else:
            spark.conf.set(_REMOVED_AT_END, shuffles)
        remove_folder(spark, folder)


def materialise(
    df: DataFrame, name: str, path: str | None = None, by: str | None = None, compression: str | None = None
) -> DataFrame:
    """Write ``df`` once and return the stored table, in folders per value of ``by`` if given."""
    spark = df.sparkSession
    target = path or new_path(spark, name)
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    (writer.partitionBy(by) if by else writer).parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is worked out once per row.

    Expressions are otherwise copied to every place that uses the column, also into the bodies of
    array functions, where they would run per element; nothing is moved past a generator.
    """
    return df.select(*df.columns, F.explode(F.array(value)).alias(name))


# Fixed limit: what may be sent to every executor.
BROADCAST_BYTES = 256 * 1024 * 1024
# Fixed estimate: heap cost of one broadcast row besides its strings.
_ROW_OVERHEAD = 64


def row_bytes(df: DataFrame) -> Column:
    """What a row costs when it is broadcast."""
    per_row: Column = F.lit(_ROW_OVERHEAD + 8 * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            per_row = per_row + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            per_row = per_row + 8 * F.coalesce(F.size(f.name), F.lit(0))
    return per_row


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure whether ``df`` is small enough to broadcast. Call it on stored tables."""
    measured = df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("n")).first()
    return measured["n"] <= limit


# Fixed limit: bytes of rows that go to a Python worker at a time. Workers stay, and keep the most they ever held.
_BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def _in_bytes(size: str) -> int:
    """A size as Spark's settings write it: 4194304, 4194304b, 4m, 4MB."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in small batches; the session keeps that setting, or its own if that is smaller."""
    if not 0 < _in_bytes(spark.conf.get(_BATCH)) <= _BATCH_BYTES:
        spark.conf.set(_BATCH, f"{_BATCH_BYTES}b")
