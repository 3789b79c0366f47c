"""Scoring of arriving files with a stored model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def score_stream(
    spark: SparkSession,
    source: str,
    schema: str,
    output: str,
    rejects: str,
    checkpoint: str,
    score: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Score every parquet file that has arrived under ``source``, then stop.

    ``score`` gives the scores and the requests that have none, with the reason; these go to the ``rejects`` folder,
    and the stream goes on. Each micro-batch replaces the folders of its own batch id, so a batch that is run
    again after a failure is written once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        scored, rejected = score(held)
        scored.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")
        rejected.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
        held.unpersist()

    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return (
        arriving.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """What the stream has written to its output or rejects folder so far."""
    return spark.read.parquet(folder).drop("batch_id")
