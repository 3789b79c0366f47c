"""Token ids of all texts, encoded once and stored."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.support import materialise, slices, texts_of
from lexmill.llm.words import default_vocabulary, library_encoder


def binaries(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def stored_ids(
    docs: DataFrame,
    end_id: int,
    vocabulary: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    key: Callable[[list[np.ndarray]], np.ndarray] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Documents (row, doc_id, n_tokens, ids, key) with the ids of each text and the end id, and the tasks' counts (id, n).

    Ids take two bytes each if all of a document fit, else four. ``row`` tells rows apart even if ids repeat or are
    null. ``key`` gives a number for each document from its ids, else the column is null. All is stored in one
    pass, so texts are encoded once; a task's counts are one row behind its documents.
    """
    vocabulary = vocabulary or default_vocabulary()
    names = ["doc_id", "n_tokens", "ids", "key", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocabulary)
        seen = np.zeros(1, np.int64)
        for b in slices(batches):
            ids = [np.frombuffer(c + end, "<u4") for c in encoder.encode(b.column(1).to_pylist())]
            more = np.bincount(np.concatenate(ids), minlength=len(seen))
            more[: len(seen)] += seen
            seen = more
            stored = [(i.astype("<u2") if i.max() < 1 << 16 else i).tobytes() for i in ids]
            keys = pa.nulls(len(ids), pa.int64()) if key is None else pa.array(key(ids), pa.int64())
            n = pa.array([len(i) for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n, binaries(stored), keys, pa.nulls(len(ids), pa.binary())], names)
        used = np.flatnonzero(seen)
        counts = binaries([np.stack([used, seen[used]]).astype("<i8").tobytes()])
        nothing = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.int64())]
        yield pa.RecordBatch.from_arrays([*nothing, counts], names)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.column(0).to_pylist():
                used, n = np.frombuffer(row, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n)], ["id", "n"])

    end = np.uint32(end_id).astype("<u4").tobytes()
    coded = texts_of(docs, id_column, text_column).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids binary, key bigint, counts binary"
    )
    table = materialise(coded.withColumn("row", F.monotonically_increasing_id()), "token-ids")
    counted = table.where(F.col("counts").isNotNull()).select("counts").mapInArrow(spread, "id bigint, n bigint")
    return table.where(F.col("counts").isNull()).drop("counts"), counted


def ids_of(stored: bytes, n_tokens: int) -> np.ndarray:
    return np.frombuffer(stored, "<u2" if len(stored) == 2 * n_tokens else "<u4")
