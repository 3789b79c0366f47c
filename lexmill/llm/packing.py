"""Packing along a space-filling curve.

A document's vector counts its hashed token ids and is projected to a few dimensions; the projections become
cells of a grid and the grid's Hilbert curve gives one key, near for near vectors. Documents are sorted by the
key over the whole table, laid end to end along the curve and cut every ``width`` tokens, so that neighbours share
sequences and only the last sequence is not full.

Null texts count as empty and hold the end id alone. Every row is packed, also rows with equal or null doc_id; equal
vectors have equal keys and are ordered by doc_id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.support import materialise, mix64, partitions, slices
from lexmill.llm.tokens import ids_of, stored_ids

WIDTH = 4096
BUCKETS = 1024
DIMENSIONS = 4
GRID_BITS = 12


def projection(buckets: int = BUCKETS, dimensions: int = DIMENSIONS, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((buckets, dimensions))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid cells, all numbers of ``bits`` bits.

    From the highest bit down, a set bit in a dimension inverts the lower bits of the first dimension and a clear one
    exchanges them with those of the first, which undoes the curve's turns; the Gray code of what is left is the place.
    """
    x = [c.astype(np.int64) for c in cells.T]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(len(x)):
            turned = (x[i] >> b & 1).astype(bool)
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    fix = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        fix = np.where(x[-1] >> b & 1, fix ^ ((1 << b) - 1), fix)
    x = [v ^ fix for v in x]
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = key << 1 | (v >> b & 1)
    return key


def _keys(ids: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """Curve key of each document; ``table`` projects hashed ids."""
    spots = np.empty((len(ids), table.shape[1]))
    for k, own in enumerate(ids):
        hashed = mix64(own.astype(np.uint64) + np.uint64(1))
        counts = np.bincount((hashed >> np.uint64(32)).astype(np.int64) % len(table), minlength=len(table))
        spots[k] = counts @ table / np.sqrt((counts * counts).sum())
    cells = ((np.tanh(spots / 2) + 1) / 2 * ((1 << GRID_BITS) - 1)).astype(np.int64)
    return hilbert_keys(cells, GRID_BITS)


def _laid_out(keyed: DataFrame) -> DataFrame:
    """(row, place): tokens before each document along the curve."""
    spark = keyed.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.column(1).to_numpy()
            ends = np.cumsum(n) + at
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.full(len(n), part), pa.int64()), pa.array(ends - n, pa.int64()), b.column(1)],
                ["row", "part", "local", "n_tokens"],
            )
            at = int(ends[-1]) if len(n) else at

    order = ["key", "doc_id", "row"]
    ordered = keyed.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    placed = materialise(
        ordered.select("row", "n_tokens").mapInArrow(run, "row bigint, part bigint, local bigint, n_tokens bigint"), "curve"
    )
    sizes = placed.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per part
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    return placed.join(F.broadcast(starts), "part").select("row", (F.col("start") + F.col("local")).alias("place"))


def pack(
    docs: DataFrame, width: int = WIDTH, end_id: int = 2, vocabulary: str | None = None, with_ids: bool = False, **columns: str
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids if asked for."""
    table = projection()
    stored, _ = stored_ids(docs, end_id, vocabulary, key=lambda ids: _keys(ids, table), **columns)
    laid_out = _laid_out(stored.select("row", "doc_id", "n_tokens", "key"))
    placed = stored.select("row", "doc_id", "n_tokens", "ids").join(laid_out, "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out: list[list] = [[] for _ in range(8)]
            for name, n, stored_bytes, place in zip(*(b.column(k).to_pylist() for k in range(4))):
                ids = ids_of(stored_bytes, n).astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(place + start, width)
                    length = min(n - start, width - offset)
                    piece = ids[start : start + length].tobytes()
                    values = (name, start, length, zlib.crc32(piece), n, sequence, offset, piece if with_ids else None)
                    for column, v in zip(out, values):
                        column.append(v)
                    start += length
            arrays = [pa.array(c, pa.int64()) for c in out[:7]] + [pa.array(out[7], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays[: 7 + with_ids], names[: 7 + with_ids])

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    types = ["bigint"] * 7 + ["binary"]
    schema = ", ".join(f"{n} {t}" for n, t in list(zip(names, types))[: 7 + with_ids])
    return placed.select("doc_id", "n_tokens", "ids", "place").mapInArrow(run, schema)
