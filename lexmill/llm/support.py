"""Helpers shared by the corpus operators: selection of columns, byte hashing, stored tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.sources.workspace import materialise

# Odd multiplier of the polynomial byte hash, its inverse modulo 2^64, and the finaliser's constants.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)

_POWERS: dict[str, np.ndarray] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text) alone, null texts as empty: other columns, whatever their names, play no part."""
    return docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )


def text_marks(text: Column) -> dict[str, Column]:
    """Columns t and u: 128 bits of the SHA-256 of a text. With doc_id they tell rows of different content apart."""
    digest = F.sha2(text, 256)
    return {n: F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint") for n, at in (("t", 1), ("u", 17))}


def held_out(doc_id: Column) -> Column:
    """Documents no model learns from: a fifth, by checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that what a task makes of one in Python stays small."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def byte_slices(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``size`` bytes in its text ``column``, or one longer text."""
    for b in batches:
        ends = np.cumsum(pa.compute.binary_length(b.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        k = 0
        while k < b.num_rows:
            so_far = ends[k - 1] if k else 0
            to = max(int(np.searchsorted(ends, so_far + size, side="right")), k + 1)
            yield b.slice(k, to - k)
            k = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in one array, and where each value begins (with the end)."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


_ZSTD: dict[str, object] = {}


def pack(data: bytes) -> bytes:
    """Compressed bytes, for what is shuffled or stored in between."""
    if "out" not in _ZSTD:
        _ZSTD["out"] = zstandard.ZstdCompressor(level=1)
    return _ZSTD["out"].compress(data)


def unpack(data: bytes) -> bytes:
    if "in" not in _ZSTD:
        _ZSTD["in"] = zstandard.ZstdDecompressor()
    return _ZSTD["in"].decompress(data)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def _powers(n: int, name: str, base: int) -> np.ndarray:
    known = _POWERS.get(name)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _POWERS[name] = np.multiply.accumulate(steps)
        if n > 1 << 22:
            del _POWERS[name]
    return known[:n]


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums S with which ``span_hash`` gets the hash of any stretch of ``data`` in constant time."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * _powers(len(data), "up", _BASE), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end], the same wherever the bytes lie."""
    return mix64((sums[end] - sums[start]) * _powers(len(sums), "down", _INVERSE)[start])


# Fixed share: a class with at least this share of all rows is joined by broadcast; there are at most as many as its inverse.
_HOT_SHARE = 1 / 1024


def join_classes(rows: DataFrame, classes: DataFrame, key: str, size: str) -> DataFrame:
    """Every row with its class. ``size`` is the number of rows of a class; both tables are stored, keys of rows not null.

    Classes that hold a large share of the rows, at most 1 024, go to every task; the others are joined by key.
    """
    total = rows.count()
    is_hot = F.col(size) >= max(2.0, total * _HOT_SHARE)
    hot = F.broadcast(classes.where(is_hot))
    common = rows.join(hot, key)
    rare = rows.join(F.broadcast(classes.where(is_hot).select(key)), key, "left_anti").join(classes.where(~is_hot), key)
    return common.unionByName(rare)
