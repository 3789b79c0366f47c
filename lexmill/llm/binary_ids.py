"""Token ids in a compact file format, and back.

The format. Ids are replaced by their rank in the whole corpus, the commonest first, so most fit one byte. A
block holds whole documents in ascending doc_id order: ``n_docs`` ids of documents (``doc_ids``, 64 bit) and
numbers of tokens (``lengths``, 64 bit), one control byte per four tokens (two bits each, lowest first: how many bytes
the rank has, less one), and the ranks' bytes one after the other, lowest byte first. Control and data bytes are
apart, so a reader finds all positions by table lookup and running sums, without branching. ``part`` and ``block``
give the order of blocks, ``before`` the tokens before the block in its part. Blocks are rows of Parquet files; the
ranks' ids are a table beside them (``ids``), the tokens before each part another (``parts``).

Null texts count as empty and hold the end id alone. Rows with equal doc_id stay, ordered by their ids; null doc_ids come first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.llm.support import materialise, partitions
from lexmill.llm.tokens import binaries, ids_of, stored_ids
from lexmill.sources.workspace import new_path

BLOCK_TOKENS = 1 << 16
# Decoding tables: for each control byte the bytes of its four ranks.
_WIDTHS = (np.arange(256)[:, None] >> np.arange(0, 8, 2) & 3).astype(np.int64) + 1


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of 32-bit numbers."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = extra
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    used = np.arange(4) <= extra[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The numbers again: widths by lookup, places by a running sum, bytes gathered by column."""
    width = _WIDTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    place = np.cumsum(width) - width
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = np.zeros(n, np.uint32)
    for k in range(4):
        has = width > k
        if not has.any():
            break
        out |= np.where(has, padded[place + k], 0).astype(np.uint32) << np.uint32(8 * k)
    return out


def rank_table(counted: DataFrame) -> DataFrame:
    """(rank, id, n) of every id that occurs, by falling count, from counts (id, n). Its rows are bounded by the vocabulary."""
    counts = counted.groupBy("id").agg(F.sum("n").alias("n"))
    return counts.select((F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1).cast("bigint").alias("rank"), "id", "n")


def write(docs: DataFrame, path: str, end_id: int = 2, vocabulary: str | None = None, **columns: str) -> None:
    """Encode every text, append the end id and write the files of the format under ``path``."""
    spark = docs.sparkSession
    stored, counted = stored_ids(docs, end_id, vocabulary, **columns)
    ranks = materialise(rank_table(counted), "ranks", f"{path}/ids")
    rank_of = np.zeros((ranks.agg(F.max("id")).first()[0] or 0) + 1, np.uint32)  # one entry per token id
    for r in ranks.select("id", "rank").toLocalIterator():
        rank_of[r["id"]] = r["rank"]
    shared = spark.sparkContext.broadcast(rank_of)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked = shared.value
        part, block, before = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        held: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal block, before, names, held
            control, data = pack(ranked[np.concatenate(held)])
            lengths = np.array([len(h) for h in held], "<i8")
            ids = np.array([-1 if n is None else n for n in names], "<i8")
            none = sum(n is None for n in names)  # they come first
            columns = [[part], [block], [before], [len(held)], [none], [int(lengths.sum())]]
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns]
                + [binaries([x]) for x in (ids.tobytes(), lengths.tobytes(), control, data)],
                ["part", "block", "before", "n_docs", "n_unnamed", "n_tokens", "doc_ids", "lengths", "control", "data"],
            )
            block, before, names, held = block + 1, before + int(lengths.sum()), [], []
            return out

        size = 0
        for b in batches:
            for name, n, ids in zip(*(b.column(k).to_pylist() for k in range(3))):
                names.append(name)
                held.append(ids_of(ids, n))
                size += n
                if size >= BLOCK_TOKENS:
                    yield close()
                    size = 0
        if held:
            yield close()

    ordered = (
        stored.select("doc_id", "n_tokens", "ids")
        .repartitionByRange(partitions(spark), F.col("doc_id"))
        .sortWithinPartitions("doc_id", "ids")
    )
    schema = (
        "part bigint, block bigint, before bigint, n_docs bigint, n_unnamed bigint, n_tokens bigint, "
        "doc_ids binary, lengths binary, control binary, data binary"
    )
    written = materialise(ordered.mapInArrow(blocks, schema), "blocks", f"{path}/blocks")
    sizes = written.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per part
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    materialise(sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")), "parts", f"{path}/parts")


def _decoded(spark: SparkSession, path: str, schema: str, fields) -> DataFrame:
    """Rows made by ``fields(doc_id, start, ids)`` for each document of the files."""
    ranks = spark.read.parquet(f"{path}/ids")
    id_of = np.array([r["id"] for r in ranks.orderBy("rank").select("id").toLocalIterator()], np.uint32)
    shared = spark.sparkContext.broadcast(id_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema_names
        for b in batches:
            for row in b.to_pylist():
                ids = shared.value[unpack(row["control"], row["data"], row["n_tokens"])]
                lengths = np.frombuffer(row["lengths"], "<i8")
                begin = np.cumsum(lengths) - lengths
                first = row["start"] + row["before"]
                rows = [
                    fields(None if k < row["n_unnamed"] else int(d), int(first + a), ids[a : a + n])
                    for k, (d, a, n) in enumerate(zip(np.frombuffer(row["doc_ids"], "<i8"), begin.tolist(), lengths.tolist()))
                ]
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    schema_names = arrow.names
    # one row per part of the sorted table, so few that they can go to every task
    placed = spark.read.parquet(f"{path}/blocks").join(F.broadcast(spark.read.parquet(f"{path}/parts")), "part")
    return placed.mapInArrow(run, schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of the documents in the files under ``path``."""
    return _decoded(spark, path, "doc_id bigint, start bigint, ids array<bigint>", lambda d, a, ids: (d, a, ids.tolist()))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents in the files under ``path``."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return _decoded(spark, path, schema, lambda d, a, ids: (d, a, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))


def scratch_folder(spark: SparkSession) -> str:
    return new_path(spark, "binary-ids")
