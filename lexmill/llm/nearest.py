"""Approximate nearest neighbours by largest inner product, with cross-polytope hashing.

Vectors are indexed in ranges of norms, each with buckets of its own, so a long row moves its range only. They are scaled by the largest
norm of their range and get one more component that makes them unit vectors, so in a range the largest inner product is
the smallest angle; queries are scaled to unit length with that component zero. A table of the index turns a vector by a
pseudo-rotation, three rounds of random signs and a fast Hadamard transform, and files it under the signed axis it is nearest to. A
query looks, in each table and range, into the buckets of its ``probes`` nearest signed axes. What it finds there is ranked by exact
inner products of the original vectors in double precision. A query that met fewer than ``k`` candidates is compared with all rows, block by
block; so are all queries where there are at most ``FEW`` times ``k`` candidates, of which the k best need not be near.

A bucket is dealt into blocks of bounded size, each compared with its queries in one task, so copies of one vector in a third
of all rows fill many blocks. Each block sends on the best of each query only.

Vectors that are null, zero, of another length than most rows of the table, or with null or non-finite components, and rows without id, take no
part. Rows that share the query's id are its own; a candidate whose id is repeated counts once, with its largest score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.support import materialise, partitions

TABLES, PROBES, NEIGHBOURS = 10, 32, 20
#: Most candidates of a block and most queries compared with it at a time.
BLOCK, QUERY_BLOCK = 4096, 512
FEW = 8
#: Ranges of norms for each factor of two, and how many at most: the last one takes all shorter vectors.
_RANGES, _MOST_RANGES = 2, 24
_ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Hadamard transform of each row; the row length is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        pairs = x.reshape(n, -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def norms_of(x: np.ndarray) -> np.ndarray:
    """The norm of each row; squares of large components do not overflow."""
    largest = np.abs(x).max(axis=1, initial=0)
    scale = np.where(largest > 0, largest, 1.0)
    return scale * np.linalg.norm(x / scale[:, None], axis=1)


class CrossPolytope:
    def __init__(self, length: int, largest_norm: float, tables: int = TABLES, seed: int = 5, norms: list[float] | None = None):
        self.length, self.tables = length, tables
        self.norms = np.array(sorted(norms or [largest_norm]))  # the largest of each range
        self.width = 1 << length.bit_length()  # room for one more component
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, _ROUNDS, self.width))

    def _unit(self, x: np.ndarray, is_query: bool) -> np.ndarray:
        out = np.zeros((len(x), self.width))
        norm = norms_of(x)[:, None]
        largest = self.norms[self._ranges(x)][:, None]
        out[:, : self.length] = x / (norm if is_query else largest)
        if not is_query:
            out[:, self.length] = np.sqrt(np.maximum(0, 1 - (norm[:, 0] / largest[:, 0]) ** 2))
        return out

    def _ranges(self, x: np.ndarray) -> np.ndarray:
        """The range of each vector; norms may differ in the last digits from those that were collected."""
        at = np.searchsorted(self.norms, norms_of(x) * (1 - 1e-12))
        return np.minimum(at, len(self.norms) - 1)

    def _turned(self, unit: np.ndarray, table: int) -> np.ndarray:
        """Nearness to each signed axis: the positive ones, then the negative ones."""
        for signs in self.signs[table]:
            unit = hadamard(unit * signs)
        return np.concatenate([unit, -unit], axis=1)

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """Bucket of each vector in each table."""
        unit, axes = self._unit(x, False), 2 * self.width
        first = self._ranges(x) * self.tables * axes
        return np.stack([self._turned(unit, t).argmax(axis=1) + t * axes + first for t in range(self.tables)], axis=1)

    def probes(self, x: np.ndarray, probes: int) -> np.ndarray:
        """The buckets a query looks into."""
        unit, axes = self._unit(x, True), 2 * self.width
        probes = min(probes, axes)
        near = [np.argpartition(-self._turned(unit, t), probes - 1, axis=1)[:, :probes] + t * axes for t in range(self.tables)]
        own = np.concatenate(near, axis=1)
        return np.concatenate([own + r * self.tables * axes for r in range(len(self.norms))], axis=1)


def _norm() -> Column:
    v = F.col("vector")
    largest = F.array_max(F.transform(v, lambda x: F.abs(x)))
    return largest * F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + (x / largest) * (x / largest)))


def _norms(usable: DataFrame, largest: float) -> list[float]:
    """The largest norm of each range that has vectors."""
    if not 0 < largest < float("inf"):
        return [largest]
    below = F.floor(_RANGES * F.log2(F.lit(largest) / F.greatest(_norm(), F.lit(largest * 2.0**-_MOST_RANGES))))
    ranges = usable.groupBy(F.least(below, F.lit(_MOST_RANGES - 1)).alias("range")).agg(F.max(_norm()).alias("norm"))
    return [r["norm"] for r in ranges.collect() if r["norm"] > 0] or [largest]


def _finite(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector as doubles) of the rows that take part, whatever the vector's length."""
    v = F.col("vector")
    return vectors.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast("array<double>").alias("vector")
    ).where(
        F.col("id").isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(v, lambda x: x != 0)
    )


def _usable(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int, float]:
    """(id, vector as doubles), the common length and the largest norm."""
    v, rows = F.col("vector"), _finite(vectors, id_column, vector_column)
    lengths = rows.groupBy(F.size(v).alias("length")).agg(F.count("*").alias("n"), F.max(_norm()).alias("norm"))
    common = lengths.orderBy(F.desc("n"), "length").first()
    if common is None:
        return rows, 0, 1.0
    return rows.where(F.size(v) == common["length"]), common["length"], common["norm"]


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _filed(index: CrossPolytope, probes: int | None):
    """Rows (bucket, id, vector bytes): one per table for candidates, one per probe for queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for k in range(0, big.num_rows, 1024):
                b = big.slice(k, 1024)
                x = _matrix(b.column(1), index.length)
                buckets = index.buckets(x) if probes is None else index.probes(x, probes)
                owner = np.repeat(np.arange(len(x)), buckets.shape[1])
                body = pa.array([row.tobytes() for row in x], pa.binary()).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets.reshape(-1)), b.column(0).take(pa.array(owner)), body], ["bucket", "id", "vector"]
                )

    return run


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, vector bytes)."""
    for b in batches:
        body = [np.array(v, np.float64).tobytes() for v in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(body, pa.binary())], ["id", "vector"])


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest scores of different ids, ties to the smaller id."""
    order = np.lexsort((ids, -scores))
    _, first = np.unique(ids[order], return_index=True)
    order = order[np.sort(first)][:k]
    return ids[order], scores[order]


def _compare(length: int, k: int):
    """Rows sorted by (bucket, block, is_query): candidates of a block, then its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        ids: list[int] = []
        bodies: list[bytes] = []
        names: list[int] = []
        asked: list[bytes] = []
        candidates: tuple[np.ndarray, np.ndarray] | None = None

        def answer() -> pa.RecordBatch:
            nonlocal candidates
            if candidates is None:
                candidates = np.array(ids, np.int64), np.frombuffer(b"".join(bodies)).reshape(-1, length)
            own, x = candidates
            most = k + 1 + len(own) - len(np.unique(own))  # its own row, and rows with repeated ids
            q = np.frombuffer(b"".join(asked)).reshape(-1, length)
            rough = q @ x.T
            found = []
            for row, name in enumerate(names):
                near = rough[row]
                if len(near) > most:
                    # products of a matrix may differ in the last digits: keep all that could be among the best
                    bar = np.partition(near, len(near) - most)[len(near) - most]
                    at = np.flatnonzero(near >= bar - 1e-9 * max(1.0, abs(bar)))
                else:
                    at = np.arange(len(near))
                at = at[own[at] != name]
                found.append(best((x[at] * q[row]).sum(axis=1), own[at], k))
            arrays = [
                pa.array(names, pa.int64()),
                pa.array([i.tobytes() for i, _ in found], pa.binary()),
                pa.array([s.tobytes() for _, s in found], pa.binary()),
            ]
            names.clear(), asked.clear()
            return pa.RecordBatch.from_arrays(arrays, ["query_id", "ids", "scores"])

        for b in batches:
            for bucket, block, is_query, name, vector in zip(*(c.to_pylist() for c in b.columns)):
                if key != (bucket, block):
                    if names and ids:
                        yield answer()
                    key, candidates = (bucket, block), None
                    ids.clear(), bodies.clear(), names.clear(), asked.clear()
                if is_query:
                    names.append(name)
                    asked.append(vector)
                    if len(names) == QUERY_BLOCK:
                        if ids:
                            yield answer()
                        names.clear(), asked.clear()
                else:
                    ids.append(name)
                    bodies.append(vector)
        if names and ids:
            yield answer()

    return run


def _merge(k: int):
    """Rows sorted by query: the best of all its lists, held at most twice k entries at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], [], []]
        current: int | None = None
        ids, scores = np.zeros(0, np.int64), np.zeros(0)

        def close() -> None:
            if current is not None:
                for column, values in zip(out, ([current] * len(ids), range(1, len(ids) + 1), ids.tolist(), scores.tolist())):
                    column.extend(values)

        for b in batches:
            for name, i, s in zip(*(c.to_pylist() for c in b.columns)):
                if name != current:
                    close()
                    current, ids, scores = name, np.zeros(0, np.int64), np.zeros(0)
                ids, scores = best(
                    np.concatenate([scores, np.frombuffer(s)]), np.concatenate([ids, np.frombuffer(i, np.int64)]), k
                )
        close()
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["query_id", "rank", "vec_id", "score"])

    return run


_RESULT = "query_id bigint, rank int, vec_id bigint, score double"


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = NEIGHBOURS,
    tables: int = TABLES,
    probes: int = PROBES,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best found for each query, from all rows of ``vectors`` but the query's own."""
    spark = vectors.sparkSession
    usable, length, largest = _usable(vectors, id_column, vector_column)
    if not length:
        return spark.createDataFrame([], _RESULT)
    asked = _finite(queries, id_column, vector_column).where(F.size("vector") == length)
    if usable.select("id").distinct().limit(FEW * k + 1).count() <= FEW * k:
        return _from_all(usable, asked, length, k)
    index = CrossPolytope(length, largest, tables, norms=_norms(usable, largest))
    filed = "bucket bigint, id bigint, vector binary"
    candidates = materialise(usable.mapInArrow(_filed(index, None), filed), "filed")
    sizes = candidates.groupBy("bucket").agg(F.count("*").alias("n"))  # one row per axis of each table
    blocks = F.broadcast(sizes.select("bucket", F.ceil(F.col("n") / BLOCK).alias("blocks")))
    dealt = candidates.join(blocks, "bucket").select(
        "bucket", F.pmod(F.xxhash64("id", "vector"), F.col("blocks")).alias("block"), F.lit(False).alias("is_query"), "id", "vector"
    )
    probing = (
        asked.mapInArrow(_filed(index, probes), filed)
        .join(blocks, "bucket")
        .select(
            "bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"),
            F.lit(True).alias("is_query"), "id", "vector",
        )
    )
    found = materialise(_ranked(dealt.unionByName(probing), length, k), "found")
    whole = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = materialise(asked.join(whole, "id", "left_anti"), "short")
    if short.isEmpty():
        return found
    enough = found.join(whole, F.col("query_id") == F.col("id"), "left_semi")
    return enough.unionByName(_from_all(usable, short, length, k))


def _ranked(rows: DataFrame, length: int, k: int) -> DataFrame:
    """The result from candidates and queries (bucket, block, is_query, id, vector bytes)."""
    parts = partitions(rows.sparkSession)
    lists = (
        rows.repartition(parts, "bucket", "block")
        .sortWithinPartitions("bucket", "block", "is_query")
        .mapInArrow(_compare(length, k), "query_id bigint, ids binary, scores binary")
    )
    return lists.repartition(parts, "query_id").sortWithinPartitions("query_id").mapInArrow(_merge(k), _RESULT)


def _from_all(usable: DataFrame, asked: DataFrame, length: int, k: int) -> DataFrame:
    """The exact result: every query is compared with every block of rows."""
    blocks = max(1, -(-usable.count() // BLOCK))
    schema, bucket = "id bigint, vector binary", F.lit(0).cast("bigint").alias("bucket")
    dealt = usable.mapInArrow(_bytes, schema).select(
        bucket, F.pmod(F.xxhash64("id", "vector"), F.lit(blocks).cast("bigint")).alias("block"), F.lit(False).alias("is_query"), "id", "vector"
    )
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block")
    probing = asked.mapInArrow(_bytes, schema).select(bucket, every, F.lit(True).alias("is_query"), "id", "vector")
    return _ranked(dealt.unionByName(probing), length, k)
