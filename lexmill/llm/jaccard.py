"""Similarity join of documents on word shingles, with Bayesian pruning.

Words are runs of letters and digits, lower-cased; a shingle is five words in a row, or all words of a shorter text. Two
documents are linked when the Jaccard similarity of their shingle sets is at least the threshold.

1.  Documents with equal shingle sets are one class of copies; only one of each goes on.
2.  MinHash values in bands give candidates: 32 bands of 6 miss a pair at 0.8 with probability 6e-5, less above.
3.  Documents connected through shared bands meet in one task; large components are split into blocks, and every two blocks
    meet in a task, so no task holds more than two blocks.
4.  There the MinHash values are compared a few at a time. After each step a pair is dropped when the posterior probability that
    its similarity reaches the threshold is below ``TOLERANCE``; what is left is verified with the exact sets.
5.  Links are counted and joined to classes inside the task: no row per pair leaves it.

Null and empty texts and texts without a word have no shingles: each is a class of its own without links. Rows that repeat
a doc_id are documents of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.components import components
from lexmill.llm.support import join_classes, materialise, mix64, partitions, prefix_hash, slices, span_hash, text_marks, texts_of

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6
STEP = 32
TOLERANCE = 1e-6
#: What a block of a large component holds: shingles, and this many more for each document.
BLOCK_WEIGHT, DOCUMENT_WEIGHT = 1 << 19, 256

_HASHES = BANDS * ROWS
_RNG = np.random.default_rng(11)
_A = (_RNG.integers(0, 1 << 31, _HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, _HASHES, dtype=np.uint32)
_FOLD = mix64(np.arange(101, 101 + max(ROWS, WORDS), dtype=np.uint64)) | np.uint64(1)

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the different shingles."""
    data = np.frombuffer(text.lower().encode(), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD_BYTE[data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint64)
    word = span_hash(prefix_hash(data), start, end)
    width = min(words, len(word))
    out = np.zeros(len(word) - width + 1, np.uint64)
    for k in range(width):
        out += word[k : k + len(out)] * _FOLD[k]
    return np.unique(mix64(out + np.uint64(width)))


def minhash(grams: np.ndarray) -> np.ndarray:
    """One 32-bit minimum per hash function."""
    low = np.full(_HASHES, 0xFFFFFFFF, np.uint32)
    short = (grams >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(short), 1024):
        values = np.multiply.outer(_A, short[k : k + 1024])
        values += _B[:, None]
        np.minimum(low, values.min(axis=1), out=low)
    return low


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key per row of MinHash values and band."""
    rows = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    return mix64((rows * _FOLD[:ROWS]).sum(axis=2, dtype=np.uint64) + mix64(np.arange(BANDS, dtype=np.uint64) + np.uint64(1)))


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """Compared values -> fewest matches with which a pair stays.

    With a uniform prior the posterior of the similarity after m matches of n is Beta(m + 1, n - m + 1); its mass above
    the threshold is the chance of at most m successes in n + 1 trials.
    """
    out = {}
    for n in range(STEP, _HASHES + 1, STEP):
        mass, m = 0.0, 0
        while True:
            mass += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if mass >= tolerance:
                break
            m += 1
        out[n] = m
    return out


_SKETCH = "doc_id bigint, t bigint, u bigint, n bigint, d1 bigint, d2 bigint, keys array<bigint>"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        sets = [shingles(text) for text in b.column(3).to_pylist()]
        signatures = np.stack([minhash(s) for s in sets]) if sets else np.zeros((0, _HASHES), np.uint32)
        keys = band_keys(signatures).view(np.int64)
        d1 = np.array([mix64(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
        d2 = np.array([mix64(s ^ _FOLD[0]).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1)))
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:3], pa.array([len(s) for s in sets], pa.int64()), pa.array(d1), pa.array(d2), lists],
            ["doc_id", "t", "u", "n", "d1", "d2", "keys"],
        )


def _payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, 128):
        sets = [shingles(text) for text in b.column(b.num_columns - 1).to_pylist()]
        marks = [minhash(s).astype(np.uint8).tobytes() for s in sets]
        grams = pa.array([s.tobytes() for s in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], grams, pa.array(marks, pa.binary())], _PAYLOAD_NAMES)


_PAYLOAD_NAMES = ["node", "size", "component", "blocks", "block", "grams", "marks"]
_PAYLOAD = "node bigint, size bigint, component bigint, blocks bigint, block bigint, grams binary, marks binary"


class _Block:
    def __init__(self, node: np.ndarray, size: np.ndarray, grams: list[bytes], marks: list[bytes]):
        self.node, self.size = node, size
        self.marks = np.frombuffer(b"".join(marks), np.uint8).reshape(len(node), _HASHES)
        self.grams = np.frombuffer(b"".join(grams), np.uint64)
        self.count = np.fromiter((len(g) // 8 for g in grams), np.int64, len(grams))
        self.begin = np.cumsum(self.count) - self.count


def linked(block: _Block, left: range, right: slice, least: dict[int, int], threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js): for each document of ``left`` the documents of ``right`` after it that are similar enough."""
    _, local = np.unique(block.grams, return_inverse=True)
    seen = np.zeros(int(local.max()) + 1 if len(local) else 0, bool)
    for i in left:
        js = np.arange(max(right.start, i + 1), right.stop)
        share = np.minimum(block.count[js], block.count[i]) >= threshold * np.maximum(block.count[js], block.count[i])
        js = js[share]  # sets of too different size cannot reach the threshold
        matches = np.zeros(len(js), np.int64)
        for n, needed in least.items():
            if not len(js):
                break
            matches += (block.marks[js, n - STEP : n] == block.marks[i, n - STEP : n]).sum(axis=1)
            js, matches = js[matches >= needed], matches[matches >= needed]
        if not len(js):
            continue
        own = slice(block.begin[i], block.begin[i] + block.count[i])
        seen[local[own]] = True
        lengths = block.count[js]
        ends = np.cumsum(lengths)
        place = np.repeat(block.begin[js] - (ends - lengths), lengths) + np.arange(ends[-1])
        common = np.add.reduceat(seen[local[place]].astype(np.int64), ends - lengths)
        seen[local[own]] = False
        js = js[common >= threshold * (block.count[i] + lengths - common)]
        if len(js):
            yield i, js


def _verify(threshold: float):
    least = least_matches(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by (component, first, second, block): one group of two blocks after the other."""

        def close() -> pa.RecordBatch:
            component, first, second = key
            node = np.array([r[0] for r in held], np.int64)
            block = _Block(node, np.array([r[1] for r in held], np.int64), [r[2] for r in held], [r[3] for r in held])
            n = len(held)
            middle = sum(r[4] == first for r in held)
            left, right = (range(n), slice(0, n)) if first == second else (range(middle), slice(middle, n))
            links, label = np.zeros(n, np.int64), np.arange(n)
            for i, js in linked(block, left, right, least, threshold):
                links[i] += block.size[js].sum()
                links[js] += block.size[i]
                joined = np.unique(np.r_[label[i], label[js]])
                if len(joined) > 1:
                    label[np.isin(label, joined)] = joined[0]
            root = node[label] if n else node
            return pa.RecordBatch.from_arrays([pa.array(node), pa.array(links), pa.array(root)], ["node", "links", "root"])

        key: tuple | None = None
        held: list[tuple] = []
        for b in slices(batches, 128):
            for c, x, y, block, node, size, grams, marks in zip(*(col.to_pylist() for col in b.columns)):
                if key != (c, x, y):
                    if held:
                        yield close()
                    key, held = (c, x, y), []
                held.append((node, size, grams, marks, block))
        if held:
            yield close()

    return run


def _candidates(sketch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes of equal sets as d1, d2, n, node, size; components of nodes that share bands)."""
    classes = materialise(
        sketch.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("node").alias("node"), F.count("*").alias("size")), "classes"
    )
    bands = materialise(
        sketch.join(classes.select("node"), "node", "left_semi").select("node", F.explode("keys").alias("key")), "bands"
    )
    shared = materialise(
        bands.groupBy("key").agg(F.min("node").alias("low"), F.count("*").alias("members")).where("members > 1"), "shared"
    )
    return classes, components(join_classes(bands, shared, "key", "members").select(F.col("node").alias("u"), F.col("low").alias("v")))


def similarity_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, t, u, class_id, n_links, class_size, kept) for every row.

    ``class_id`` is the smallest doc_id of the documents connected by links, ``n_links`` the number of other documents this one is
    linked to, copies counted each; ``kept`` marks one document of each class, that with the smallest doc_id; t and u are the text's ``text_marks``.
    """
    spark = docs.sparkSession
    marks = [c.alias(n) for n, c in text_marks(F.col("text")).items()]
    texts = texts_of(docs, id_column, text_column).select("doc_id", *marks, "text")
    sketch = materialise(texts.mapInArrow(_sketch, _SKETCH).withColumn("node", F.monotonically_increasing_id()), "sketch")
    classes, near = _candidates(sketch)

    # where each candidate is compared
    members = materialise(near.join(classes.select("node", "size", "n"), "node"), "members")
    weights = members.groupBy("component").agg(
        F.ceil(F.sum(F.col("n") + DOCUMENT_WEIGHT) / BLOCK_WEIGHT).alias("blocks"), F.count("*").alias("members")
    )
    placed = join_classes(members, materialise(weights, "weights"), "component", "members").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks"))
    )
    placed = placed.join(sketch.select("node", "doc_id", "t", "u"), "node").select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"), "t", "u", "node", "size", "component", "blocks", "block"
    )
    keyed = texts.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"), "t", "u", "text").dropDuplicates(["key", "t", "u"])
    loaded = (
        keyed.join(placed.hint("shuffle_hash"), ["key", "t", "u"])
        .select("node", "size", "component", "blocks", "block", "text")
        .mapInArrow(_payload, _PAYLOAD)
    )
    paired = loaded.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).select(
        "component", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
        "block", "node", "size", "grams", "marks",
    )
    verified = materialise(
        paired.repartition(partitions(spark), "component", "first", "second")
        .sortWithinPartitions("component", "first", "second", "block", "node")
        .mapInArrow(_verify(threshold), "node bigint, links bigint, root bigint"),
        "links",
    )
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(verified.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))

    # classes of copies -> classes of similar documents -> documents
    named = classes.join(links, "node", "left").join(joined, "node", "left").select(
        "d1", "d2", "n", "size", F.coalesce("component", "node").alias("group"),
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
    )
    named = materialise(named.withColumn("digest", F.struct("d1", "d2", "n")).drop("d1", "d2", "n"), "named")
    full = sketch.where("n > 0").select("node", "doc_id", "t", "u", F.struct("d1", "d2", "n").alias("digest"))
    grouped = materialise(join_classes(materialise(full, "rows"), named, "digest", "size").drop("digest", "size"), "grouped")
    groups = grouped.groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "node")).alias("first"), F.count("*").alias("class_size")
    )
    out = join_classes(grouped, materialise(groups, "groups"), "group", "class_size").select(
        "doc_id", "t", "u", F.col("first.doc_id").alias("class_id"), "n_links", "class_size",
        (F.col("node") == F.col("first.node")).alias("kept"),
    )
    alone = sketch.where("n = 0").select(
        "doc_id", "t", "u", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"),
        F.lit(1).cast("bigint").alias("class_size"), F.lit(True).alias("kept"),
    )
    return out.unionByName(alone)
