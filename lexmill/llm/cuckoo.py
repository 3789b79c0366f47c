"""Exact duplicates through cuckoo-filter indexes of digests.

Texts are equal when identical after lower-casing A-Z only; null counts as empty. Every task keeps an index of the digests it
has met: a cuckoo filter says "not seen" without a look at the keys, and a hit is verified against the keys stored bucket by
bucket. Of equal texts one digest is live, that of the largest doc_id: a larger one deletes the entry and puts its own. Tasks
first index their own documents, so a text in a third of all rows leaves a task as one row; then the digests meet by their
own hash and are indexed again.

A null doc_id is smaller than any. Rows that repeat the doc_id that stays are all marked as kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.support import join_classes, materialise, partitions, slices, text_marks, texts_of

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_NO_ID = np.iinfo(np.int64).min


class CuckooIndex:
    """Filter of 16-bit fingerprints in buckets of four, with the keys and values beside them.

    A key has two buckets; the second is found from the first and the fingerprint alone. Insertion moves entries
    between their buckets; when that takes ``kicks`` moves or the table is nearly full it is built anew, twice as
    large, from the stored keys.
    """

    SLOTS = 4

    def __init__(self, buckets: int = 1024, kicks: int = 200):
        self.kicks, self.size = kicks, 0
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints: list[list[int]] = [[] for _ in range(buckets)]
        self.content: list[list[tuple]] = [[] for _ in range(buckets)]

    def _spots(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[:2], "little") or 1
        first = int.from_bytes(key[2:10], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ mark * 0x5BD1E995) & self.mask

    def find(self, key: bytes):
        """The value of ``key`` or None."""
        mark, a, b = self._spots(key)
        for bucket in (a, b):
            if mark in self.prints[bucket]:
                for known, value in self.content[bucket]:
                    if known == key:
                        return value
        return None

    def delete(self, key: bytes) -> bool:
        mark, a, b = self._spots(key)
        for bucket in (a, b):
            if mark in self.prints[bucket]:
                for k, (known, _) in enumerate(self.content[bucket]):
                    if known == key:
                        del self.prints[bucket][k], self.content[bucket][k]
                        self.size -= 1
                        return True
        return False

    def insert(self, key: bytes, value) -> None:
        """Add a key that is not in the index."""
        if self.size > 0.9 * self.SLOTS * (self.mask + 1):
            self._grow()
        mark, a, b = self._spots(key)
        entry = (key, value)
        bucket = a if len(self.prints[a]) <= len(self.prints[b]) else b
        for turn in range(self.kicks):
            if len(self.prints[bucket]) < self.SLOTS:
                self.prints[bucket].append(mark)
                self.content[bucket].append(entry)
                self.size += 1
                return
            k = turn % self.SLOTS
            mark, self.prints[bucket][k] = self.prints[bucket][k], mark
            entry, self.content[bucket][k] = self.content[bucket][k], entry
            bucket = self._other(bucket, mark)
        self._grow()
        self.insert(*entry)

    def _grow(self) -> None:
        entries = list(self)
        self.size = 0
        self._empty(2 * (self.mask + 1))
        for key, value in entries:
            self.insert(key, value)

    def __iter__(self) -> Iterator[tuple]:
        for bucket in self.content:
            yield from bucket


def normalised_digest(text: str) -> bytes:
    return hashlib.sha256(text.encode().translate(_LOWER)).digest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        found = [normalised_digest(t) for t in b.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(found, pa.binary())], ["doc_id", "t", "u", "digest"])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, keep_id, n) of each different digest of the task, from rows (digest, doc_id, n)."""
    index = CuckooIndex()
    for b in batches:
        ids = b.column(1).fill_null(_NO_ID).to_pylist()
        for key, name, n in zip(b.column(0).to_pylist(), ids, b.column(2).to_pylist()):
            live = index.find(key)
            if live is not None:
                index.delete(key)
                name, n = max(live[0], name), live[1] + n
            index.insert(key, (name, n))
    rows = list(index)
    for k in range(0, len(rows), 50_000):
        part = rows[k : k + 50_000]
        ids = [None if v[0] == _NO_ID else v[0] for _, v in part]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in part], pa.binary()), pa.array(ids, pa.int64()), pa.array([v[1] for _, v in part], pa.int64())],
            ["digest", "keep_id", "n"],
        )


_INDEXED = "digest binary, keep_id bigint, n bigint"


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, t, u, keep_id, group_size, kept, text_sha256) for every row; t and u are the text's ``text_marks``."""
    marks = [c.alias(n) for n, c in text_marks(F.col("text")).items()]
    texts = texts_of(docs, id_column, text_column).select("doc_id", *marks, "text")
    rows = materialise(texts.mapInArrow(_digests, "doc_id bigint, t bigint, u bigint, digest binary"), "digests")
    local = rows.select("digest", "doc_id", F.lit(1).cast("bigint").alias("n")).mapInArrow(_index, _INDEXED)
    classes = materialise(local.repartition(partitions(docs.sparkSession), "digest").mapInArrow(_index, _INDEXED), "classes")
    joined = join_classes(rows, classes, "digest", "n")
    return joined.select(
        "doc_id",
        "t",
        "u",
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
