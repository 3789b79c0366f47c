"""Fingerprints of documents whose distance follows the likeness of the texts, and the search for near ones.

A fingerprint has ``BITS`` bits. The terms of a text are its words (runs of letters and digits, lower-cased) and its shingles of ``WORDS`` words in a
row; a text of fewer words has all its words as one shingle. A term that occurs n times weighs the number of binary digits of n, a shingle
``SHINGLE_WEIGHT`` times that. The hash of each term votes with its weight on every bit, for or against; a bit is set if the votes for it
outweigh. Equal texts have equal fingerprints; null and empty texts, and texts without a word, have no term and no bit set.

Two fingerprints that differ in h bits stand for texts whose weighted terms meet at an angle of about pi * h / BITS; the cosine of that, 0 at
least, is their likeness.

``within_radius`` finds all fingerprints within a Hamming radius r: the bits are cut into blocks, more than r of them; two
fingerprints that differ in r bits agree in all bits of some ``blocks - r`` of them. One table for each choice of so many blocks has a hash of those
blocks as the key; equal keys are candidates, verified on all bits. Of the tables a pair meets in, the first reports it.

``edited_prints`` compares each document with its text after a test edit, which takes the beginning of the next document, by
descending doc_id. Documents without id come last, those of equal id are ordered by the SHA-256 of their texts. The ids alone are sorted into ranges first; then
the texts are dealt by these ranges once, each range with a copy of the first row of the next one. Rows equal in id and text travel once per task, with their number.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.support import byte_slices, materialise, mix64, pack, partitions, prefix_hash, span_hash, texts_of, unpack

WORDS = 5
BITS = 128
SHINGLE_WEIGHT = 1
RADIUS, BLOCKS = 3, 4

_SLICE = 1 << 21  # bytes of text looked at together
_FOLD = mix64(np.arange(301, 301 + WORDS, dtype=np.uint64)) | np.uint64(1)
_SECOND = np.uint64(0xD6E8FEB86659FD93)  # fixed odd number: makes the second half of a term's 128 bits
_SIGNS = np.where(np.arange(256)[:, None] >> np.arange(8) & 1, 1.0, -1.0)
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words begin (with the end)."""
    parts = [t.lower().encode() for t in texts]
    data = np.frombuffer(b"\n".join(parts), np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts])
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD_BYTE[data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return span_hash(prefix_hash(data), start, end), np.r_[0, np.searchsorted(start, ends)]


def _terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, weight, number of the text) of the different terms of each text."""
    word, cuts = _words(texts)
    sizes = np.diff(cuts)
    of = np.repeat(np.arange(len(texts)), sizes)
    width = np.minimum(sizes, WORDS)
    first = np.flatnonzero(np.arange(len(word)) + width[of] <= cuts[1:][of])
    shingle = np.zeros(len(first), np.uint64)
    for k in range(WORDS):
        has = width[of[first]] > k
        shingle += np.where(has, word[np.minimum(first + k, len(word) - 1)] * _FOLD[k], 0).astype(np.uint64)
    shingle = mix64(shingle + width[of[first]].astype(np.uint64))
    out = []
    for hashes, owner, weight in ((mix64(word), of, 1), (shingle, of[first], SHINGLE_WEIGHT)):
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])][: len(hashes)])
        count = np.diff(np.r_[new, len(hashes)])
        out.append((hashes[new], np.frexp(count.astype(np.float64))[1] * float(weight), owner[new]))
    return tuple(np.concatenate(x) for x in zip(*out))


def fingerprints(texts: list[str]) -> np.ndarray:
    """A row of ``BITS`` / 8 bytes for each text."""
    hashes, weight, owner = _terms(texts) if texts else (np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64))
    out = np.zeros((len(texts), BITS // 8), np.uint8)
    base = owner * 256
    for half in range(BITS // 64):
        column = (hashes if half == 0 else mix64(hashes * _SECOND + np.uint64(half))).view(np.uint8).reshape(-1, 8)
        for k in range(8):
            counts = np.bincount(base + column[:, k], weight, 256 * len(texts)).reshape(-1, 256)
            out[:, half * 8 + k] = np.packbits(counts @ _SIGNS > 0, axis=1, bitorder="little")[:, 0]
    return out


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which rows of bytes differ."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def likeness(bits: np.ndarray) -> np.ndarray:
    """Cosine of the angle that so many different bits stand for, 0 at least."""
    return np.where(bits == 0, 1.0, np.maximum(0.0, np.cos(np.pi * bits / BITS)))


def prints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row, the fingerprint in hexadecimal digits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, 1, _SLICE):
            found = [f.tobytes().hex() for f in fingerprints(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    return texts_of(docs, id_column, text_column).mapInArrow(run, "doc_id bigint, fingerprint string")


def _masks(radius: int, blocks: int) -> list[list[int]]:
    """A table for each choice of ``blocks - radius`` blocks: the bits of these blocks, as signed 64-bit numbers."""
    if not radius < blocks <= BITS:
        raise ValueError("there must be more blocks than bits may differ")
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    wholes = [sum((1 << edges[k + 1]) - (1 << edges[k]) for k in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    return [np.frombuffer(w.to_bytes(BITS // 8, "little"), "<i8").tolist() for w in wholes]


_HALVES = range(BITS // 64)


def _halves(fingerprint: str) -> list[Column]:
    """The fingerprint as signed 64-bit numbers."""
    return [F.conv(F.substring(fingerprint, 1 + 16 * k, 16), 16, -10).cast("bigint") for k in _HALVES]


def _digits(name: str) -> Column:
    """The fingerprint whose halves are the columns ``name``_0, ``name``_1."""
    return F.lower(F.concat(*[F.lpad(F.hex(f"{name}_{k}"), 16, "0") for k in _HALVES]))


def within_radius(table: DataFrame, wanted: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(fingerprint, other, bits): each fingerprint of ``wanted`` with all those of ``table`` that differ from it in at most ``radius`` bits.

    Both have a column ``fingerprint`` of lower-case hexadecimal digits; equal ones count once, which rows hold them is for the caller to
    join. A fingerprint of both tables is found itself, with 0 bits.

    An entry of a table is four numbers, the key a hash of its blocks: whether Spark exchanges the entries or broadcasts those of
    ``wanted`` hardly matters for the bytes that are moved.
    """
    masks = _masks(radius, blocks)

    def entries(df: DataFrame, name: str) -> DataFrame:
        once = df.select("fingerprint").where(F.col("fingerprint").isNotNull()).distinct()
        halves = once.select(*[half.alias(f"{name}_{k}") for k, half in enumerate(_halves("fingerprint"))])
        chosen = [[F.col(f"{name}_{k}").bitwiseAND(F.lit(bits)) for k, bits in enumerate(mask)] for mask in masks]
        return halves.select("*", F.posexplode(F.array(*[F.xxhash64(*c) for c in chosen])).alias("table", "key"))

    met = entries(wanted, "fingerprint").join(entries(table, "other"), ["table", "key"])
    differ = [F.col(f"fingerprint_{k}").bitwiseXOR(F.col(f"other_{k}")) for k in _HALVES]
    # the first table whose blocks are equal, not only their hashes
    agree = [reduce(Column.__and__, [d.bitwiseAND(F.lit(bits)) == 0 for d, bits in zip(differ, mask)]) for mask in masks]
    first = F.coalesce(*[F.when(a, F.lit(t)) for t, a in enumerate(agree)])
    near = met.where(first == F.col("table")).withColumn("bits", sum((F.bit_count(d) for d in differ), F.lit(0)).cast("bigint"))
    return near.where(F.col("bits") <= radius).select(_digits("fingerprint").alias("fingerprint"), _digits("other").alias("other"), "bits")


# The test edit


def edited_text(text: str, following: str) -> str:
    """The last third of the characters replaced by as many of the beginning of the following text, or all it has."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_ROW = "bucket int, border boolean, absent boolean, place bigint, digest binary, text binary, n bigint"
_ROW_NAMES = ["bucket", "border", "absent", "place", "digest", "text", "n"]
_RESULT_NAMES = [
    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
]
_RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _deal(firsts: list[tuple]):
    """Rows with their range and packed text; the first of a range also at the end of the range before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more: dict[tuple, int] = {}
        for b in byte_slices(batches, 3, _SLICE):
            out = []
            for absent, place, digest, text in zip(*(b.column(k).to_pylist() for k in range(4))):
                key = (absent, place, digest)
                if key in more:
                    more[key] += 1
                    continue
                more[key] = 0
                bucket, packed = bisect.bisect_right(firsts, key) - 1, pack(text.encode())
                out.append((bucket, False, *key, packed, 1))
                if firsts[bucket] == key:
                    out.append(((bucket or len(firsts)) - 1, True, *key, packed, 0))
            yield _rows(out)
        again = [(bisect.bisect_right(firsts, k) - 1, False, *k, None, n) for k, n in more.items() if n]
        for k in range(0, len(again), 10_000):
            yield _rows(again[k : k + 10_000])

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
        columns = list(zip(*rows)) or [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _ROW_NAMES)

    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(absent, place, text, copies) of the different rows of a sorted range; the last one has 0 copies, it belongs to the next range."""
    held: list | None = None
    for b in batches:
        for border, absent, place, digest, packed, n in zip(*(b.column(k).to_pylist() for k in range(1, 7))):
            key = (border, absent, place, digest)
            if held and held[0] == key:
                held[2] += n
            else:
                if held:
                    yield *held[0][1:3], held[1], held[2]
                held = [key, unpack(packed).decode(), n]
    if held:
        yield *held[0][1:3], held[1], held[2]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def close(rows: list[tuple]) -> pa.RecordBatch:
        """All of ``rows`` but the last, which is what follows."""
        of = [(r[0], r[1], k, k, r[3] - 1) for k, r in enumerate(rows[:-1]) if r[3] > 1]
        of += [(r[0], r[1], k, k + 1, 1) for k, r in enumerate(rows[:-1]) if r[3]]
        texts = [r[2] for r in rows]
        edited = [edited_text(texts[k], texts[to]) for _, _, k, to, _ in of]
        own, other = fingerprints(texts), fingerprints(edited)
        k, to = np.array([x[2] for x in of], np.int64), np.array([x[3] for x in of], np.int64)
        near_edited, near_next = likeness(distance(own[k], other)).tolist(), likeness(distance(own[k], own[to])).tolist()
        out = []
        for x, (absent, place, k, _, copies) in enumerate(of):
            sha = hashlib.sha256(edited[x].encode()).hexdigest()
            row = (
                None if absent else ~place, len(texts[k]), sha, own[k].tobytes().hex(), other[x].tobytes().hex(),
                near_edited[x], near_next[x],
            )
            out += [row] * copies
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        columns = list(zip(*out)) or [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _RESULT_NAMES)

    rows: list[tuple] = []
    size = 0
    for row in _entries(batches):
        rows.append(row)
        size += len(row[2]) + 256
        if size > _SLICE and len(rows) > 1:
            yield close(rows)
            rows, size = rows[-1:], 0
    if len(rows) > 1:
        yield close(rows)


def edited_prints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    parts = partitions(docs.sparkSession)
    texts = texts_of(docs, id_column, text_column)
    # ids turned round: their ascending order is the descending one of the documents
    keyed = texts.select(
        F.col("doc_id").isNull().alias("absent"),
        F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).cast("bigint").alias("place"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
        "text",
    )
    order = ["absent", "place", "digest"]
    ranges = keyed.select(*order).repartitionByRange(parts, *order).groupBy(F.spark_partition_id().alias("part"))
    first = ranges.agg(F.min(F.struct(*order)).alias("first")).select("first.*").collect()  # one row per range
    firsts = sorted((r["absent"], r["place"], bytes(r["digest"])) for r in first)
    if not firsts:
        return docs.sparkSession.createDataFrame([], _RESULT)
    return (
        keyed.mapInArrow(_deal(firsts), _ROW)
        .repartitionById(len(firsts), F.col("bucket"))
        .sortWithinPartitions("bucket", "border", *order, F.asc_nulls_last("text"))
        .mapInArrow(_compare, _RESULT)
    )


def edited_and_near(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", every: int = 100) -> DataFrame:
    """``edited_prints`` with ``n_within``: the number of other rows whose fingerprint lies within the radius.

    It is counted for the rows whose id can be divided by ``every`` and null for the others.
    """
    found = materialise(edited_prints(docs, id_column, text_column), "prints")
    asked = F.col("doc_id") % every == 0
    rows = found.groupBy("fingerprint").agg(F.count("*").alias("n"))
    near = within_radius(rows, found.where(asked)).join(rows.withColumnRenamed("fingerprint", "other"), "other")
    counts = near.groupBy("fingerprint").agg((F.sum("n") - 1).alias("n_within"))
    answered = found.where(asked).join(counts, "fingerprint").select(*_RESULT_NAMES, "n_within")
    others = found.where(~F.coalesce(asked, F.lit(False))).withColumn("n_within", F.lit(None).cast("bigint"))
    return answered.unionByName(others)
