"""Token by token alignment of the same texts under two tokenizers.

Both encode a blank and the text: A, a byte-level vocabulary of the tokenizers library, is given the blank; B, a sentencepiece model, adds it. Places
where tokens of both end cut the text into groups. An A and a B token are linked when their bytes overlap.

1.  Ends. The byte lengths of the tokens give two ascending lists of ends per document. The shorter list drives: each of its ends is sought in the
    longer list by steps of doubling width from where it would be if the ends were spread evenly, then by halving inside the last step (``gallop``). All
    ends of some documents are sought in lock-step. Its rank there and whether it is met say all: common ends cut groups, and a driving token
    overlaps the other tokens from the rank of the end before it to the rank of its own.
2.  Counts. How many links of the corpus hold a pair of ids is counted in two steps: a task counts the pairs of up to ``PAIRS`` different ones (a
    section), Spark the rows (section, pair, n). The best count of each B id is a table no larger than B's vocabulary and goes to every task.
3.  Back. The counts of a section's pairs and its documents' links meet by section; the links of some documents are stored as
    places in the list of their different pairs.

Texts that are null or empty, and texts whose A or B tokens don't spell the blank and the text, have no tokens. Rows that repeat an id are documents of
their own. Tokens of a text are found by chunks that begin at a blank behind a visible character: neither tokenizer has a token across such
a place (checked for B's vocabulary, by rule for A), so chunks met before are remembered.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.support import byte_slices, materialise, pack, partitions, texts_of, unpack
from lexmill.llm.words import as_bytes, byte_letters

PAIRS = 1 << 18  # different pairs of a section
_SLICE = 1 << 20  # bytes of text looked at together
_REMEMBERED = 250_000  # chunks; the older ones go when twice as many are known
_CHUNK_CHARACTERS = 64  # longer chunks are not remembered
_CHUNK = re.compile(r"(?<=\S) ")


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class TwoEncoders:
    """Ids of texts under both tokenizers, as little-endian 32-bit bytes, and the byte length of every id."""

    def __init__(self, a_path: str, b_path: str, limit: int = _REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=b_path)
        value = {letter: byte for byte, letter in enumerate(byte_letters())}
        names = self.a.get_vocab()
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, k in names.items():
            plain = all(c in value for c in name)
            self.a_bytes[k] = bytes([value[c] for c in name]) if plain else name.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [self._spelled(p) for p in pieces]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.by_chunk = not any(re.search("[^▁]▁", p) for p in pieces) and "▁" in pieces
        self.blank = pieces.index("▁") if "▁" in pieces else 0
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.older: dict[str, tuple[bytes, bytes] | None] = {}
        self.limit = limit

    @staticmethod
    def _spelled(piece: str) -> bytes:
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def _both(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of texts under A and B, None if either doesn't spell the blank and the text."""
        left = [x.ids for x in self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
        right = self.b.encode(texts, num_threads=1)
        out: list[tuple[bytes, bytes] | None] = []
        for t, a, b in zip(texts, left, right):
            b = b or [self.blank]  # a blank alone
            want = b" " + t.encode()
            same = b"".join([self.a_bytes[k] for k in a]) == want and b"".join([self.b_bytes[k] for k in b]) == want
            out.append((as_bytes(a), as_bytes(b)) if same else None)
        return out

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids under A and B, none of either where a text is empty or not spelled by its tokens."""
        parts = [(_CHUNK.split(t) if self.by_chunk else [t]) if t else [] for t in texts]
        if len(self.known) > self.limit:
            self.older, self.known = self.known, {}
        known, passing = self.known, {}
        fresh = []
        for p in set(chain.from_iterable(parts)) - known.keys():
            if p in self.older:
                known[p] = self.older[p]
            else:
                fresh.append(p)
        for p, found in zip(fresh, self._both(fresh)):
            (known if len(p) <= _CHUNK_CHARACTERS else passing)[p] = found
        out = []
        for t, own in zip(texts, parts):
            both = [known[p] if p in known else passing[p] for p in own] if passing else list(map(known.__getitem__, own))
            if None in both:  # some chunk is not spelled by its tokens; the whole text might be
                both = [self._both([t])[0] or (b"", b"")]
            out.append((b"".join([x[0] for x in both]), b"".join([x[1] for x in both])))
        return out


_ENCODERS: dict[tuple, TwoEncoders] = {}


def _encoders(a_path: str, b_path: str) -> TwoEncoders:
    """The encoders of a Python worker; they stay as long as the worker."""
    if (a_path, b_path) not in _ENCODERS:
        _ENCODERS[a_path, b_path] = TwoEncoders(a_path, b_path)
    return _ENCODERS[a_path, b_path]


def gallop(sought: np.ndarray, among: np.ndarray, low: np.ndarray, high: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each value the first place in ``among[low:high]`` (ascending) whose entry is not smaller, ``high`` if there is none.

    From the guess steps of doubling width lead towards the value until it is passed; halving finds the place inside the last step.
    """
    guess = np.clip(guess, low, np.maximum(high - 1, low))
    below, above = low - 1, high.copy()  # the entry at ``below`` is smaller, that at ``above`` is not
    inside = np.flatnonzero(low < high)
    right = among[guess[inside]] < sought[inside]
    for side in (True, False):
        open_, step = inside[right == side], 1
        at = guess[open_]
        while len(open_):
            smaller = among[at] < sought[open_]
            below[open_[smaller]] = at[smaller]
            above[open_[~smaller]] = at[~smaller]
            on = smaller == side  # not passed yet
            open_, at = open_[on], at[on] + (step if side else -step)
            step *= 2
            within = (at < above[open_]) & (at > below[open_])
            open_, at = open_[within], at[within]
    open_ = np.flatnonzero(above - below > 1)
    while len(open_):
        middle = (above[open_] + below[open_]) >> 1
        smaller = among[middle] < sought[open_]
        below[open_[smaller]] = middle[smaller]
        above[open_[~smaller]] = middle[~smaller]
        open_ = open_[above[open_] - below[open_] > 1]
    return above


class Aligned:
    """The alignment of some documents laid end to end.

    ``a_size`` and ``b_size`` are the byte lengths of all tokens, ``a_cuts`` and ``b_cuts`` say where each document's tokens
    begin (with the end). ``a_of`` and ``b_of`` are the linked tokens of every link, ``link_cuts`` where each document's
    links begin; ``a_last`` and ``b_last`` mark tokens that end a group.
    """

    def __init__(self, a_size: np.ndarray, b_size: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray):
        sides = []
        for size, cuts in ((a_size, a_cuts), (b_size, b_cuts)):
            ends = np.cumsum(size)
            sides.append((ends, cuts, np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)), np.zeros(len(size), bool)))
        a_drives = np.diff(a_cuts) <= np.diff(b_cuts)
        found = [self._drive(*sides, a_drives), self._drive(*sides[::-1], ~a_drives)]
        n = np.zeros(len(a_cuts) - 1, np.int64)
        for doc, _, _ in found:
            n += np.bincount(doc, minlength=len(n))
        self.link_cuts = np.r_[0, np.cumsum(n)]
        self.a_of, self.b_of = np.empty(self.link_cuts[-1], np.int64), np.empty(self.link_cuts[-1], np.int64)
        for (doc, driver, other), out in zip(found, ((self.a_of, self.b_of), (self.b_of, self.a_of))):
            own = np.bincount(doc, minlength=len(n))
            place = np.arange(len(doc)) + (self.link_cuts[:-1] - (np.cumsum(own) - own))[doc]
            out[0][place], out[1][place] = driver, other
        self.a_last, self.b_last = sides[0][3], sides[1][3]

    @staticmethod
    def _drive(short, long, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, driving token, other token) of the links of the chosen documents; common ends are marked on both sides."""
        ends, cuts, of, last = short
        others, other_cuts, _, other_last = long
        token = np.flatnonzero(chosen[of])
        doc = of[token]
        if not len(token):
            return doc, token, token
        low, high = other_cuts[doc], other_cuts[doc + 1]
        guess = low + (token - cuts[doc]) * (high - low) // np.diff(cuts)[doc]
        rank = gallop(ends[token], others, low, high, guess)
        met = others[rank] == ends[token]
        last[token], other_last[rank] = met, other_last[rank] | met
        first = token == cuts[doc]
        begin = np.where(first, low, np.r_[0, (rank + met)[:-1]])
        many = rank - begin + 1
        shift = np.repeat(begin - (np.cumsum(many) - many), many)
        return np.repeat(doc, many), np.repeat(token, many), shift + np.arange(len(shift))


def _groups(numbers: np.ndarray, last: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the tokens of one side: their group, and how many tokens there are up to the end of each group."""
    return np.cumsum(last) - last, np.flatnonzero(last) + 1


def group_texts(a_ids: np.ndarray, b_ids: np.ndarray, aligned: Aligned, a_cuts: np.ndarray, b_cuts: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` per document: the ids of each group in order."""
    a_group, a_upto = _groups(a_ids, aligned.a_last, a_cuts)
    b_group, b_upto = _groups(b_ids, aligned.b_last, b_cuts)
    ids = np.empty(len(a_ids) + len(b_ids), np.int64)
    mark = np.empty(len(ids), np.uint8)
    a_at = np.arange(len(a_ids)) + np.r_[0, b_upto][a_group]
    b_at = np.arange(len(b_ids)) + a_upto[b_group]
    ids[a_at], ids[b_at] = a_ids, b_ids
    mark[a_at] = np.where(aligned.a_last, ord("|"), ord(","))
    mark[b_at] = np.where(aligned.b_last, ord(";"), ord(","))
    most = int(ids.max(initial=0))
    width = len(str(most))
    tens = 10 ** np.arange(width - 1, -1, -1)
    every = np.arange(most + 1)[:, None]
    digits = (every // tens % 10 + ord("0")).astype(np.uint8)  # of all ids up to the largest, zeros in front
    used = np.maximum((every >= tens).sum(axis=1), 1)
    shown = np.empty((len(ids), width + 1), np.uint8)
    shown[:, :width] = digits[ids]
    shown[:, width] = mark
    length = used[ids]
    whole = shown[np.arange(width + 1) >= (width - length)[:, None]].tobytes()
    upto = np.r_[0, np.cumsum(length + 1)][a_cuts + b_cuts].tolist()
    return [whole[x : max(y - 1, x)] for x, y in zip(upto, upto[1:])]


_STORED = (
    "kind int, section bigint, pair bigint, n bigint, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, "
    "n_groups array<bigint>, n_links array<bigint>, sha array<string>, pairs binary, places binary"
)
_LISTS = ["doc_ids", "n_a", "n_b", "n_groups", "n_links", "sha"]
_STORED_NAMES = ["kind", "section", "pair", "n", *_LISTS, "pairs", "places"]
_KINDS = [pa.int32(), *[pa.int64()] * 3, *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), pa.binary(), pa.binary()]
_PAIR, _BLOCK = 0, 1


def _stored(rows: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[c], k) if c in columns else pa.nulls(rows, k) for c, k in zip(_STORED_NAMES, _KINDS)]
    return pa.RecordBatch.from_arrays(arrays, _STORED_NAMES)


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different values in order, where each value is among them, and how often it comes."""
    places, different = pd.factorize(values)
    order = np.argsort(different)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return different[order], rank[places], np.bincount(places, minlength=len(order))[order]


def _narrow(x: np.ndarray) -> bytes:
    """Numbers as bytes, the first bytes of all before the second ones."""
    return pack(x.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _wide(stored: bytes) -> np.ndarray:
    return np.frombuffer(unpack(stored), np.uint8).reshape(8, -1).T.copy().view("<i8")[:, 0]


def _align(a_path: str, b_path: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _encoders(a_path, b_path)
        section, known, counts = TaskContext.get().partitionId() << 33, np.zeros(0, np.int64), np.zeros(0, np.int64)

        def close() -> Iterator[pa.RecordBatch]:
            for k in range(0, len(known), 20_000):
                own = slice(k, k + 20_000)
                n = len(known[own])
                yield _stored(n, kind=np.full(n, _PAIR, np.int32), section=np.full(n, section), pair=known[own], n=counts[own])

        for b in byte_slices(batches, 1, _SLICE):
            both = encoders.encode(b.column(1).to_pylist())
            a_ids, b_ids = (np.frombuffer(b"".join([x[k] for x in both]), "<u4").astype(np.int64) for k in (0, 1))
            a_cuts, b_cuts = (np.r_[0, np.cumsum([len(x[k]) // 4 for x in both])].astype(np.int64) for k in (0, 1))
            aligned = Aligned(encoders.a_size[a_ids], encoders.b_size[b_ids], a_cuts, b_cuts)
            shown = group_texts(a_ids, b_ids, aligned, a_cuts, b_cuts)
            pairs = a_ids[aligned.a_of] * len(encoders.b_bytes) + b_ids[aligned.b_of]
            different, places, n = _numbered(pairs)
            joined = np.union1d(known, different)
            if len(joined) > most and len(known):
                yield from close()
                section, known, counts, joined = section + 1, known[:0], counts[:0], different
            summed = np.zeros(len(joined), np.int64)
            summed[np.searchsorted(joined, known)] = counts
            summed[np.searchsorted(joined, different)] += n
            known, counts = joined, summed
            ended = np.r_[0, np.cumsum(aligned.a_last)]
            yield _stored(
                1, kind=[_BLOCK], section=[section], doc_ids=[b.column(0).to_pylist()], n_a=[np.diff(a_cuts)], n_b=[np.diff(b_cuts)],
                n_groups=[np.diff(ended[a_cuts])], n_links=[np.diff(aligned.link_cuts)],
                sha=[[hashlib.sha256(s).hexdigest() if s else "" for s in shown]],
                pairs=[_narrow(np.diff(different, prepend=0))], places=[_narrow(places)],
            )
        yield from close()

    return run


_RESULT_NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
_RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (section, kind): the counts of a section's pairs, then its documents."""
    section, parts, table = None, [], None

    def rows_of(block: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for k in range(block.num_rows):
            row = {c: block.column(x)[k] for x, c in enumerate(block.schema.names)}
            pair, count, best = table
            at = np.searchsorted(pair, np.cumsum(_wide(row["pairs"].as_py())))
            places = at[_wide(row["places"].as_py())]
            lists = [pa.array(row[c].values) for c in _LISTS]
            n_links = lists[4].to_numpy(zero_copy_only=False)
            cuts = np.r_[0, np.cumsum(n_links)]
            sums = [np.r_[0, np.cumsum(x[places])][cuts] for x in (best.astype(np.int64), count)]
            n_best, count_sum = (pa.array(np.diff(s), pa.int64()) for s in sums)
            yield pa.RecordBatch.from_arrays([*lists[:5], n_best, count_sum, lists[5]], _RESULT_NAMES)

    for b in batches:
        kind, of = b.column(0).to_numpy(), b.column(1).to_numpy()
        cuts = np.flatnonzero(np.r_[True, (kind[1:] != kind[:-1]) | (of[1:] != of[:-1]), True])
        for x, y in zip(cuts.tolist(), cuts[1:].tolist()):
            if of[x] != section:
                section, parts, table = of[x], [], None
            own = b.slice(x, y - x)
            if kind[x] == _PAIR:
                parts.append([own.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4)])
                continue
            if table is None:
                pair, count, best = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
                order = np.argsort(pair)
                table, parts = (pair[order], count[order], best[order]), []
            yield from rows_of(own.select(["pairs", "places", *_LISTS]))


def align(
    docs: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    pairs: int = PAIRS,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row; ``pairs`` bounds what a section holds."""
    stored, counted = aligned_and_counted(docs, a_path, b_path, id_column, text_column, pairs)
    found = stored.where(F.col("kind") == _PAIR).select("section", "pair").join(counted, "pair")
    answers = found.select(
        F.lit(_PAIR).alias("kind"), "section", "pair", "n", "best", *[F.lit(None).cast("array<bigint>").alias(c) for c in _LISTS[:-1]],
        F.lit(None).cast("array<string>").alias("sha"), F.lit(None).cast("binary").alias("pairs"), F.lit(None).cast("binary").alias("places"),
    )
    blocks = stored.where(F.col("kind") == _BLOCK).select(
        "kind", "section", "pair", "n", F.lit(None).cast("boolean").alias("best"), *_LISTS, "pairs", "places"
    )
    together = answers.unionByName(blocks).repartition(partitions(docs.sparkSession), "section")
    return together.sortWithinPartitions("section", "kind").mapInArrow(_look_up, _RESULT)


def aligned_and_counted(
    docs: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    pairs: int = PAIRS,
) -> tuple[DataFrame, DataFrame]:
    """The stored sections, and (pair, n, best): the links of each pair of ids, and whether none of the same B id has more.

    A pair is the A id times the size of B's vocabulary, plus the B id.
    """
    a_default, b_default = default_vocabularies() if a_path is None or b_path is None else (None, None)
    a_path, b_path = a_path or a_default, b_path or b_default
    width = len(_encoders(a_path, b_path).b_bytes)
    texts = texts_of(docs, id_column, text_column)
    stored = materialise(texts.mapInArrow(_align(a_path, b_path, pairs), _STORED), "alignment", by="kind").select(*_STORED_NAMES)
    rows = stored.where(F.col("kind") == _PAIR).select("pair", "n")
    counts = materialise(rows.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b_id = F.col("pair") % width
    most = counts.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("most"))  # a row per B id: bounded by the vocabulary
    best = counts.withColumn("b_id", b_id).join(F.broadcast(most), "b_id")
    return stored, best.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def pair_counts(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, **columns: str) -> DataFrame:
    """(a_id, b_id, n, best): how many links of the whole table hold each pair of ids."""
    a_default, b_default = default_vocabularies() if a_path is None or b_path is None else (None, None)
    a_path, b_path = a_path or a_default, b_path or b_default
    width = len(_encoders(a_path, b_path).b_bytes)
    _, counted = aligned_and_counted(docs, a_path, b_path, **columns)
    return counted.select(F.floor(F.col("pair") / width).alias("a_id"), (F.col("pair") % width).alias("b_id"), "n", "best")
