"""Runs of repeated word sequences in each document, found with common-extension queries over a difference cover.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no neighbouring word extends,
with at least two periods and ``LEAST`` words. Words are the stretches between blanks and the control characters 9 to 13.

1.  The words of some documents of like length are numbered and laid end to end with a different mark between any two, so nothing matches
    across documents.
2.  A run of period q covers two neighbouring multiples of q. For every q up to half the longest document, the words at neighbouring multiples and
    the words before them are compared; where either agree, two queries say how far the texts agree from there to the right and to the left.
3.  A query (``CoverLce``) compares words until both places belong to a sample of all places, those whose remainder lies in a difference
    cover; for any two remainders that takes fewer steps than the cover's modulus. Only the sampled suffixes are sorted; a sparse table of
    minima over the common prefixes of neighbours answers for the rest.
4.  Of stretches found with several periods the smallest one counts.

Everything is done within the row's task: no exchange, memory in proportion to one slice of texts or one longer text.
Null and empty texts and texts of white space have no words and no runs. Rows that repeat an id are documents of their own.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexmill.llm.support import byte_slices, texts_of

LEAST = 12
#: A perfect difference set: any two remainders modulo ``MODULUS`` are moved into it by one common shift.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SLICE = 1 << 22  # bytes of text looked at together
_QUERIES = 1 << 20  # places of the grid looked at together


def _shifts() -> np.ndarray:
    """For two remainders the least shift that brings both into the cover."""
    inside = np.zeros(MODULUS, bool)
    inside[list(COVER)] = True
    i, j, step = np.ogrid[:MODULUS, :MODULUS, :MODULUS]
    both = inside[(i + step) % MODULUS] & inside[(j + step) % MODULUS]
    return both.argmax(axis=2)


_SHIFT = _shifts()


class CoverLce:
    """How many words agree from two places on, for an array whose last word occurs once."""

    def __init__(self, words: np.ndarray):
        self.words = words
        inside = np.zeros(MODULUS, bool)
        inside[list(COVER)] = True
        spot = np.flatnonzero(inside[np.arange(len(words)) % MODULUS])
        self.number = np.full(len(words), -1, np.int64)
        self.number[spot] = np.arange(len(spot))
        levels, order = self._sort(spot)
        self.rank = np.empty(len(spot), np.int64)
        self.rank[order] = np.arange(len(spot))
        self.minima = [self._neighbours(spot, order, levels)]
        while 2 << len(self.minima) - 1 <= len(self.minima[0]):
            last, half = self.minima[-1], 1 << len(self.minima) - 1
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def _sort(self, spot: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Ranks of the sampled suffixes by their first 31, 62, 124 ... words, until all differ, and their order.

        The words behind the end count as smaller than any.
        """
        words, n = self.words, len(self.words)
        bits = max(int(words.max(initial=0) + 1).bit_length(), 1)
        many = 62 // bits
        keys = []
        for first in range(0, MODULUS, many):
            key = np.zeros(len(spot), np.int64)
            for k in range(first, min(first + many, MODULUS)):
                at = spot + k
                key = key << bits | np.where(at < n, words[np.minimum(at, n - 1)] + 1, 0)
            keys.append(key)
        order = np.lexsort(keys[::-1])
        differ = np.zeros(max(len(spot) - 1, 0), bool)
        for key in keys:
            differ |= key[order][1:] != key[order][:-1]
        levels, step = [], MODULUS
        while True:
            rank = np.empty(len(spot), np.int64)
            rank[order] = np.r_[0, np.cumsum(differ)][: len(spot)]
            levels.append(rank)
            if differ.all():
                return levels, order
            ahead = spot + step
            after = np.where(ahead < n, rank[self.number[np.minimum(ahead, n - 1)]], -1)
            order = np.lexsort((after, rank))
            differ = (rank[order][1:] != rank[order][:-1]) | (after[order][1:] != after[order][:-1])
            step *= 2

    def _neighbours(self, spot: np.ndarray, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """What each sampled suffix shares with the next one in the order."""
        i, j = spot[order][:-1].copy(), spot[order][1:].copy()
        shared = np.zeros(len(i), np.int64)
        for t in range(len(levels) - 1, -1, -1):
            equal = levels[t][self.number[i]] == levels[t][self.number[j]]
            step = equal * (MODULUS << t)
            i, j, shared = i + step, j + step, shared + step
        return shared + self._direct(i, j, np.full(len(i), MODULUS))[0]

    def _direct(self, i: np.ndarray, j: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many words agree, ``upto`` at most, and which pairs got that far."""
        agreed = np.zeros(len(i), np.int64)
        left = np.flatnonzero(upto > 0)
        k = 0
        while len(left):
            left = left[self.words[i[left] + k] == self.words[j[left] + k]]
            k += 1
            agreed[left] = k
            left = left[upto[left] > k]
        return agreed, np.flatnonzero(agreed == upto)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For different places i and j."""
        agreed, rest = self._direct(i, j, _SHIFT[i % MODULUS, j % MODULUS])
        a = self.rank[self.number[i[rest] + agreed[rest]]]
        b = self.rank[self.number[j[rest] + agreed[rest]]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        least = np.empty(len(rest), np.int64)
        for t in np.unique(level).tolist():
            own = level == t
            least[own] = np.minimum(self.minima[t][low[own]], self.minima[t][high[own] - (1 << t)])
        agreed[rest] += least
        return agreed


def find_runs(words: np.ndarray, longest: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs by start and period. The first and the last word, and those between documents, occur once.

    ``longest`` is the number of words of the longest document.
    """
    n = len(words)
    ahead, back = CoverLce(words), CoverLce(words[::-1].copy())
    found = [np.zeros((3, 0), np.int64)]
    periods = np.arange(1, longest // 2 + 1)
    upto = np.cumsum((n - 1 - periods) // periods + 1)
    k = 0
    while k < len(periods):
        to = max(int(np.searchsorted(upto, (upto[k - 1] if k else 0) + _QUERIES, side="right")), k + 1)
        own = periods[k:to]
        many = (n - 1 - own) // own + 1
        p = np.repeat(own, many)
        i = (np.arange(len(p)) - np.repeat(np.cumsum(many) - many, many)) * p
        agree = words[i] == words[i + p]
        near = np.flatnonzero(agree | (words[np.maximum(i - 1, 0)] == words[np.maximum(i - 1, 0) + p]))
        i, p = i[near], p[near]
        right = ahead(i, i + p)
        left = np.zeros(len(i), np.int64)
        inner = np.flatnonzero(i > 0)
        left[inner] = back(n - i[inner], n - i[inner] - p[inner])
        start, end = i - left, i + p + right
        good = end - start >= np.maximum(2 * p, least)
        found.append(np.stack([start[good], end[good], p[good]]))
        k = to
    start, end, p = np.concatenate(found, axis=1)
    order = np.lexsort((p, end, start))
    start, end, p = start[order], end[order], p[order]
    first = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])][: len(start)]
    start, end, p = start[first], end[first], p[first]
    order = np.lexsort((p, start))
    return start[order], end[order], p[order]


def stretched(n: int, doc_id: int | None) -> np.ndarray:
    """Word numbers of the test edit: for a tenth of the ids, by checksum, the words from some place on repeat a short stretch.

    A document without id or words stays as it is.
    """
    at = np.arange(n)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return at
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.where(at >= a, a + (at - a) % p, at)


class _Numbers(dict):
    """Word -> number, in the order of first use."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _runs_of(texts: list[str | None], ids: list[int | None], edit: bool) -> Iterator[tuple[int, list[str], np.ndarray, np.ndarray]]:
    """(number of the text, its words, runs as rows (start, end, period), which words stay), documents of like length together."""
    words = [_WORD.findall(t) if t else [] for t in texts]
    used = [stretched(len(w), d if edit else None) for w, d in zip(words, ids)]
    number = _Numbers()
    codes = [np.array(list(map(number.__getitem__, w)), np.int64)[u] for w, u in zip(words, used)]
    classes: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        if len(w) < LEAST:
            yield k, [w[x] for x in used[k].tolist()], np.zeros((0, 3), np.int64), np.ones(len(w), bool)
        else:
            classes.setdefault(len(w).bit_length(), []).append(k)
    for members in classes.values():
        sizes = np.array([len(words[k]) for k in members])
        begin = np.cumsum(sizes + 1) - sizes
        laid = np.arange(len(number), len(number) + int(sizes.sum()) + len(members) + 1)
        for k, b in zip(members, begin.tolist()):
            laid[b : b + len(words[k])] = codes[k]
        laid = np.unique(laid, return_inverse=True)[1]  # marks between documents are new numbers, each used once
        start, end, period = find_runs(laid, int(sizes.max()))
        drop = np.zeros(len(laid) + 1, np.int64)
        np.add.at(drop, start + period, 1)
        np.add.at(drop, end, -1)
        stays = np.cumsum(drop) == 0
        cuts = np.searchsorted(start, np.r_[begin, len(laid)])
        for k, b, x, y in zip(members, begin.tolist(), cuts.tolist(), cuts[1:].tolist()):
            n = len(words[k])
            rows = np.stack([start[x:y] - b, end[x:y] - b, period[x:y]], axis=1)
            yield k, [words[k][u] for u in used[k].tolist()], rows, stays[b : b + n]


def _kept(words: list[str], stays: np.ndarray) -> str:
    return " ".join(words if stays.all() else [words[k] for k in np.flatnonzero(stays).tolist()])


def collapse(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", edit: bool = False) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row.

    ``runs`` lists (start, length, period) by start and period, in words from 0; ``collapsed`` are the words that no run
    contains after its first period, joined by blanks. With ``edit`` texts are first changed as ``stretched`` says.
    """
    schema = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, 1, _SLICE):
            ids, out = b.column(0).to_pylist(), []
            for k, words, runs, stays in _runs_of(b.column(1).to_pylist(), ids, edit):
                spans = [{"start": s, "length": e - s, "period": p} for s, e, p in runs.tolist()]
                out.append((ids[k], len(words), spans, _kept(words, stays)))
            columns = list(zip(*out)) or [[]] * 4
            kinds = [pa.int64(), pa.int64(), kind, pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "n_words", "runs", "collapsed"]
            )

    return texts_of(docs, id_column, text_column).mapInArrow(run, schema)


_DIGEST_NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every row, with the test edit.

    The longest run is named, of equally long ones the first, then that with the smaller period; without runs these are null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, 1, _SLICE):
            ids, out = b.column(0).to_pylist(), []
            for k, words, runs, stays in _runs_of(b.column(1).to_pylist(), ids, True):
                best = [None] * 4
                if len(runs):
                    length = runs[:, 1] - runs[:, 0]
                    x = int(length.argmax())  # runs are ordered by start and period, the first one counts
                    best = [int(runs[x, 0]), int(length[x]), int(runs[x, 2]), 1000 * int(length[x]) // int(runs[x, 2])]
                lines = "".join([f"{s},{e - s},{p}\n" for s, e, p in runs.tolist()])
                both = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, _kept(words, stays))]
                out.append((ids[k], len(runs), *best, *both))
            columns = list(zip(*out)) or [[]] * 8
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _DIGEST_NAMES)

    schema = ", ".join(f"{n} {'string' if n.endswith('sha256') else 'bigint'}" for n in _DIGEST_NAMES)
    return texts_of(docs, id_column, text_column).mapInArrow(run, schema)
