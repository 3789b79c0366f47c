"""Passages of many bytes that occur more than once, found with enhanced suffix arrays, and their removal.

A repeat of ``LENGTH`` bytes or more holds at least one *anchor*: the stretch of ``ANCHOR`` bytes whose hash is the
smallest among all stretches of some ``LENGTH`` bytes. Equal passages have equal anchors, so suffixes need to be compared
only within a group of equal anchors, and a table of any size falls into groups that tasks can hold.

1.  Each document gives its anchors with a hash of their surroundings, the bytes of all passages of ``LENGTH`` that hold the
    anchor. Where surroundings are equal as a whole, all but the earliest are repeats throughout; a task settles those among its own
    documents first, so that a passage in every document sends one row per task.
2.  Anchors with different surroundings send them on, each different one once. Over those of a group the suffixes are sorted; the
    common prefixes of neighbours (the enhanced suffix array) are scanned with a stack, which yields the tree of prefix intervals; an
    interval whose occurrences differ in the byte before them is a maximal repeat, given out with all its occurrences.
3.  Of each maximal repeat the earliest occurrence stays and the others are removed.

Texts are UTF-8 bytes, null is empty, matches never cross documents, documents are ordered by doc_id (null first), and
rows with equal doc_id by 128 bits of the SHA-256 of their texts. Rows equal in doc_id and text are one document: they are not repeats of each
other, however they are dealt, and each gets its result.
Bytes of one anchor's different surroundings meet in one task: texts equal as a whole around an anchor don't count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.support import (
    byte_slices,
    materialise,
    mix64,
    pack,
    partitions,
    prefix_hash,
    span_hash,
    text_marks,
    unpack,
    utf8,
)

LENGTH = 100
ANCHOR = 24
_REACH = 2 * LENGTH - ANCHOR  # bytes of all passages of that length around an anchor
_LARGEST = np.uint64(0xFFFFFFFFFFFFFFFF)
_NO_ID = np.iinfo(np.int64).min
_CHUNK = 1 << 19  # bytes looked at together: arrays of hashes that fit a processor's cache
_ANCHOR_ROW = np.dtype([("h", "<u8"), ("c", "<u8"), ("doc", "<i8"), ("t", "<i8"), ("u", "<i8"), ("pos", "<u4")])


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best(x[i : i + width]) for every i that has a full window, by doubling."""
    size = 1
    while size * 2 <= width:
        x = best(x[:-size], x[size:])
        size *= 2
    return best(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, surroundings' hash, document, place in the document) of the anchors of the texts laid end to end in ``data``."""
    n, reach = len(data), LENGTH - ANCHOR + 1
    none = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    if n < LENGTH:
        return none
    sums = prefix_hash(data)
    spot = np.arange(n - ANCHOR + 1)
    h = span_hash(sums, spot, spot + ANCHOR)
    left = np.repeat(offsets[1:], np.diff(offsets))  # end of the document of each byte
    smallest = _sliding(h, reach, np.minimum)
    smallest[np.arange(len(smallest)) + LENGTH > left[: len(smallest)]] = 0
    edge = np.zeros(reach - 1, np.uint64)
    largest = _sliding(np.concatenate([edge, smallest, edge]), reach, np.maximum)
    at = np.flatnonzero((h == largest) & (spot + ANCHOR <= left[: len(spot)]))
    doc = np.searchsorted(offsets, at, side="right") - 1
    begin = np.maximum(at - (LENGTH - ANCHOR), offsets[doc])
    end = np.minimum(at + LENGTH, offsets[doc + 1])
    return h[at], mix64(span_hash(sums, begin, end) + (at - begin).astype(np.uint64)), doc, at - offsets[doc]


def _grouped_bytes(values: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    return [values[a:b].tobytes() for a, b in zip(cuts.tolist(), cuts[1:].tolist())]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where rows differ from the row before them in any of the columns, the first one included."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _cuts(*columns: np.ndarray) -> np.ndarray:
    """Where the groups of equal rows begin, and the end."""
    return np.r_[np.flatnonzero(_changes(*columns)), len(columns[0])]


def _note(doc: np.ndarray, t: np.ndarray, u: np.ndarray, pos: np.ndarray, column: int) -> Iterator[pa.RecordBatch]:
    """Places by document: a row (doc, t, u, settled, fine) for each, ``column`` says in which."""
    order = np.lexsort((pos, u, t, doc))
    doc, t, u, pos = doc[order], t[order], u[order], pos[order].astype("<u4")
    cuts = _cuts(doc, t, u)
    first = cuts[:-1]
    places = pa.array(_grouped_bytes(pos, cuts), pa.binary())
    empty = pa.nulls(len(first), pa.binary())
    both = [places, empty] if column == 0 else [empty, places]
    yield _rows(len(first), bucket=None, doc=doc[first], t=t[first], u=u[first], settled=both[0], fine=both[1])


_NAMES = ["bucket", "doc", "t", "u", "settled", "fine", "blob"]
_SCHEMA = "bucket int, doc bigint, t bigint, u bigint, settled binary, fine binary, blob binary"


def _rows(n: int, bucket=None, doc=None, t=None, u=None, settled=None, fine=None, blob=None) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.int64()] * 3, *[pa.binary()] * 3]
    values = [bucket, doc, t, u, settled, fine, blob]
    arrays = [pa.nulls(n, k) if v is None else pa.array(v, k) if not isinstance(v, pa.Array) else v for v, k in zip(values, kinds)]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


_BATCH = 1 << 22  # bytes of text that a task looks at together


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes: they are moved twice."""
    for b in byte_slices(batches, 3, _BATCH):
        packed = [pack(text.encode()) for text in b.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(packed, pa.binary()), *b.columns[4:]], b.schema.names)


def _find_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, 3, _BATCH):
            name = b.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            t, u = b.column(1).to_numpy(), b.column(2).to_numpy()
            data, offsets = utf8(b.column(3))
            # documents in their order, each once
            order = np.lexsort((u, t, name))
            new = _changes(name[order], t[order], u[order])
            rank = np.full(len(name), -1)
            rank[order[new]] = np.arange(new.sum())
            found = []
            k = 0
            while k < len(name):
                to = max(int(np.searchsorted(offsets, offsets[k] + _CHUNK, side="right")) - 1, k + 1)
                h, c, doc, pos = anchors(data[offsets[k] : offsets[to]], offsets[k : to + 1] - offsets[k])
                found.append((h, c, doc + k, pos))
                k = to
            if not found:
                continue
            h, c, doc, pos = (np.concatenate(x) for x in zip(*found))
            once = rank[doc] >= 0
            h, c, doc, pos = h[once], c[once], doc[once], pos[once]
            order = np.argsort(rank[doc] << 32 | pos)
            h, c, doc, pos = h[order], c[order], doc[order], pos[order]
            both = mix64(h + mix64(c))
            same = np.argsort(both, kind="stable")
            first = np.r_[True, both[same][1:] != both[same][:-1]] if len(same) else np.zeros(0, bool)
            later, sent = same[~first], same[first]
            yield from _note(name[doc[later]], t[doc[later]], u[doc[later]], pos[later], 0)
            sent = np.sort(sent)
            bucket = (h[sent] >> np.uint64(20)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            sent, bucket = sent[order], bucket[order]
            cuts = _cuts(bucket)
            columns = [x.astype(_ANCHOR_ROW[n]) for n, x in zip(_ANCHOR_ROW.names, (h, c, name[doc], t[doc], u[doc], pos))]
            blobs = []
            for x, y in zip(cuts.tolist(), cuts[1:].tolist()):
                blobs.append(pack(_anchor_bytes([v[sent[x:y]] for v in columns])))
            yield _rows(len(blobs), bucket=bucket[cuts[:-1]].astype(np.int32), blob=pa.array(blobs, pa.binary()))

    return run


def _anchor_bytes(columns: list[np.ndarray]) -> bytes:
    """Columns of anchors for the compressor: documents as steps, and the first bytes of all values before the second ones."""
    planes = []
    for name, values in zip(_ANCHOR_ROW.names, columns):
        values = np.diff(values, prepend=0) if name == "doc" else values
        planes.append(values.view(np.uint8).reshape(len(values), -1).T.tobytes())
    return b"".join(planes)


def _anchor_rows(planes: bytes) -> np.ndarray:
    n, at = len(planes) // _ANCHOR_ROW.itemsize, 0
    rows = np.empty(n, _ANCHOR_ROW)
    for name in _ANCHOR_ROW.names:
        kind = _ANCHOR_ROW[name]
        values = np.frombuffer(planes, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n).T.copy().view(kind)[:, 0]
        rows[name] = np.cumsum(values) if name == "doc" else values
        at += n * kind.itemsize
    return rows


def _compare_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settles anchors whose surroundings occur earlier, and names those whose surroundings differ from others'."""
    held: list[bytes] = []
    for b in batches:
        is_blob = b.column(6).is_valid()
        held += b.filter(is_blob).column(6).to_pylist()
        yield b.filter(b.column(6).is_null())
    if not held:
        return
    rows = np.concatenate([_anchor_rows(unpack(blob)) for blob in held])
    held.clear()
    rows = rows[np.lexsort([rows[c] for c in ("pos", "u", "t", "doc", "c", "h")])]
    rows = rows[_changes(*[rows[c] for c in rows.dtype.names])]  # one document may come from several tasks
    new_h = _changes(rows["h"])
    first = new_h | _changes(rows["c"])
    again = rows[~first]
    yield from _note(again["doc"], again["t"], again["u"], again["pos"], 0)
    group = np.cumsum(new_h) - 1
    kinds = np.bincount(group, weights=first)
    fine = rows[first & (kinds[group] > 1)]
    yield from _note(fine["doc"], fine["t"], fine["u"], fine["pos"], 1)


def union_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.r_[True, start[1:] > reach[:-1]]
    last = np.r_[new[1:], True]
    return start[new], reach[last]


def _places(lists: list[bytes] | None) -> np.ndarray:
    return np.frombuffer(b"".join(lists or []), "<u4").astype(np.int64)


def cut(text: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    """What is left of ``text`` without the spans."""
    edges = [0, *np.stack([start, end], 1).reshape(-1).tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


_RESULT = ["kind", "doc", "t", "u", "bucket", "text", "spans", "blob", "n_bytes", "n_removed", "n_spans", "sha", "kept"]
_RESULT_SCHEMA = (
    "kind int, doc bigint, t bigint, u bigint, bucket int, text binary, spans binary, blob binary, "
    "n_bytes bigint, n_removed bigint, n_spans bigint, sha string, kept string"
)
_KINDS = [pa.int32(), *[pa.int64()] * 3, pa.int32(), *[pa.binary()] * 3, *[pa.int64()] * 3, *[pa.string()] * 2]
_DONE, _OPEN, _CONTEXT = 0, 1, 2


def _result_batch(rows: list[tuple], rest: pa.Array) -> pa.RecordBatch:
    """The rows, and what else the documents that the first rows come from hold."""
    columns = list(zip(*rows)) if rows else [[]] * len(_KINDS)
    nothing = pa.nulls(len(rows) - len(rest), rest.type)
    rest = pa.concat_arrays([rest, nothing]) if len(nothing) else rest
    return pa.RecordBatch.from_arrays([*[pa.array(c, k) for c, k in zip(columns, _KINDS)], rest], [*_RESULT, "rest"])


def _finished(name: tuple, text: bytes, start: np.ndarray, end: np.ndarray, with_text: bool) -> tuple:
    kept = cut(text, start, end)
    sha = hashlib.sha256(kept).hexdigest()
    readable = kept.decode(errors="ignore") if with_text else None
    return _DONE, *name, None, None, None, None, len(text), len(text) - len(kept), len(start), sha, readable


# A surrounding on its way: anchor hash, document, marks, place of its first byte, place of the anchor in it, bytes.
_HEAD = np.dtype(
    [("h", "<u8"), ("doc", "<i8"), ("t", "<i8"), ("u", "<i8"), ("begin", "<u4"), ("anchor", "u1"), ("size", "u1")]
)


def _apply_settled(buckets: int, with_text: bool):
    """Documents whose anchors are all settled are finished; the others send the surroundings of their open anchors, equal rows once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple] = set()
        for b in byte_slices(batches, 3, _BATCH):
            out: list[tuple] = []
            heads: list[np.ndarray] = []
            bodies: list[bytes] = []
            for doc, t, u, packed, settled, fine in zip(*(b.column(k).to_pylist() for k in range(6))):
                name = doc, t, u
                text = unpack(packed)
                at = _places(settled)
                start, end = union_spans(np.maximum(at - (LENGTH - ANCHOR), 0), np.minimum(at + LENGTH, len(text)))
                at = _places(fine)
                if not len(at):
                    out.append(_finished(name, text, start, end, with_text))
                    continue
                spans = np.stack([start, end], 1).astype("<u4").tobytes()
                out.append((_OPEN, *name, None, packed, spans, *[None] * 6))
                if name in sent:
                    continue
                sent.add(name)
                begin, stop = np.maximum(at - (LENGTH - ANCHOR), 0), np.minimum(at + LENGTH, len(text))
                head = np.empty(len(at), _HEAD)
                head["h"] = _hashes_at(np.frombuffer(text, np.uint8), at)
                head["doc"] = _NO_ID if doc is None else doc
                head["t"], head["u"], head["begin"], head["anchor"], head["size"] = t, u, begin, at - begin, stop - begin
                heads.append(head)
                bodies += [text[x:y] for x, y in zip(begin.tolist(), stop.tolist())]
            if heads:
                head = np.concatenate(heads)
                bucket = ((head["h"] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = _cuts(bucket[order])
                for x, y in zip(cuts.tolist(), cuts[1:].tolist()):
                    own = order[x:y]
                    blob = len(own).to_bytes(8, "little") + head[own].tobytes() + b"".join([bodies[k] for k in own.tolist()])
                    out.append((_CONTEXT, None, None, None, int(bucket[own[0]]), None, None, pack(blob), *[None] * 5))
            yield _result_batch(out, _array(b.column(6)))

    return run


def _array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _hashes_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the anchors at some places of a text, from these bytes alone."""
    inside = data[at[:, None] + np.arange(ANCHOR)].reshape(-1)
    sums = prefix_hash(inside)
    first = np.arange(len(at)) * ANCHOR
    return span_hash(sums, first, first + ANCHOR)


def prefix_intervals(common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Intervals of the common-prefix tree as (length, first, last), inner ones first.

    ``common[k]`` is what entries k and k + 1 of a suffix array share. An interval is open while the shared
    length does not fall below its own; the stack holds the open ones.
    """
    stack: list[tuple[int, int]] = []
    for k, shared in enumerate([*common, 0]):
        first = k
        while stack and stack[-1][0] > shared:
            length, first = stack.pop()
            yield length, first, k
        if shared >= least and (not stack or stack[-1][0] < shared):
            stack.append((shared, first))


def _suffix_order(tails: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by group and bytes, and how many bytes neighbours share beyond their first ``LENGTH``, -1 across groups.

    ``tails`` has a row of bytes per suffix, zeros behind its ``size``; a suffix that another continues comes before it.
    """
    words = tails.view(">u8").astype(np.uint64)
    order = np.lexsort((size, *words.T[::-1], group))
    tails, size, group = tails[order], size[order], group[order]
    differ = tails[1:] != tails[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), tails.shape[1])
    shared = np.minimum(shared, np.minimum(size[1:], size[:-1]))
    return order, np.where(group[1:] == group[:-1], shared, -1)


_OCCURRENCES = 1 << 17  # occurrences of maximal repeats given out together
_WINDOWS = 1 << 16  # passages of a group looked at together
_RUNS = 1 << 17  # runs to remove that are kept before they are united


def maximal_repeats(
    bodies: list[bytes], group: np.ndarray, begin: np.ndarray, anchor: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, count, contexts, places): the maximal repeats among contexts of the same group, with all occurrences.

    The occurrences of one repeat follow those of the one before; some repeats are given out at a time. ``begin`` is
    the place of each context in its document, ``anchor`` that of its anchor in the context; a context is cut to the
    left and right, which counts as a difference there. Equal passages hold the anchor at the same place, so
    passages are compared by the distance from their anchor, some distances at a time.
    """
    data = np.frombuffer(b"".join(bodies), np.uint8)
    size = np.fromiter(map(len, bodies), np.int64, len(bodies))
    base = np.cumsum(size) - size
    step = max(1, _WINDOWS // len(bodies))
    for before_anchor in range(0, LENGTH - ANCHOR + 1, step):
        low = np.maximum(anchor - before_anchor - step + 1, 0)
        high = np.minimum(anchor - before_anchor, size - LENGTH) + 1
        windows = np.maximum(high - low, 0)
        owner = np.repeat(np.arange(len(bodies)), windows)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + low[owner]
        yield from _repeats_of(data, base, size, group, begin, owner, place)


_WORDS = -(-LENGTH // 8)
_LAST = np.array([0xFF] * (LENGTH - 8 * (_WORDS - 1)) + [0] * (8 * _WORDS - LENGTH), np.uint8).view("<u8")[0]
_TURN = mix64(np.arange(701, 701 + _WORDS, dtype=np.uint64)) | np.uint64(1)


def _passage_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the ``LENGTH`` bytes from each place on, a few thousand passages at a time."""
    out = np.empty(len(at), np.uint64)
    rows = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8 * _WORDS, np.uint8)]), 8 * _WORDS)
    for k in range(0, len(at), 1 << 13):
        words = rows[at[k : k + (1 << 13)]].view("<u8")
        words[:, -1] &= _LAST
        out[k : k + len(words)] = (mix64(words ^ _TURN) * _TURN).sum(axis=1, dtype=np.uint64)
    return mix64(out)


def _repeats_of(data, base, size, group, begin, owner, place) -> Iterator[tuple[np.ndarray, ...]]:
    """``maximal_repeats`` that begin at the given places of the given contexts."""
    if not len(owner):
        return
    at = base[owner] + place
    key = mix64(_passage_hashes(data, at) + mix64(group[owner]))
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
    count = np.diff(np.r_[first, len(order)])
    same = np.repeat(np.arange(len(first)), count)
    before = np.where(place > 0, data[at - 1].astype(np.int64), -1 - np.arange(len(at)))[order]
    # a group of equal passages that all have the same byte before them begins further left
    begins = np.logical_or.reduceat(before != before[first][same], first)
    rows = order[begins[same]]
    group_of, ahead = same[begins[same]], before[begins[same]]
    if not len(rows):
        return
    rest = size[owner[rows]] - place[rows] - LENGTH
    width = -(-(_REACH - LENGTH) // 8) * 8
    padded = np.concatenate([data, np.zeros(LENGTH + width, np.uint8)])
    tails = np.lib.stride_tricks.sliding_window_view(padded, width)[at[rows] + LENGTH]
    tails[np.arange(width, dtype=np.int16) >= rest.astype(np.int16)[:, None]] = 0
    suffixes, shared = _suffix_order(tails, rest, group_of)
    rows, ahead = rows[suffixes], ahead[suffixes]
    differs = np.r_[0, np.cumsum(ahead[1:] != ahead[:-1])]
    found = np.array(list(prefix_intervals((shared + LENGTH).tolist(), LENGTH)), np.int64).reshape(-1, 3)
    found = found[differs[found[:, 2]] > differs[found[:, 1]]]
    upto = np.cumsum(found[:, 2] - found[:, 1] + 1)
    k = 0
    while k < len(found):
        to = max(int(np.searchsorted(upto, (upto[k - 1] if k else 0) + _OCCURRENCES, side="right")), k + 1)
        length, first, last = found[k:to].T
        count = last - first + 1
        inside = rows[np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        yield length, count, owner[inside], place[inside] + begin[owner[inside]]
        k = to


def _contexts(blobs: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    heads, bodies = [], []
    for blob in map(unpack, blobs):
        n = int.from_bytes(blob[:8], "little")
        head = np.frombuffer(blob, _HEAD, n, 8)
        stop = 8 + n * _HEAD.itemsize + np.cumsum(head["size"].astype(np.int64))
        bodies += [blob[y - s : y] for y, s in zip(stop.tolist(), head["size"].tolist())]
        heads.append(head)
    head = np.concatenate(heads)
    # near a document's start several anchors have surroundings that begin at its first byte
    names = ("anchor", "begin", "u", "t", "doc", "h")
    order = np.lexsort([head[c] for c in names])
    order = order[_changes(*[head[c][order] for c in names])]
    return head[order], [bodies[k] for k in order.tolist()]


_GROUP_CHUNK = 2048  # contexts compared together; groups stay whole


def _array_groups(blobs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(heads, lengths, counts, contexts, places) of the maximal repeats of a partition's anchor groups, some groups at a time."""
    head, bodies = _contexts(blobs)
    starts = np.flatnonzero(np.r_[True, head["h"][1:] != head["h"][:-1], True])
    k = 0
    while k < len(starts) - 1:
        to = max(int(np.searchsorted(starts, starts[k] + _GROUP_CHUNK, side="right")) - 1, k + 1)
        x, y = int(starts[k]), int(starts[to])
        own = head[x:y]
        for found in maximal_repeats(bodies[x:y], own["h"], own["begin"].astype(np.int64), own["anchor"].astype(np.int64)):
            yield own, *found
        k = to


def _blobs(batches: Iterator[pa.RecordBatch]) -> list[bytes]:
    return [v for b in batches for v in b.column(1).to_pylist()]


_SPAN = np.dtype([("doc", "<i8"), ("t", "<i8"), ("u", "<i8"), ("a", "<u4"), ("b", "<u4")])
_NAME = ["doc", "t", "u"]


def _numbered(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different documents of the rows in their order, and the number of each row's document."""
    order = np.lexsort([rows[c] for c in reversed(_NAME)])
    new = _changes(*[rows[c][order] for c in _NAME])
    of = np.empty(len(rows), np.int64)
    of[order] = np.cumsum(new) - 1
    return rows[order[new]], of


def _spans(names: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of runs given by the number of their document and their place in one number each."""
    out = np.empty(len(a), _SPAN)
    for c in _NAME:
        out[c] = names[c][a >> 33]
    out["a"], out["b"] = a & ((1 << 33) - 1), b - (a >> 33 << 33)
    return out


def _united(rows: np.ndarray) -> np.ndarray:
    """Rows (doc, t, u, a, b) as maximal runs, in order."""
    if not len(rows):
        return rows
    names, of = _numbered(rows)
    start = (of << 33) + rows["a"]
    order = np.argsort(start, kind="stable")
    return _spans(names, *union_spans(start[order], ((of << 33) + rows["b"])[order]))


def _removals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, t, u, spans): every occurrence of a maximal repeat but the earliest."""
    blobs = _blobs(batches)
    if not blobs:
        return
    found: list[np.ndarray] = []
    size = united = 0
    for head, length, count, owner, place in _array_groups(blobs):
        names, of = _numbered(head)
        start = (of[owner] << 33) + place
        earliest = np.minimum.reduceat(start, np.cumsum(count) - count)
        later = start > np.repeat(earliest, count)
        # documents are numbered in their order, so one number orders occurrences; the runs of this slice alone are kept
        order = np.argsort(start[later], kind="stable")
        found.append(_spans(names, *union_spans(start[later][order], (start + np.repeat(length, count))[later][order])))
        size += len(found[-1])
        if size > 2 * united + _RUNS:  # the runs of neighbouring distances overlap
            found = [_united(np.concatenate(found))]
            size = united = len(found[0])
    rows = _united(np.concatenate(found)) if found else np.empty(0, _SPAN)
    if not len(rows):
        return
    cuts = _cuts(*[rows[c] for c in _NAME])
    both = np.stack([rows["a"], rows["b"]], axis=1)
    spans = [both[x:y].tobytes() for x, y in zip(cuts.tolist(), cuts[1:].tolist())]
    yield pa.RecordBatch.from_arrays(
        [*[pa.array(rows[c][cuts[:-1]]) for c in _NAME], pa.array(spans, pa.binary())], [*_NAME, "spans"]
    )


def _all_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blobs, before = _blobs(batches), 0
    for head, length, count, owner, place in _array_groups(blobs) if blobs else ():
        own = head[owner]
        name = pa.array(own["doc"].astype(np.int64), mask=own["doc"] == _NO_ID)
        repeat = np.repeat(np.arange(len(count)) + before, count)
        before += len(count)
        columns = [own["h"].view(np.int64), repeat, name, place, np.repeat(length, count)]
        yield pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns],
            ["anchor", "repeat", "doc_id", "start", "length"],
        )


def _close(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, 3, _BATCH):
            out = []
            for doc, t, u, packed, *lists in zip(*(b.column(k).to_pylist() for k in range(6))):
                text = unpack(packed)
                spans = np.frombuffer(b"".join([lists[0] or b"", *(lists[1] or [])]), "<u4").astype(np.int64).reshape(-1, 2)
                out.append(_finished((doc, t, u), text, *union_spans(spans[:, 0], spans[:, 1]), with_text))
            yield _result_batch(out, _array(b.column(6)))

    return run


def _with_rest(schema: str, rest: T.DataType) -> T.StructType:
    return T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField("rest", rest)])


def _compared(docs: DataFrame, id_column: str, text_column: str, with_text: bool, rest: Column | None = None) -> DataFrame:
    """Stored rows of three kinds: finished documents, documents with open anchors, surroundings of these.

    ``rest`` is a column of ``docs`` that finished and open documents carry along.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    more = F.lit(None).cast("int") if rest is None else rest
    doc_id, text = F.col(id_column).cast("bigint"), F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    carried = docs.select(doc_id.alias("doc_id"), text.alias("text"), more.alias("rest"))
    marks = text_marks(F.col("text"))
    if carried.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        # ids alone tell the rows apart that have one, and zeros travel for nothing
        marks = {n: F.when(F.col("doc_id").isNull(), m).otherwise(F.lit(0).cast("bigint")) for n, m in marks.items()}
    marked = {"doc_id": F.col("doc_id"), **marks, "text": F.col("text"), "rest": F.col("rest")}
    texts = carried.select(*[c.alias(n) for n, c in marked.items()])
    noted = (
        texts.drop("rest")
        .mapInArrow(_find_anchors(2 * parts), _SCHEMA)
        .repartition(parts, F.coalesce("bucket", F.hash("doc", "t", "u")))
        .mapInArrow(_compare_anchors, _SCHEMA)
        .groupBy("doc", "t", "u")
        .agg(F.collect_list("settled").alias("settled"), F.collect_list("fine").alias("fine"))
    )
    kind = texts.schema["rest"].dataType
    packed = texts.mapInArrow(_packed_texts, _with_rest("doc_id bigint, t bigint, u bigint, text binary", kind))
    keyed = packed.withColumn("doc", F.coalesce("doc_id", F.lit(_NO_ID)))
    joined = keyed.join(noted.hint("shuffle_hash"), _NAME, "left").select("doc_id", "t", "u", "text", "settled", "fine", "rest")
    finished = joined.mapInArrow(_apply_settled(2 * parts, with_text), _with_rest(_RESULT_SCHEMA, kind))
    return materialise(finished, "repeats", by="kind", compression="zstd").select(*_RESULT, "rest")


def _surroundings(compared: DataFrame) -> DataFrame:
    parts = partitions(compared.sparkSession)
    return compared.where(F.col("kind") == _CONTEXT).select("bucket", "blob").repartition(parts, "bucket")


def occurrences(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(anchor, repeat, doc_id, start, length): the maximal repeats around each anchor, with all occurrences.

    Surroundings that are equal as a whole are given once, at their earliest place; ``repeat`` numbers the repeats of a task.
    """
    compared = _compared(docs, id_column, text_column, False)
    schema = "anchor bigint, repeat bigint, doc_id bigint, start bigint, length bigint"
    return _surroundings(compared).mapInArrow(_all_occurrences, schema)


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_text: bool = False,
    rest: Column | None = None,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, rest): every row without repeated passages.

    ``kept`` is the text left if ``with_text`` is set, else null; of a letter cut in its bytes nothing is left there, while
    the numbers and the digest are those of the bytes. ``rest`` is a column of ``docs`` to pass on.
    """
    compared = _compared(docs, id_column, text_column, with_text, rest)
    removed = (
        _surroundings(compared)
        .mapInArrow(_removals, "doc bigint, t bigint, u bigint, spans binary")
        .groupBy(*_NAME)
        .agg(F.collect_list("spans").alias("more"))
    )
    is_open = compared.where(F.col("kind") == _OPEN).select(
        F.coalesce("doc", F.lit(_NO_ID)).alias("key"), "doc", "t", "u", "text", "spans", "rest"
    )
    closed = (
        is_open.join(removed.withColumnRenamed("doc", "key").hint("shuffle_hash"), ["key", "t", "u"], "left")
        .select("doc", "t", "u", "text", "spans", "more", "rest")
        .mapInArrow(_close(with_text), _with_rest(_RESULT_SCHEMA, compared.schema["rest"].dataType))
    )
    columns = [F.col("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.col("sha").alias("kept_sha256"), "kept", "rest"]
    return compared.where(F.col("kind") == _DONE).select(*columns).unionByName(closed.select(*columns))
