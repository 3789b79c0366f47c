"""Training of the classifier: dense ReLU layer, optional dropout, dense sigmoid layer.

Documents are dealt by a hash of their ids into ``params.shards`` shards, a setting that never follows the
data. An epoch has ``params.averages_per_epoch`` rounds. In a round every shard runs mini-batch Adam on the next
part of its own documents, starting from the current weights of the words it uses; the changes are then
averaged, weighted by documents. A shard takes its documents in the order of their ids and shuffles them by a seed, so
the weights do not depend on partitions or tasks.

Word weights and their two moments lie in chunks, rows of some thousand indices each, stored once per round. A round is one job: a chunk
sends each shard the words of its next documents, the shards train, the chunks average what comes back. A word that a shard
has, but not in this round's documents, only fades there: the chunk works that out itself, in closed form, as the shard
does for the steps between two uses of a word. The driver holds no more than the parts whose size is the number of neurons times
classes. ``params.max_rows`` bounds what a shard holds.
"""

from __future__ import annotations

import ctypes
import math
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.config import OOV_INDEX, TrainingParams
from lexmill.functions.weights import dot, relu, sigmoid
from lexmill.operators.features import lookup_words
from lexmill.operators.metrics import test_metrics
from lexmill.operators.network import EPSILON as LOSS_EPSILON
from lexmill.operators.network import network_table, predicted_class, with_scores
from lexmill.operators.vocabulary import index_width, within_limit
from lexmill.sources.workspace import computed_once, materialise, new_path, remove_folder, small_batches

# The optimiser's usual constants.
LEARNING_RATE = 0.001
BETA_1 = 0.9
BETA_2 = 0.999
ADAM_EPSILON = 1e-7

# Rows of a shard's result that hold no word: its metrics, and from the next index down the changes of
# the dense parts, cut into rows of the same width.
_METRICS_ROW = -1
_DENSE_ROWS = -2

# Fixed size: indices in a chunk of word weights.
_CHUNK_WORDS = 1 << 15
# The chunk of the rows that hold no word.
_SMALL = -1
# Fixed size: documents whose words are looked at together.
_SOME_DOCS = 1 << 10

# A word without gradient moves by a sum over the steps: rate * m * b1^i / (sqrt(v) * q^i + eps), with q = sqrt(b2). With
# w = sqrt(v) / (sqrt(v) + eps) that is m / (sqrt(v) + eps) times a power series in w, w <= 1, whose coefficients are sums of
# rate * b1^i * (1 - q^i)^k. Fixed sizes: after so many terms what is left out is below 1e-14 of the sum, after so many steps below 1e-17.
_TERMS = 8
_REACH = 400


def _state_columns(neurons: int) -> list[str]:
    """Weights, then first and second moments."""
    return [f"{part}{j}" for part in ("w", "m", "v") for j in range(neurons)]


def _change_columns(neurons: int) -> list[str]:
    return [f"d{j}" for j in range(3 * neurons)]


@dataclass(frozen=True)
class DenseParts:
    """Everything but the word weights, with Adam's moments: arrays of neurons x classes at most."""

    neurons: int
    classes: int
    values: np.ndarray  # 3 x size: value, first and second moment
    steps: int = 0

    @property
    def hidden_bias(self) -> np.ndarray:
        return self.values[0, : self.neurons]

    @property
    def output_weights(self) -> np.ndarray:
        h, k = self.neurons, self.classes
        return self.values[0, h : h + h * k].reshape(h, k)

    @property
    def output_bias(self) -> np.ndarray:
        return self.values[0, self.neurons * (1 + self.classes) :]

    def moved(self, delta: np.ndarray, steps: int) -> "DenseParts":
        return DenseParts(self.neurons, self.classes, self.values + delta.reshape(self.values.shape), steps)

    def table(self, df: DataFrame) -> DataFrame:
        return network_table(df.sparkSession, self.hidden_bias, self.output_weights.T, self.output_bias)


def initial_dense(neurons: int, classes: int, seed: int) -> DenseParts:
    limit = math.sqrt(6 / (neurons + classes))
    weights = np.random.default_rng(seed).uniform(-limit, limit, neurons * classes)
    values = np.zeros((3, neurons * (1 + classes) + classes))
    values[0, neurons : neurons * (1 + classes)] = weights
    return DenseParts(neurons, classes, values)


def initial_weights(indices: DataFrame, width: int, neurons: int, seed: int) -> DataFrame:
    """Uniform starting weights drawn from a hash of seed, index and neuron, and zero moments."""
    limit = math.sqrt(6 / (width + neurons))
    steps = 1 << 24

    def weight(j: int) -> Column:
        draw = F.pmod(F.xxhash64(F.lit(seed), F.col("idx"), F.lit(j)), F.lit(steps)) / steps
        return (draw * 2 - 1) * limit

    columns = _state_columns(neurons)
    values = [weight(j) for j in range(neurons)] + [F.lit(0.0)] * (2 * neurons)
    return indices.select("idx", *[v.alias(c) for c, v in zip(columns, values)])


def _rate(step: int) -> float:
    return LEARNING_RATE * math.sqrt(1 - BETA_2**step) / (1 - BETA_1**step)


def _fading() -> np.ndarray:
    """What a step that lies 1, 2, .. steps back adds to the coefficients of the power series, but for its rate."""
    i, k = np.arange(1, _REACH + 1)[:, None], np.arange(_TERMS)
    return BETA_1**i * (-np.expm1(i * (math.log(BETA_2) / 2))) ** k


def _fade(values: np.ndarray, coefficients: np.ndarray, fade_1: np.ndarray | float, fade_2: np.ndarray | float) -> None:
    """Take (3, ..) value and moments over steps without gradient, in place."""
    value, first, second = values
    root = np.sqrt(second)
    bound = root + ADAM_EPSILON
    root /= bound
    total = np.zeros_like(root)
    for c in coefficients[::-1]:
        total *= root
        total += c
    total *= first
    total /= bound
    value -= total
    first *= fade_1
    second *= fade_2


def _faded(values: np.ndarray, before: int, after: int) -> np.ndarray:
    """(3, ..) value and moments, all of step ``before``, at step ``after`` if no document in between has the word."""
    fading, n = _fading(), after - before
    coefficients = sum((_rate(before + i) * fading[i - 1] for i in range(1, min(n, _REACH) + 1)), np.zeros(_TERMS))
    out = values.copy()
    _fade(out, coefficients, BETA_1**n, BETA_2**n)
    return out


@dataclass(frozen=True)
class _Documents:
    """Documents in flat arrays: class, first word and number of words of each, then every word's column and weight."""

    targets: np.ndarray
    begin: np.ndarray
    length: np.ndarray
    column: np.ndarray
    value: np.ndarray

    def words_of(self, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every word of some documents: which of them it belongs to, and its place."""
        lengths = self.length[batch]
        member = np.repeat(np.arange(len(batch)), lengths)
        return member, np.arange(len(member)) + np.repeat(self.begin[batch] - np.cumsum(lengths) + lengths, lengths)


def _order(n: int, seed: int, epoch: int, shard: int, turn: int, turns: int) -> np.ndarray:
    """The documents of one round, in the order they are taken."""
    order = np.random.default_rng([seed, epoch, shard]).permutation(n)
    return order[n * (turn - 1) // turns : n * turn // turns]


def _train_part(
    docs: _Documents,
    order: np.ndarray,
    columns: np.ndarray | None,
    state: np.ndarray,
    small: np.ndarray,
    classes: int,
    steps_before: int,
    params: TrainingParams,
    rng: np.random.Generator,
) -> tuple[float, int, int]:
    """Mini-batch Adam over the documents ``order``, in place; the loss, the hits and the last step.

    ``state`` is (words, 3, neurons), ``columns`` the place in it of a document's column. Between two uses a word is left as it
    is: what the steps without gradient do to it is added when it is used again, and in the end for all.
    """
    h, k, size = small.shape[1] - classes, classes, params.batch_size
    h //= k + 1
    dropout = params.dropout_rate if params.use_dropout else 0.0
    b1, w2, b2 = small[0, :h], small[0, h : h + h * k].reshape(h, k), small[0, h + h * k :]
    room = np.empty_like(small[0])
    n_steps = -(-len(order) // size)
    fading, since = _fading(), np.zeros((n_steps + 1, _TERMS))
    fade_1, fade_2 = BETA_1 ** np.arange(n_steps + 1), BETA_2 ** np.arange(n_steps + 1)
    last, slot = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    loss, hits = 0.0, 0
    for t, at in enumerate(range(0, len(order), size), 1):
        batch = order[at : at + size]
        member, posting = docs.words_of(batch)
        cols, vals = docs.column[posting], docs.value[posting]
        if columns is not None:
            cols = columns[cols]
        # one place for each different word
        own = np.arange(len(cols))
        slot[cols] = own
        touched = cols[slot[cols] == own]
        slot[touched] = np.arange(len(touched))
        place = slot[cols]
        words = np.ascontiguousarray(state[touched].transpose(1, 2, 0))
        gap = t - 1 - last[touched]
        _fade(words, np.ascontiguousarray(since[last[touched]].T), fade_1[gap], fade_2[gap])

        z = np.stack([np.bincount(member, vals * words[0, j][place], minlength=len(batch)) for j in range(h)], axis=1) + b1
        kept = (rng.random(z.shape) >= dropout) / (1 - dropout)
        hidden = np.maximum(z, 0.0) * kept
        log_p = -np.logaddexp(0.0, -(hidden @ w2 + b2))
        share = np.exp(log_p - np.logaddexp.reduce(log_p, axis=1, keepdims=True))
        true_class = docs.targets[batch]
        true_share = share[np.arange(len(batch)), true_class]
        loss -= float(np.log(np.clip(true_share, LOSS_EPSILON, 1 - LOSS_EPSILON)).sum())
        hits += int((log_p.argmax(axis=1) == true_class).sum())

        # a share the loss clips has no slope
        clipped = (true_share < LOSS_EPSILON) | (true_share > 1 - LOSS_EPSILON)
        share[np.arange(len(batch)), true_class] -= 1
        d_out = share * -np.expm1(log_p) * ~clipped[:, None] / len(batch)
        d_hidden = (d_out @ w2.T) * kept * (z > 0)
        g_small = np.concatenate([d_hidden.sum(axis=0), (hidden.T @ d_out).ravel(), d_out.sum(axis=0)])
        g_words = np.stack([np.bincount(place, vals * d_hidden[:, j][member], minlength=len(touched)) for j in range(h)])
        rate = _rate(steps_before + t)
        for (value, first, second), gradient in ((small, g_small), (words, g_words)):
            first *= BETA_1
            first += (1 - BETA_1) * gradient
            second *= BETA_2
            second += (1 - BETA_2) * gradient * gradient
            moved = np.sqrt(second, out=room if value is small[0] else None)
            moved += ADAM_EPSILON
            np.divide(first, moved, out=moved)
            moved *= rate
            value -= moved
        state[touched] = words.transpose(2, 0, 1)
        last[touched] = t
        back = min(t, _REACH)
        since[t - back : t] += rate * fading[:back][::-1]
    for at in range(0, len(state), _CHUNK_WORDS):
        some = slice(at, at + _CHUNK_WORDS)
        words = np.ascontiguousarray(state[some].transpose(1, 2, 0))
        gap = n_steps - last[some]
        _fade(words, np.ascontiguousarray(since[last[some]].T), fade_1[gap], fade_2[gap])
        state[some] = words.transpose(2, 0, 1)
    return loss, hits, steps_before + n_steps


def _shard_step(dense: DenseParts, params: TrainingParams, epoch: int, turn: int) -> Callable:
    """The function that trains one shard for one round of an epoch, on plain rows: documents with lists, and a row per word.

    The rounds of ``train_network`` do the same on packed documents and words, see ``_round``.
    """
    h, width = dense.neurons, 3 * dense.neurons

    def flat(lists: pa.ChunkedArray, kind: type) -> np.ndarray:
        """The elements of all lists; those of one chunk as they lie."""
        parts = [c.flatten().to_numpy().astype(kind, copy=False) for c in lists.chunks]
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, kind), *parts])

    def train_shard(key: tuple, docs: pa.Table, words: pa.Table) -> pa.Table:
        shard, n = key[0].as_py(), docs.num_rows
        by_id = pc.sort_indices(docs["doc_id"]).to_numpy()
        length = pc.list_value_length(docs["idx"]).to_numpy().astype(np.int64)
        begin = np.cumsum(length) - length
        words = words.take(pc.sort_indices(words["idx"])) if words.num_rows else words
        indices = words["idx"].to_numpy()
        column = np.searchsorted(indices, flat(docs["idx"], np.int32)).astype(np.int32)
        targets = docs["label_idx"].to_numpy().astype(np.int64)
        held = _Documents(targets[by_id], begin[by_id], length[by_id], column, flat(docs["tfidf"], np.float64))
        state = np.empty((len(indices), 3, h))
        for c, name in enumerate(_state_columns(h)):
            state[:, c // h, c % h] = words[name].to_numpy()
        small = dense.values.copy()
        order = _order(n, params.seed, epoch, shard, turn, params.averages_per_epoch)
        rng = np.random.default_rng([params.seed, epoch, shard, turn])
        loss, hits, step = _train_part(held, order, None, state, small, dense.classes, dense.steps, params, rng)

        dense_change = (small - dense.values).ravel()
        dense_rows = np.zeros((-(-len(dense_change) // width), width))
        dense_rows.ravel()[: len(dense_change)] = dense_change
        metrics = np.zeros((1, width))
        metrics[0, :3] = loss, hits, step
        first = np.concatenate([metrics, dense_rows])
        idx = np.concatenate([[_METRICS_ROW], _DENSE_ROWS - np.arange(len(dense_rows)), indices]).astype(np.int64)
        changes = [
            np.concatenate([first[:, c], state[:, c // h, c % h] - words[name].to_numpy()]) for c, name in enumerate(_state_columns(h))
        ]
        return pa.table([idx, np.full(len(idx), n), *changes], names=["idx", "docs", *_change_columns(h)])

    return train_shard


def _shard_of(n_shards: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(n_shards)).cast("int")


def _partitions_for(spark: SparkSession, n_shards: int) -> int:
    """The least number of partitions in which shards meet least: a round lasts as long as the task with most shards."""
    shards = spark.range(n_shards).select(F.hash(F.col("id").cast("int")).alias("h")).collect()
    return min(range(n_shards, 8 * n_shards + 1), key=lambda n: (max(Counter(r["h"] % n for r in shards).values()), n))


# The C library's number for the size from which memory is a mapping of its own, and that size.
_M_MMAP_THRESHOLD, _MAPPED_BYTES = -3, 1 << 20


def _lean() -> None:
    """Python workers stay, and several take turns: what one held for a shard or a chunk goes back to the system once it is free."""
    with suppress(AttributeError, OSError):  # another C library
        libc = ctypes.CDLL(None)
        libc.mallopt(_M_MMAP_THRESHOLD, _MAPPED_BYTES)
        libc.malloc_trim(0)
    pa.default_memory_pool().release_unused()


def _bytes(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The numbers in all binary values of a column, one after the other."""
    parts = [np.frombuffer(v.as_buffer(), kind) for v in column if v.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _fragments(keys: list[str]) -> Callable:
    """Rows (keys, idx, tfidf) of a batch as a row for each document they belong to, its words in order and packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc = pc.dictionary_encode(b["doc_id"], null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
            label = b["label_idx"].to_numpy(zero_copy_only=False).astype(np.int64)
            real = pc.is_valid(b["idx"]).to_numpy(zero_copy_only=False)
            idx = b["idx"].fill_null(0).to_numpy().astype(np.int32)
            split = pc.dictionary_encode(b["split"], null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.lexsort((idx, label, doc, split))
            new = np.r_[True, (np.diff([x[order] for x in (split, doc, label)]) != 0).any(axis=0)][: len(order)]
            kept = order[real[order]]
            ends = np.r_[np.add.reduceat(real[order].astype(np.int64), np.flatnonzero(new)), 0][:-1].cumsum() if len(order) else np.zeros(0, np.int64)
            bounds = np.r_[0, ends]
            packed = [
                pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer((bounds * x.itemsize).astype(np.int32)), pa.py_buffer(x)])
                for x in (np.ascontiguousarray(idx[kept]), np.ascontiguousarray(b["tfidf"].fill_null(0.0).to_numpy()[kept]))
            ]
            leading = b.select(keys).take(pa.array(order[new]))
            yield pa.RecordBatch.from_arrays([*leading.columns, *packed], [*keys, "idx", "tfidf"])
        _lean()

    return run


@contextmanager
def _buckets(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """A function that stores a frame at a path, in buckets by a column: what is grouped by that column is not exchanged when it is read.

    Spark knows buckets by a table's name. The names are dropped in the end; the files stay, and can be read without them.
    """
    names = []

    def store(df: DataFrame, path: str, n: int, by: str, compression: str, split_by: str | None = None) -> DataFrame:
        names.append(f"lexmill_{uuid.uuid4().hex}")
        writer = df.write.format("parquet").option("path", path).option("compression", compression).bucketBy(n, by)
        (writer.partitionBy(split_by) if split_by else writer).saveAsTable(names[-1])
        return spark.table(names[-1])

    try:
        yield store
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def dealt_rows(features: DataFrame, n_shards: int, path: str, store: Callable[..., DataFrame]) -> DataFrame:
    """``(doc_id, split, label_idx, idx, tfidf)`` stored where each shard is trained, a row for a document: no round exchanges documents again.

    Documents are put together within their task, so the exchange holds a row for each, or for each piece of one that batches cut.
    """
    spark = features.sparkSession
    small_batches(spark)
    parts = _partitions_for(spark, n_shards)
    keys = ["split", "shard", "doc_id", "label_idx"]
    sharded = features.select("split", _shard_of(n_shards).alias("shard"), "doc_id", F.col("label_idx").cast("bigint").alias("label_idx"), "idx", "tfidf")
    schema = sharded.select(*keys, F.lit(b"").alias("idx"), F.lit(b"").alias("tfidf")).schema
    pieces = sharded.mapInArrow(_fragments(keys), schema).repartition(parts, F.col("shard"))
    return store(pieces, path, parts, "shard", "zstd", "split")


def _flat(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The numbers packed in the values of a column without nulls, one after the other."""
    size, parts = np.dtype(kind).itemsize, [np.zeros(0, kind)]
    for c in column.chunks:
        ends = np.frombuffer(c.buffers()[1], np.int32, len(c) + 1, 4 * c.offset) if len(c) else np.zeros(1, np.int32)
        if ends[-1] > ends[0]:
            parts.append(np.frombuffer(c.buffers()[2], kind, (ends[-1] - ends[0]) // size, ends[0]))
    return parts[1] if len(parts) == 2 else np.concatenate(parts)


def _documents(rows: pa.Table, chunks: int) -> tuple[np.ndarray, _Documents]:
    """A shard's words, by chunk and index, and its documents in the order of their ids."""
    idx, value = _flat(rows["idx"], np.int32), _flat(rows["tfidf"], np.float64)
    length = pc.binary_length(rows["idx"]).to_numpy().astype(np.int64) // idx.itemsize
    begin = np.cumsum(length) - length
    ids = rows.select(["doc_id", "label_idx"]).combine_chunks()
    order = pc.sort_indices(ids, sort_keys=[("doc_id", "ascending"), ("label_idx", "ascending")]).to_numpy()
    begin, length, label = begin[order], length[order], ids["label_idx"].to_numpy()[order]
    code = pc.dictionary_encode(ids["doc_id"].combine_chunks(), null_encoding="encode").indices.to_numpy(zero_copy_only=False)[order]
    new = np.r_[True, (np.diff(code) != 0) | (np.diff(label) != 0)]
    if not new.all():  # documents in several pieces are put together behind the others, their words in order however they were cut
        doc = np.cumsum(new) - 1
        cut = np.flatnonzero(np.bincount(doc)[doc] > 1)
        member, posting = _Documents(label, begin, length, idx, value).words_of(cut)
        posting = posting[np.lexsort((value[posting], idx[posting], doc[cut][member]))]
        whole = np.bincount(doc, length).astype(np.int64)
        joined = np.unique(doc[cut])
        begin, length = begin[new], whole
        begin[joined] = len(idx) + np.cumsum(whole[joined]) - whole[joined]
        idx, value = np.concatenate([idx, idx[posting]]), np.concatenate([value, value[posting]])
    present = np.zeros(int(idx.max(initial=0)) + 1, bool)
    present[idx] = True
    words = np.flatnonzero(present)
    words = words[np.argsort(words % chunks, kind="stable")]
    column_of = np.zeros(len(present), np.int32)
    column_of[words] = np.arange(len(words))
    return words, _Documents(label[new], begin, length, column_of[idx], value)


def _by_chunk(words: np.ndarray, chunks: int) -> list[tuple[int, int, int]]:
    """(chunk, from, to) for the chunks in which a shard has words."""
    ends = np.cumsum(np.bincount(words % chunks, minlength=chunks))
    return [(c, int(ends[c - 1]) if c else 0, int(ends[c])) for c in range(chunks) if ends[c] > (ends[c - 1] if c else 0)]


def _used(docs: _Documents, n_words: int, order: np.ndarray) -> np.ndarray:
    """The columns that the documents ``order`` use, by number."""
    flags = np.zeros(n_words, bool)
    for at in range(0, len(order), _SOME_DOCS):
        flags[docs.column[docs.words_of(order[at : at + _SOME_DOCS])[1]]] = True
    return np.flatnonzero(flags)


def _in_chunk(columns: np.ndarray, begin: int, end: int) -> np.ndarray:
    a, b = np.searchsorted(columns, [begin, end])
    return columns[a:b] - begin


# What shards send to chunks: their words' values, and which of their words they need next. ``members`` is sent once, before the first round.
_SENT_SCHEMA = "chunk int, shard int, docs bigint, steps bigint, members binary, vals binary, next binary"
# A chunk: its indices, their weights and moments, and for each shard the places of its words and of those it uses next.
_CHUNK_SCHEMA = "chunk int, idx binary, w binary, m binary, v binary, shards array<int>, members array<binary>, needs array<binary>"
_FETCHED_SCHEMA = "shard int, chunk int, vals binary"


def _sent(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = ["chunk", "shard", "docs", "steps", "members", "vals", "next"]
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _announce(params: TrainingParams, chunks: int) -> Callable:
    """What a shard tells the chunks before the first round: its words, and those of its first documents."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        _lean()
        words, docs = _documents(rows, chunks)
        n, shard = len(docs.length), key[0].as_py()
        used = _used(docs, len(words), _order(n, params.seed, 1, shard, 1, params.averages_per_epoch))
        return _sent([(c, shard, n, 0, _bytes(words[a:b]), None, _bytes(_in_chunk(used, a, b).astype(np.int32))) for c, a, b in _by_chunk(words, chunks)])

    return run


def _chunk_row(chunk: int, idx: bytes, values: np.ndarray, shards: list[int], members: list[bytes], needs: list[bytes]) -> pa.Table:
    columns = [
        pa.array([chunk], pa.int32()), *[pa.array([x], pa.binary()) for x in (idx, *map(_bytes, values))],
        pa.array([shards], pa.list_(pa.int32())), pa.array([members], pa.list_(pa.binary())), pa.array([needs], pa.list_(pa.binary())),
    ]
    return pa.table(columns, names=["chunk", "idx", "w", "m", "v", "shards", "members", "needs"])


def _first_chunk(neurons: int) -> Callable:
    """A chunk from the rows of its words and what the shards announced."""

    def run(key: tuple, words: pa.Table, sent: pa.Table) -> pa.Table:
        words, sent = words.take(pc.sort_indices(words["idx"])), sent.take(pc.sort_indices(sent["shard"]))
        idx = words["idx"].to_numpy()
        values = np.stack([words[c].to_numpy() for c in _state_columns(neurons)], axis=1).reshape(len(idx), 3, neurons)
        members = [np.searchsorted(idx, np.frombuffer(m.as_buffer(), np.int64)).astype(np.int32) for m in sent["members"]]
        needs = [m[np.frombuffer(x.as_buffer(), np.int32)] for m, x in zip(members, sent["next"], strict=True)]
        parts = values.transpose(1, 0, 2)
        return _chunk_row(key[0].as_py(), _bytes(idx), parts, sent["shard"].to_pylist(), list(map(_bytes, members)), list(map(_bytes, needs)))

    return run


def _values(row: dict, neurons: int) -> np.ndarray:
    """A chunk's (3, words, neurons) weights and moments."""
    return np.stack([np.frombuffer(row[c], np.float64).reshape(-1, neurons) for c in ("w", "m", "v")])


def _send(neurons: int) -> Callable:
    """The values of the words that each shard needs from a chunk, as (words, 3, neurons)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                values = _values(row, neurons).transpose(1, 0, 2)
                for shard, needs in zip(row["shards"], row["needs"], strict=True):
                    vals = _bytes(values[np.frombuffer(needs, np.int32)])
                    columns = [pa.array([shard], pa.int32()), pa.array([row["chunk"]], pa.int32()), pa.array([vals], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "chunk", "vals"])
        _lean()

    return run


def _round(dense: DenseParts, params: TrainingParams, chunks: int, epoch: int, turn: int) -> Callable:
    """The function that trains one shard for one round, from its documents and the values its words have in the chunks."""
    h, turns = dense.neurons, params.averages_per_epoch
    following = (epoch, turn + 1) if turn < turns else (epoch + 1, 1)

    def run(key: tuple, rows: pa.Table, fetched: pa.Table) -> pa.Table:
        _lean()
        shard = key[0].as_py()
        words, docs = _documents(rows, chunks)
        n = len(docs.length)
        order = _order(n, params.seed, epoch, shard, turn, turns)
        used = _used(docs, len(words), order)
        state = _joined(fetched.take(pc.sort_indices(fetched["chunk"]))["vals"], np.float64).reshape(-1, 3, h)
        del fetched
        if len(state) != len(used):
            raise RuntimeError(f"shard {shard} needs {len(used)} words and got {len(state)}")
        place = np.zeros(len(words), np.int32)
        place[used] = np.arange(len(used))
        small = dense.values.copy()
        rng = np.random.default_rng([params.seed, epoch, shard, turn])
        loss, hits, step = _train_part(docs, order, place, state, small, dense.classes, dense.steps, params, rng)
        out = [(_SMALL, shard, n, step, None, _bytes(np.r_[loss, hits, (small - dense.values).ravel()]), None)]
        later = _used(docs, len(words), _order(n, params.seed, following[0], shard, following[1], turns)) if following[0] <= params.epochs else used[:0]
        for c, a, b in _by_chunk(words, chunks):
            mine = slice(*np.searchsorted(used, [a, b]))
            out.append((c, shard, n, step, None, _bytes(state[mine]), _bytes(_in_chunk(later, a, b).astype(np.int32))))
        return _sent(out)

    return run


def _averaged(dense: DenseParts, n_docs: int) -> Callable:
    """A chunk after a round: each shard's changes weighted by its documents. A shard without the word changed nothing; where it was not
    used in the round it faded. What the shards' rows hold besides words is added up in a row of its own.
    """
    h, before = dense.neurons, dense.steps

    def run(key: tuple, sent: pa.Table, chunk: pa.Table) -> pa.Table:
        _lean()
        sent = sent.take(pc.sort_indices(sent["shard"])).to_pylist() if sent.num_rows else []
        if key[0].as_py() == _SMALL:
            all_rows = [np.frombuffer(r["vals"], np.float64) for r in sent]
            change = sum(r["docs"] / n_docs * x[2:] for r, x in zip(sent, all_rows, strict=True))
            totals = np.r_[sum(x[:2] for x in all_rows), max(r["steps"] for r in sent), change]
            return _chunk_row(_SMALL, b"", [totals, totals[:0], totals[:0]], [], [], [])
        row = chunk.to_pylist()[0]
        old = _values(row, h)
        new = old.copy()
        by_shard = {s: (m, x) for s, m, x in zip(row["shards"], row["members"], row["needs"], strict=True)}
        faded: dict[int, np.ndarray] = {}
        needs = []
        for r in sent:
            members, used = [np.frombuffer(x, np.int32) for x in by_shard[r["shard"]]]
            if r["steps"] not in faded:
                faded[r["steps"]] = _faded(old, before, r["steps"])
            at_rest, share = faded[r["steps"]], r["docs"] / n_docs
            new[:, members] += share * (at_rest[:, members] - old[:, members])
            new[:, used] += share * (np.frombuffer(r["vals"], np.float64).reshape(-1, 3, h).transpose(1, 0, 2) - at_rest[:, used])
            needs.append(_bytes(members[np.frombuffer(r["next"], np.int32)]))
        return _chunk_row(row["chunk"], row["idx"], new, row["shards"], row["members"], needs)

    return run


def _weights(neurons: int) -> Callable:
    """A row for each index of a chunk, with its weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                idx, w = np.frombuffer(row["idx"], np.int64), np.frombuffer(row["w"], np.float64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(w) + 1, neurons, dtype=np.int32)), pa.array(w))
                yield pa.RecordBatch.from_arrays([pa.array(idx), lists], ["idx", "weights"])

    return run


@dataclass(frozen=True)
class HeldRows:
    """Rows to evaluate, dealt out by shard, and the words of each shard by chunk, found once for all evaluations."""

    rows: DataFrame
    words: DataFrame
    chunks: int

    def free(self) -> None:
        self.words.unpersist()


def _words_by_chunk(chunks: int) -> Callable:
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        words, _ = _documents(rows, chunks)
        out = [(c, _bytes(words[a:b])) for c, a, b in _by_chunk(words, chunks)]
        columns = [pa.array([r[i] for r in out], k) for i, k in enumerate((pa.int32(), pa.binary()))]
        return pa.table([columns[0], pa.array([key[0].as_py()] * len(out), pa.int32()), columns[1]], names=["chunk", "shard", "words"])

    return run


def held_rows(dealt: DataFrame, split: str, chunks: int) -> HeldRows:
    """The rows of one split of ``dealt_rows``, made ready for ``evaluate_weights``."""
    kept = dealt.where(F.col("split") == split).drop("split")
    words = kept.groupBy("shard").applyInArrow(_words_by_chunk(chunks), "chunk int, shard int, words binary")
    return HeldRows(kept, words.persist(StorageLevel.MEMORY_AND_DISK), chunks)


def _found_weights(neurons: int) -> Callable:
    """The weights of each shard's words, from their chunk."""

    def run(key: tuple, words: pa.Table, chunk: pa.Table) -> pa.Table:
        row = chunk.to_pylist()[0]
        idx, w = np.frombuffer(row["idx"], np.int64), np.frombuffer(row["w"], np.float64).reshape(-1, neurons)
        out = []
        for wanted in (np.frombuffer(x.as_buffer(), np.int64) for x in words["words"]):
            at = np.minimum(np.searchsorted(idx, wanted), len(idx) - 1)
            out.append(_bytes(np.where((idx[at] == wanted)[:, None], w[at], 0.0)))
        chunk_of = pa.array([row["chunk"]] * len(out), pa.int32())
        return pa.table([words["shard"].combine_chunks(), chunk_of, pa.array(out, pa.binary())], names=["shard", "chunk", "vals"])

    return run


def _document_sums(neurons: int, chunks: int) -> Callable:
    """Each document's weighted sum for every neuron."""

    def run(key: tuple, rows: pa.Table, fetched: pa.Table) -> pa.Table:
        _lean()
        _, docs = _documents(rows, chunks)
        w = _joined(fetched.take(pc.sort_indices(fetched["chunk"]))["vals"], np.float64).reshape(-1, neurons)
        sums = [np.zeros((0, neurons))]
        for at in range(0, len(docs.length), _SOME_DOCS):
            some = np.arange(at, min(at + _SOME_DOCS, len(docs.length)))
            member, posting = docs.words_of(some)
            cols, vals = docs.column[posting], docs.value[posting]
            sums.append(np.stack([np.bincount(member, vals * w[:, j][cols], minlength=len(some)) for j in range(neurons)], axis=1))
        z = np.concatenate(sums)
        return pa.table([docs.targets, *[np.ascontiguousarray(z[:, j]) for j in range(neurons)]], names=["target_idx", *[f"z{j}" for j in range(neurons)]])

    return run


def evaluate_weights(held: HeldRows, state: DataFrame, network: DataFrame, neurons: int) -> DataFrame:
    """Loss and accuracy of held rows at the weights of the chunks ``state``.

    Each shard's words are fetched once, packed; its documents' sums are then worked out where they lie.
    """
    weights = state.where(F.col("chunk") >= 0).select("chunk", "idx", "w")
    fetched = held.words.groupBy("chunk").cogroup(weights.groupBy("chunk")).applyInArrow(_found_weights(neurons), _FETCHED_SCHEMA)
    schema = "target_idx bigint, " + ", ".join(f"z{j} double" for j in range(neurons))
    sums = held.rows.groupBy("shard").cogroup(fetched.groupBy("shard")).applyInArrow(_document_sums(neurons, held.chunks), schema)
    scored = with_scores(sums, [F.col(f"z{j}") for j in range(neurons)], network).withColumn("label_idx", predicted_class(F.col("scores")))
    return test_metrics(scored)


def full_gradient(rows: DataFrame, hidden: DataFrame, network: DataFrame, n_docs: int, neurons: int) -> DataFrame:
    """``(part, idx, neuron, gradient)``: slope of the mean loss over all rows ``(doc_id, label_idx, idx, tfidf)``.

    ``part`` is ``word`` (one row per index and neuron), ``hidden_bias``, ``output_weight`` (``idx`` is the class) or
    ``output_bias`` (``neuron`` is null). Plain joins and sums, so it runs on any number of documents: a
    document's slopes are worked out from its sums and joined back to its rows.
    """
    j_range = range(neurons)
    parts = network.select(F.struct("hidden_bias", "output_weights", "output_bias")).scalar()
    weighted = lookup_words(rows, hidden, ["weights"], on="idx")
    sums = weighted.groupBy("doc_id", "label_idx").agg(
        F.array(*[F.coalesce(F.sum(F.col("tfidf") * F.get("weights", F.lit(j))), F.lit(0.0)) for j in j_range]).alias("sums")
    )
    z = F.zip_with("sums", "hidden_bias", lambda s, b: s + b)
    known = sums.withColumn("_network", parts).select("doc_id", "label_idx", "sums", "_network.*")
    scored = computed_once(computed_once(known, "z", z), "h", F.transform("z", relu))
    scored = computed_once(
        scored,
        "p",
        F.transform(F.arrays_zip("output_weights", "output_bias"), lambda o: sigmoid(o["output_bias"] + dot(F.col("h"), o["output_weights"]))),
    )
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    true_share = F.get("p", F.col("label_idx").cast("int")) / F.col("total")
    slope = F.transform(
        "p",
        lambda p, k: (p / F.col("total") - F.when(k == F.col("label_idx"), 1.0).otherwise(0.0)) * (1 - p) * F.col("open") / n_docs,
    )
    scored = computed_once(computed_once(scored, "total", total), "true_share", true_share)
    inside = (F.col("true_share") >= LOSS_EPSILON) & (F.col("true_share") <= 1 - LOSS_EPSILON)
    scored = computed_once(scored.withColumn("open", inside.cast("double")), "d_out", slope)

    def back(j: int) -> Column:
        through = F.aggregate(
            F.zip_with("d_out", "output_weights", lambda d, w: d * F.get(w, F.lit(j))), F.lit(0.0), lambda a, x: a + x
        )
        return F.when(F.get("z", F.lit(j)) > 0, through).otherwise(0.0)

    slopes = materialise(
        scored.select("doc_id", "h", "d_out", F.array(*[back(j) for j in j_range]).alias("d_hidden")), "slopes"
    )
    none = F.lit(None).cast("bigint")
    by_word = (
        rows.where(F.col("idx").isNotNull())
        .join(slopes.select("doc_id", "d_hidden"), "doc_id")
        .groupBy("idx")
        .agg(*[F.sum(F.col("tfidf") * F.get("d_hidden", F.lit(j))).alias(f"g{j}") for j in j_range])
        .select("idx", F.posexplode(F.array(*[f"g{j}" for j in j_range])).alias("neuron", "gradient"))
        .select(F.lit("word").alias("part"), "idx", "neuron", "gradient")
    )
    biases = slopes.select(F.lit("hidden_bias").alias("part"), none.alias("idx"), F.posexplode("d_hidden").alias("neuron", "gradient"))
    classes = slopes.select("h", F.posexplode("d_out").alias("idx", "slope"))
    outputs = classes.select(F.lit("output_weight").alias("part"), "idx", F.posexplode("h").alias("neuron", "value"), "slope").select(
        "part", "idx", "neuron", (F.col("value") * F.col("slope")).alias("gradient")
    )
    output_biases = classes.select(
        F.lit("output_bias").alias("part"), "idx", F.lit(None).cast("int").alias("neuron"), F.col("slope").alias("gradient")
    )
    dense = biases.unionByName(outputs).unionByName(output_biases)
    summed = dense.groupBy("part", "idx", "neuron").agg(F.sum("gradient").alias("gradient"))
    return by_word.unionByName(summed).select(
        "part", F.col("idx").cast("bigint").alias("idx"), F.col("neuron").cast("bigint").alias("neuron"), "gradient"
    )


def first_adam_step(gradient: Column) -> Column:
    """What the optimiser's first step adds to a parameter."""
    first, second = (1 - BETA_1) * gradient, (1 - BETA_2) * gradient * gradient
    rate = LEARNING_RATE * math.sqrt(1 - BETA_2) / (1 - BETA_1)
    return -rate * first / (F.sqrt(second) + ADAM_EPSILON)


@dataclass(frozen=True)
class Fitted:
    hidden: DataFrame
    network: DataFrame
    history: DataFrame
    test_loss: float
    test_accuracy: float


def train_network(
    features: DataFrame,
    vocab: DataFrame,
    n_words: int,
    n_classes: int,
    n_docs: int,
    params: TrainingParams,
    folder: str | None = None,
) -> Fitted:
    """Fit on ``features(doc_id, split, label_idx, idx, tfidf)``, which are read once.

    A document without tokens has one row whose ``idx`` is null. ``n_docs`` is the number of
    training documents. ``folder`` receives the documents by shard, and the chunks of word weights; a round's are removed when the next
    one's are stored.
    """
    base = folder or new_path(features.sparkSession, "training")
    with _buckets(features.sparkSession) as store:
        dealt = dealt_rows(features, params.shards, f"{base}/documents", store)
        return _trained(dealt, vocab, n_words, n_classes, n_docs, params, base, store)


def _trained(
    dealt: DataFrame, vocab: DataFrame, n_words: int, n_classes: int, n_docs: int, params: TrainingParams, base: str, store: Callable[..., DataFrame]
) -> Fitted:
    spark = dealt.sparkSession
    h = params.neurons
    width = index_width(n_words, params.num_words)
    chunks = -(-width // _CHUNK_WORDS)
    train = dealt.where(F.col("split") == "train").drop("split")
    checked = held_rows(dealt, "validation", chunks)

    oov = spark.range(1).select(F.lit(OOV_INDEX).cast("bigint").alias("idx"))
    indices = within_limit(vocab, params.num_words).select("idx").unionByName(oov)
    start = initial_weights(indices, width, h, params.seed).withColumn("chunk", F.pmod("idx", F.lit(chunks)).cast("int"))
    announced = train.groupBy("shard").applyInArrow(_announce(params, chunks), _SENT_SCHEMA)

    def stored(df: DataFrame, epoch: int, turn: int) -> tuple[DataFrame, str]:
        path = f"{base}/weights-{epoch}-{turn}"
        return store(df, path, chunks, "chunk", "none"), path

    first = start.groupBy("chunk").cogroup(announced.groupBy("chunk")).applyInArrow(_first_chunk(h), _CHUNK_SCHEMA)
    state, path = stored(first, 0, 0)
    dense = initial_dense(h, n_classes, params.seed)
    history: list[tuple[int, float, float, float, float]] = []
    for epoch in range(1, params.epochs + 1):
        hits = loss = 0.0
        for turn in range(1, params.averages_per_epoch + 1):
            words = state.where(F.col("chunk") >= 0)
            fetched = words.drop("idx", "members").mapInArrow(_send(h), _FETCHED_SCHEMA)
            sent = (
                train.groupBy("shard").cogroup(fetched.groupBy("shard")).applyInArrow(_round(dense, params, chunks, epoch, turn), _SENT_SCHEMA)
            )
            averaged = sent.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(_averaged(dense, n_docs), _CHUNK_SCHEMA)
            before = path
            state, path = stored(averaged, epoch, turn)
            remove_folder(spark, before)
            small = np.frombuffer(state.where(F.col("chunk") == _SMALL).select("w").first()["w"], np.float64)
            dense = dense.moved(small[3:], int(small[2]))
            loss, hits = loss + small[0], hits + small[1]
        check = evaluate_weights(checked, state, dense.table(state), h).first()
        history.append((epoch, float(hits / n_docs), check["accuracy"], float(loss / n_docs), check["loss"]))
    checked.free()
    network = dense.table(state)
    tested = held_rows(dealt, "test", chunks)
    result = evaluate_weights(tested, state, network, h).first()
    tested.free()
    last = spark.read.schema(state.schema).parquet(path)
    weights = last.where(F.col("chunk") >= 0).select("idx", "w").mapInArrow(_weights(h), "idx bigint, weights array<double>")
    return Fitted(
        hidden=weights,
        network=network,
        history=spark.createDataFrame(
            history, "epoch bigint, accuracy double, val_accuracy double, loss double, val_loss double"
        ),
        test_loss=result["loss"],
        test_accuracy=result["accuracy"],
    )
