"""Words of a row counted in columns: Arrow batches with dictionary-encoded words.

The JVM lower-cases the text; a task then splits, numbers and counts the words of some rows at a time in compiled code. A row's words never leave its task before they are counted, so nothing is exchanged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.text import ASCII_BLANKS, TOKEN_FILTERS
from lexmill.sources.workspace import small_batches

_SLICE_BYTES = 1 << 20  # text looked at together


def sliced(batches: Iterator[pa.RecordBatch], column: int, size: int = _SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``size`` bytes in its text ``column``, or one longer text."""
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        k = 0
        while k < b.num_rows:
            upto = (ends[k - 1] if k else 0) + size
            to = max(int(np.searchsorted(ends, upto, side="right")), k + 1)
            yield b.slice(k, to - k)
            k = to


def _blanking(breaks: str) -> np.ndarray:
    """A blank for the byte of every break; all of them are ASCII, so no other letter is touched."""
    table = np.arange(256, dtype=np.uint8)
    table[list(breaks.encode())] = ord(" ")
    return table


_BLANKED = _blanking(TOKEN_FILTERS)
_SPACED = _blanking(ASCII_BLANKS)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each text ends, and the bytes of all."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return ends - ends[0], np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)


def _pieces(ends: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """What stands between blanks in texts without nulls: every piece's row, and the pieces."""
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(raw)]
    lists = pc.split_pattern(pa.Array.from_buffers(pa.large_string(), len(ends) - 1, buffers), " ")
    words, rows = lists.flatten(), pc.list_parent_indices(lists)
    real = pc.not_equal(words, "")
    return rows.filter(real).to_numpy(zero_copy_only=False).astype(np.int64), words.filter(real)


def _words(column: pa.Array, stop_words: pa.Array | None = None) -> tuple[np.ndarray, pa.Array]:
    """Every word's row, and the words, of texts without nulls.

    Stop words are whole pieces between blanks; what is left is cut at the other breaks.
    """
    ends, raw = _bytes(column)
    if stop_words is None:
        return _pieces(ends, _BLANKED[raw])
    spaced = _SPACED[raw]
    rows, pieces = _pieces(ends, spaced)
    kept = pc.invert(pc.is_in(pieces, value_set=stop_words))
    rows, pieces = rows[kept.to_numpy(zero_copy_only=False)], pieces.filter(kept)
    if np.array_equal(_BLANKED[spaced], spaced):
        return rows, pieces
    owner, words = _words(pieces)
    return rows[owner], words


def _counted(b: pa.RecordBatch, stop_words: pa.Array | None = None) -> pa.RecordBatch:
    """(kept columns, word, place, n) of the different words of each row, from (kept columns, text)."""
    kept, names = b.columns[:-1], b.schema.names[:-1]
    rows, words = _words(b.column(b.num_columns - 1), stop_words)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    _, first, n = np.unique(rows * max(len(coded.dictionary), 1) + codes, return_index=True, return_counts=True)
    place = first - np.searchsorted(rows, rows[first])
    without = np.setdiff1d(np.arange(b.num_rows), rows)
    owner = pa.array(np.r_[rows[first], without])
    nothing = len(without)
    spelled = pa.concat_arrays([coded.dictionary.take(pa.array(codes[first])).cast(pa.string()), pa.nulls(nothing, pa.string())])
    numbers = [pa.concat_arrays([pa.array(x, pa.int64()), pa.nulls(nothing, pa.int64())]) for x in (place, n)]
    return pa.RecordBatch.from_arrays([*[c.take(owner) for c in kept], spelled, *numbers], [*names, "word", "place", "n"])


def counted_words(docs: DataFrame, keep: Sequence[str], column: str = "clean", stop_words: Sequence[str] = ()) -> DataFrame:
    """``(keep, word, place, n)``: the different words of each row, where each first stands among its words, and how often.

    A row without words has one row whose word is null. Rows are counted by themselves, also where they repeat each other.
    ``stop_words`` drops them from a text that is plain ASCII but still holds them, as ``clean`` would have done.
    """
    dropped = list(stop_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, stop = len(keep), pa.array(dropped, pa.large_string()) if dropped else None
        for b in sliced(batches, last):
            yield _counted(b, stop)

    small_batches(docs.sparkSession)
    fields = [docs.select(*keep).schema[c] for c in keep]
    more = T.StructType.fromDDL("word string, place bigint, n bigint").fields
    return docs.select(*keep, F.coalesce(F.lower(column), F.lit("")).alias("_text")).mapInArrow(run, T.StructType([*fields, *more]))
