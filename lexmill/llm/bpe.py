"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

Every prefix of a piece has one encoding, so it is enough to store its last token. The tokens that end at a
position are found with a suffix automaton of the vocabulary; of those the right one is the token
that is compatible with the last token of the prefix before it, that is, merging would never cross their border.
Following the stored tokens back from the end gives the ids.

Nulls count as empty texts, empty texts have no ids. Repeated rows are encoded each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from lexmill.llm.support import slices, texts_of
from lexmill.llm.words import WordEncoder, as_bytes, byte_letters, default_vocabulary

_END = "</w>"
_NEVER = 1 << 60


class SuffixAutomaton:
    """All substrings of a set of strings of small numbers; a string of the set is the longest of its state.

    ``step[state * width + symbol]`` is the next state. ``token[state]`` is the string that ends the state, or
    -1. ``shorter[state]`` is the next state along the suffix links that ends a string, or 0.
    """

    def __init__(self, strings: list[list[int]], width: int):
        self.width = width
        self.step: dict[int, int] = {}
        self.length, self.link = [0], [-1]
        edges: list[list[int]] = [[]]  # symbols that leave each state
        self.edges = edges
        ends = [self._add(s) for s in strings]
        self.token = [-1] * len(self.length)
        for name, state in enumerate(ends):
            self.token[state] = name
        self.shorter = [0] * len(self.length)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            up = self.link[state]
            self.shorter[state] = up if up > 0 and self.token[up] >= 0 else self.shorter[max(up, 0)]
        del self.edges

    def _state(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self.edges.append([])
        return len(self.length) - 1

    def _go(self, state: int, symbol: int, to: int) -> None:
        at = state * self.width + symbol
        if at not in self.step:
            self.edges[state].append(symbol)
        self.step[at] = to

    def _split(self, above: int, symbol: int, state: int) -> int:
        """A state of its own for the strings of ``state`` that also end where ``above`` goes by ``symbol``."""
        copy = self._state(self.length[above] + 1, self.link[state])
        for s in self.edges[state]:
            self._go(copy, s, self.step[state * self.width + s])
        self.link[state] = copy
        while above >= 0 and self.step.get(above * self.width + symbol) == state:
            self.step[above * self.width + symbol] = copy
            above = self.link[above]
        return copy

    def _add(self, string: list[int]) -> int:
        last = 0
        for symbol in string:
            there = self.step.get(last * self.width + symbol)
            if there is not None:
                last = there if self.length[there] == self.length[last] + 1 else self._split(last, symbol, there)
                continue
            new = self._state(self.length[last] + 1, 0)
            at = last
            while at >= 0 and at * self.width + symbol not in self.step:
                self._go(at, symbol, new)
                at = self.link[at]
            if at >= 0:
                there = self.step[at * self.width + symbol]
                self.link[new] = there if self.length[there] == self.length[at] + 1 else self._split(at, symbol, there)
            last = new
        return last


class Codec:
    """Encoder and decoder of a vocabulary file whose pieces end in a marked symbol."""

    def __init__(self, vocabulary: str):
        with open(vocabulary) as f:
            spec = json.load(f)
        ids: dict[str, int] = spec["model"]["vocab"]
        self.path = vocabulary
        self.shown = {i: t for t, i in ids.items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        letter = {c: b for b, c in enumerate(byte_letters())}

        def symbols(token: str) -> list[int]:
            body, ended = (token[: -len(_END)], True) if token.endswith(_END) and len(token) > len(_END) else (token, False)
            out = [letter[c] for c in body]
            if ended:
                out[-1] += 256
            return out

        self.names = list(ids.values())
        strings = [symbols(t) for t in ids]
        self.size = dict(zip(self.names, map(len, strings)))
        self.single = {s[0]: i for s, i in zip(strings, self.names) if len(s) == 1}
        # id and rank of the token that two tokens merge into, and the two halves of each merged token
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, whole = ids[left], ids[right], ids[left + right]
            self.merged[a, b] = (rank, whole)
            self.halves.setdefault(whole, (rank, a, b))
        self.whole = {i for s, i in zip(strings, self.names) if self._by_merging(s) == [i]}
        kept = [(s, i) for s, i in zip(strings, self.names) if i in self.whole]
        self.names = [i for _, i in kept]
        self.automaton = SuffixAutomaton([s for s, _ in kept], 512)

    def _by_merging(self, string: list[int]) -> list[int]:
        """Encoding by its definition: the merge of lowest rank first, the leftmost of equals."""
        parts = [self.single[s] for s in string]
        while len(parts) > 1:
            found = min((self.merged.get(p, (_NEVER, 0)) + (k,) for k, p in enumerate(zip(parts, parts[1:]))))
            if found[0] == _NEVER:
                break
            parts[found[2] : found[2] + 2] = [found[1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Whether a text of the tokens ``a`` and ``b`` is encoded as just these.

        The two tokens are taken apart along their border, the merge made last first. If the border could
        ever have been merged over before the merge just undone, the tokens are not compatible.
        """
        before, merged, halves = _NEVER, self.merged, self.halves
        while True:
            over = merged.get((a, b))
            if over is not None and over[0] < before:
                return False
            left, right = halves.get(a), halves.get(b)
            if left is not None and (right is None or left[0] > right[0]):
                before, a = left[0], left[2]
            elif right is not None:
                before, b = right[0] + 1, right[1]  # of equal ranks the left one is merged first
            else:
                return True

    def piece_ids(self, piece: bytes) -> list[int]:
        symbols = list(piece)
        symbols[-1] += 256
        auto, names, size = self.automaton, self.names, self.size
        step, link, length, token, shorter, width = auto.step, auto.link, auto.length, auto.token, auto.shorter, auto.width
        last: list[int] = []
        state = matched = 0
        for end, symbol in enumerate(symbols, 1):
            to = step.get(state * width + symbol)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = step.get(state * width + symbol)
            if to is not None:
                state, matched = to, matched + 1
            at = state if token[state] >= 0 and length[state] <= matched else shorter[state]
            chosen = -1
            while at:
                t = names[token[at]]
                start = end - size[t]
                if start == 0 or last[start - 1] >= 0 and self.compatible(last[start - 1], t):
                    chosen = t
                    break
                at = shorter[at]
            last.append(chosen)
        out, end = [], len(symbols)
        while end:
            out.append(last[end - 1])
            end -= size[out[-1]]
        return out[::-1]

    def text_encoder(self) -> WordEncoder:
        """Whole texts to ids. The library cuts a text into pieces where the plain rule might not."""
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        letter = {c: b for b, c in enumerate(byte_letters())}
        special = sorted((t["content"], t["id"]) for t in json.loads(library.to_str())["added_tokens"])

        def piece(p: str) -> bytes:
            return as_bytes(self.piece_ids(p.encode()))

        def plain(text: str) -> list[int]:
            tidy = library.normalizer.normalize_str(text)
            cut = library.pre_tokenizer.pre_tokenize_str(tidy)
            return [i for spelled, _ in cut for i in self.piece_ids(bytes(letter[c] for c in spelled))]

        def whole(text: str) -> bytes:
            ids: list[int] = []
            while text:
                at, name, i = min(((text.find(s), s, i) for s, i in special if s in text), default=(len(text), "", -1))
                ids += plain(text[:at]) + ([i] if name else [])
                text = text[at + len(name) :]
            return as_bytes(ids)

        return WordEncoder(piece, whole)

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.shown.__getitem__, ids))


_WORKER: dict[str, tuple[Codec, WordEncoder]] = {}


def _codec(shared) -> tuple[Codec, WordEncoder]:
    codec = shared.value
    if codec.path not in _WORKER:
        _WORKER[codec.path] = (codec, codec.text_encoder())
    return _WORKER[codec.path]


def encode(docs: DataFrame, vocabulary: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids) for every text."""
    shared = docs.sparkSession.sparkContext.broadcast(Codec(vocabulary or default_vocabulary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = _codec(shared)
        for b in slices(batches):
            ids = [memoryview(i).cast("I").tolist() for i in encoder.encode(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return texts_of(docs, id_column, text_column).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(coded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids count as none."""
    shared = coded.sparkSession.sparkContext.broadcast(Codec(vocabulary or default_vocabulary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value
        for b in batches:
            texts = [codec.decode(ids or []) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def round_trip_digests(
    docs: DataFrame, vocabulary: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ids of every text and the text decoded from them."""
    shared = docs.sparkSession.sparkContext.broadcast(Codec(vocabulary or default_vocabulary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, encoder = _codec(shared)
        for b in slices(batches):
            n, coded, decoded = [], [], []
            for ids in encoder.encode(b.column(1).to_pylist()):
                n.append(len(ids) // 4)
                coded.append(hashlib.sha256(ids).hexdigest())
                text = codec.decode(memoryview(ids).cast("I").tolist())
                decoded.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return texts_of(docs, id_column, text_column).mapInArrow(run, schema)
