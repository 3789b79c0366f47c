"""Ids of whole texts, each different word encoded once.

The tokenizer of ``word_bpe_49k.json`` replaces white space, lower-cases, splits into runs of letters, single
digits, runs of signs and a few English endings, and encodes every piece by itself. No piece holds
white space, so the ids of a text are the ids of its words in a row, and the ids of a word met before are
remembered. A text that may hold a special token, or a separator that Python and the library take
differently, is encoded whole; so is a word with characters beyond printable ASCII and Latin-1 letters.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator

# What the tokenizer file's pre-tokenizer cuts out, for the plain characters.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# Openings of special tokens, and separators that only Python takes for white space.
_WHOLE_MARKS = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")
CACHE_WORDS = 500_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Remembered(dict):
    """Word -> ids, filled on demand."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        self[word] = ids = self.make(word)
        return ids


class WordEncoder:
    """Ids per text as little-endian unsigned 32-bit bytes.

    ``encode_piece`` gives the ids of one lower-case piece, ``encode_whole`` those of any text. At most twice
    ``limit`` words and ``limit`` pieces are remembered: the older words go when the newer are that many.
    """

    def __init__(
        self, encode_piece: Callable[[str], bytes], encode_whole: Callable[[str], bytes], limit: int = CACHE_WORDS
    ):
        self.encode_piece, self.encode_whole, self.limit = encode_piece, encode_whole, limit
        self.words, self.pieces = _Remembered(self._word), _Remembered(encode_piece)
        self.older: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = dict.get(self.older, word)
        if ids is not None:
            return ids
        if not _PLAIN.fullmatch(word):
            return self.encode_whole(word)
        low = word.lower()
        if low.isalpha():
            return self.pieces[low]
        return b"".join(map(self.pieces.__getitem__, _PIECE.findall(low)))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            if len(self.words) > self.limit:
                self.older, self.words = self.words, _Remembered(self._word)
            if len(self.pieces) > self.limit:
                self.pieces.clear()
            if any(mark in text for mark in _WHOLE_MARKS):
                yield self.encode_whole(text)
            else:
                yield b"".join(map(self.words.__getitem__, text.split()))


def as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


# Fixed rule of byte-level vocabularies: printable bytes stand for themselves, the others for 256 and up in order.
def byte_letters() -> list[str]:
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letter[b] for b in range(256)]


_LIBRARY: dict[str, WordEncoder] = {}


def library_encoder(vocabulary: str) -> WordEncoder:
    """The encoder of a Python worker; it stays as long as the worker, so later tasks know its words."""
    if vocabulary not in _LIBRARY:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        model, letters = tokenizer.model, byte_letters()

        def whole(text: str) -> bytes:
            return as_bytes(tokenizer.encode(text, add_special_tokens=False).ids)

        def piece(p: str) -> bytes:
            spelled = p if p.isascii() else "".join([letters[b] for b in p.encode()])
            return as_bytes([t.id for t in model.tokenize(spelled)])

        _LIBRARY[vocabulary] = WordEncoder(piece, whole)
    return _LIBRARY[vocabulary]
