"""Documents to cleaned text and to tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.config import STOP_WORDS
from lexmill.functions.folding import plain_field

# Folded text is ASCII, so only ASCII blanks are left to split on.
_BLANKS = r"[\s\x1c-\x1f]+"
ASCII_BLANKS = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f"

# Characters the tokenizer turns into spaces.
TOKEN_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'
_TOKEN_BREAKS = "[ " + "".join("\\" + ch if not ch.isspace() else ch for ch in TOKEN_FILTERS) + "]+"


def join_fields(columns: Sequence[Column]) -> Column:
    """The row's fields joined by one space; missing fields must have been repaired before."""
    return F.concat_ws(" ", *columns)


def words_of(c: Column) -> Column:
    return F.array_remove(F.split(c, _BLANKS), "")


def without_stop_words(words: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    if not stop_words:
        return words
    return F.filter(words, lambda w: ~F.lower(w).isin(list(stop_words)))


def plain(columns: Sequence[Column]) -> Column:
    """The fields freed of symbols, folded and joined, before stop words are dropped and blanks squeezed."""
    return join_fields([plain_field(c, trimmed=False) for c in columns])


def clean(columns: Sequence[Column], stop_words: Sequence[str] = STOP_WORDS, remove: bool = True) -> Column:
    """Clean every field, join them and, if wanted, drop stop words and squeeze blanks."""
    if not remove:
        return join_fields([plain_field(c) for c in columns])
    return F.array_join(without_stop_words(words_of(plain(columns)), stop_words), " ")


def tokens(cleaned: Column) -> Column:
    """Lower-cased tokens in order. Carriage return, form feed and vertical tab stay inside tokens."""
    return F.array_remove(F.split(F.lower(cleaned), _TOKEN_BREAKS), "")


def split_fields(c: Column, separator: str = ";") -> Column:
    """Fields of a delimited request; trailing empty fields are kept."""
    return F.split(c, "\\Q" + separator + "\\E", -1)
