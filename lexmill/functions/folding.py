"""Unicode handling of one text field: strip, blank out symbols, fold to ASCII.

The wanted result is the one Python's ``re`` and ``unicodedata`` give. The JVM's
tables are older or newer than Python's, so the code points on which the two
disagree are worked out from both engines at first use instead of being listed here.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# White space as Python sees it: ASCII blanks, the four separators, NEL and the Z categories.
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
_WORD = r"\p{L}\p{N}_"
_SYMBOL = f"[^{_WORD}{SPACE}]"
_STRIP = rf"\A[{SPACE}]+|[{SPACE}]+\z"


def _code_points() -> range:
    return range(0x80, sys.maxunicode + 1)


def _is_surrogate(cp: int) -> bool:
    return 0xD800 <= cp <= 0xDFFF


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[dict[str, str], dict[str, str]]:
    """Non-ASCII characters whose NFKD form keeps one ASCII character, and those keeping several."""
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    for cp in _code_points():
        if _is_surrogate(cp):
            continue
        ch = chr(cp)
        kept = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(kept) == 1:
            single[ch] = kept
        elif kept:
            several[ch] = kept
    return single, several


@lru_cache(maxsize=1)
def _word_ranges_unknown_to_jvm() -> str:
    """Regex ranges of Python word characters that the JVM's ``\\p{L}\\p{N}`` miss."""
    spark = SparkSession.active()
    words = "".join(chr(cp) for cp in _code_points() if not _is_surrogate(cp) and chr(cp).isalnum())
    missed = spark.range(1).select(F.regexp_replace(F.lit(words), f"[{_WORD}]", "")).first()[0]
    return _ranges(map(ord, missed))


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends (SQL ``trim`` removes only spaces)."""
    return F.regexp_replace(c, _STRIP, "")


def blank_symbols(c: Column) -> Column:
    """Replace each character that is neither a word character nor white space by one space.

    A class with dozens of ranges is several times slower than the plain one, so it
    runs only on texts holding a code point that is unassigned for the JVM.
    """
    plain = F.regexp_replace(c, _SYMBOL, " ")
    late = _word_ranges_unknown_to_jvm()
    if not late:
        return plain
    full = F.regexp_replace(c, f"[^{_WORD}{SPACE}{late}]", " ")
    return F.when(c.rlike(r"\p{Cn}"), full).otherwise(plain)


def _held(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` evaluated once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def _ranges(code_points: Iterable[int]) -> str:
    """Regex class body covering sorted code points."""
    ranges: list[list[int]] = []
    for cp in code_points:
        if ranges and ranges[-1][1] == cp - 1:
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges)


@lru_cache(maxsize=1)
def _maybe_several() -> str:
    """A short regex class holding every character that folds to several: exact for the Latin
    blocks up to U+017F, where most letters are, and everything beyond."""
    low = [ord(ch) for ch in _fold_tables()[1] if ord(ch) < 0x180]
    return f"[{_ranges(low)}\\x{{180}}-\\x{{{sys.maxunicode:X}}}]"


def _fold(c: Column) -> Column:
    single, several = _fold_tables()
    table = F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in several.items())), F.lit("\x02"), F.lit("\x01"))
    spelled = F.array_join(
        F.transform(
            F.split(c, ""),
            lambda ch: F.when(F.octet_length(ch) == 1, ch).otherwise(F.coalesce(F.try_element_at(table, ch), ch)),
        ),
        "",
    )
    has_several = F.char_length(F.translate(c, "".join(several), "")) < F.char_length(c)
    expanded = F.when(c.rlike(_maybe_several()) & has_several, spelled).otherwise(c)
    folded = F.translate(expanded, "".join(single), "".join(single.values()))
    return F.when(is_ascii(c), c).otherwise(F.regexp_replace(folded, r"[^\x00-\x7F]", ""))


def fold_ascii(c: Column) -> Column:
    """NFKD-normalise and drop what is still not ASCII."""
    return _held(c, _fold)


def plain_field(c: Column, trimmed: bool = True) -> Column:
    """One field stripped, freed of symbols and folded; ``c`` should be a bare column."""
    held = strip(c) if trimmed else c
    ascii_only = F.regexp_replace(held, _SYMBOL, " ")
    return F.when(is_ascii(c), ascii_only).otherwise(fold_ascii(blank_symbols(held)))
