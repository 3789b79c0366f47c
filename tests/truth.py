"""Plain Python versions of the text operators, written from their definitions."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

from lexmill.config import STOP_WORDS

FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'


def clean(fields: list[str], remove: bool = True) -> str:
    parts = []
    for f in fields:
        spaced = re.sub(r"[^\w\s]", " ", f.strip())
        parts.append(unicodedata.normalize("NFKD", spaced).encode("ascii", "ignore").decode("ascii"))
    joined = " ".join(parts)
    if not remove:
        return joined
    return " ".join(w for w in joined.split() if w.lower() not in STOP_WORDS)


def tokens(text: str) -> list[str]:
    table = {ord(c): " " for c in FILTERS}
    return [w for w in text.lower().translate(table).split(" ") if w]


def vocabulary(docs: list[list[str]]) -> dict[str, tuple[int, int, int]]:
    """word -> (n, df, idx) for documents in order."""
    n: Counter = Counter()
    df: Counter = Counter()
    for d in docs:
        n.update(d)
        df.update(set(d))
    ordered = sorted(n, key=lambda w: -n[w])  # insertion order is first appearance; the sort is stable
    return {w: (n[w], df[w], i + 2) for i, w in enumerate(ordered)}


def tfidf(doc: list[str], vocab: dict[str, tuple[int, int, int]], n_docs: int, limit: int | None) -> dict[int, float]:
    counts: Counter = Counter()
    dfs = {1: 0}
    for w in doc:
        _, df, idx = vocab.get(w, (0, 0, 1))
        if limit is not None and idx >= limit:
            df, idx = 0, 1
        counts[idx] += 1
        dfs[idx] = df
    return {i: (1 + math.log(c)) * math.log(1 + n_docs / (1 + dfs[i])) for i, c in counts.items()}
