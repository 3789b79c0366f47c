from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, key bigint, t int, node int, h int"


def edge_rows(seed: int = 1) -> list[tuple]:
    """Null and empty texts, null and repeated ids, equal rows, copies, a very long text, unusual characters."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    long = " ".join(word() for _ in range(9000))
    base = " ".join(word() for _ in range(60))
    texts = [
        (1, None), (2, ""), (3, "   \n "), (4, base), (5, base), (6, base.upper()), (7, base + " tail"), (8, long), (9, long),
        (10, "..!?"), (11, "12 34"), (12, "a"), (13, "日本語 テキスト"), (14, "x\x00y \x1c z<|endoftext|>"), (15, base[:200] + long[:500]),
        (None, "no id at all"), (None, base), (16, "same row"), (16, "same row"), (17, "one"), (17, "another"), (18, "a" * 700),
    ]
    langs = ["en", "fr", None]
    return [(d, t, langs[k % 3], None, None, "w", 1, 2, 3, 4) for k, (d, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
