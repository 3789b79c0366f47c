from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from __spark_entry__ import queries
from lexmill.llm import runs


def plain_runs(words, least=12):
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(2 * p, least):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def plain_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {x for s, length, q in found for x in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, *[hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)])


def test_every_pair_of_remainders_meets_the_cover():
    for i in range(runs.MODULUS):
        for j in range(runs.MODULUS):
            step = runs._SHIFT[i, j]
            assert {(i + step) % runs.MODULUS, (j + step) % runs.MODULUS} <= set(runs.COVER)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=200), st.integers(0, 10**6))
def test_common_extensions(words, seed):
    array = np.array([*words, 3])
    lce, rng = runs.CoverLce(array), random.Random(seed)
    for _ in range(30):
        i, j = rng.randrange(len(array)), rng.randrange(len(array))
        if i != j:
            want = next(k for k in range(len(array)) if array[i + k] != array[j + k])
            assert lce(np.array([i]), np.array([j]))[0] == want


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=90), st.integers(0, 40), st.integers(1, 9)), max_size=4))
def test_runs_of_small_alphabets(docs):
    words = [w + (w * times)[:more] for w, more, times in docs]
    for k, own, found, stays in runs._runs_of([" ".join(map(str, w)) for w in words], [None] * len(words), False):
        assert sorted((s, e - s, p) for s, e, p in found.tolist()) == plain_runs([str(x) for x in words[k]])
        gone = {x for s, e, p in found.tolist() for x in range(s + p, e)}
        assert np.flatnonzero(~stays).tolist() == sorted(gone)


def test_grid_in_pieces_and_long_runs(monkeypatch):
    rng = random.Random(5)
    base = [str(rng.randrange(50)) for _ in range(400)]
    text = " ".join(base + ["same"] * 300 + base[:70] * 5 + base)
    monkeypatch.setattr(runs, "_QUERIES", 100)
    ((_, words, found, _),) = runs._runs_of([text], [None], False)
    assert sorted((s, e - s, p) for s, e, p in found.tolist()) == plain_runs(words)


def test_query_equals_plain(spark, small, docs):
    got = sorted(map(tuple, queries()["op12_runs"](spark, small).collect()))
    want = sorted(plain_digest(r["doc_id"], r["text"]) for r in docs.collect())
    assert got == want and sum(g[1] > 0 for g in got) > 10


def test_odd_rows_and_empty_tables(spark, edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect() if len(r["text"] or "") < 10_000]
    short = edge.where("text is null or length(text) < 10000")
    got = sorted(map(tuple, runs.digests(short).collect()), key=repr)
    assert got == sorted((plain_digest(d, t) for d, t in rows), key=repr)
    assert runs.digests(edge).count() == edge.count() and runs.digests(empty).count() == 0


def test_collapse_gives_spans_and_texts(spark):
    line = "one two three four "
    df = spark.createDataFrame([(1, "start " + line * 4 + "end"), (2, "a b"), (3, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in runs.collapse(df).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(1, 16, 4)] and got[1]["collapsed"] == "start one two three four end"
    assert (got[2]["n_words"], got[2]["runs"], got[2]["collapsed"]) == (2, [], "a b")
    assert (got[3]["n_words"], got[3]["runs"], got[3]["collapsed"]) == (0, [], "")
