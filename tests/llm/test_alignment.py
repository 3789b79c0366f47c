from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from __spark_entry__ import queries
from lexmill.llm import alignment
from lexmill.llm.words import byte_letters

A_PATH, B_PATH = alignment.default_vocabularies()


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B_PATH)


def tokens(libraries, text):
    """(id, bytes) of the tokens of whole texts under A and B, as the libraries give them."""
    a, b = libraries
    if not text:
        return [], []
    letters = {c: k for k, c in enumerate(byte_letters())}
    left = [(t, bytes(letters[c] for c in a.id_to_token(t))) for t in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for t in b.encode(text):
        p = b.id_to_piece(t)
        right.append((t, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
        return [], []
    return left, right


def plain_links(left, right):
    def spans(side):
        at, out = 0, []
        for _, x in side:
            out.append((at, at + len(x)))
            at += len(x)
        return out

    a, b = spans(left), spans(right)
    return [(left[i][0], right[j][0]) for i, (s, e) in enumerate(a) for j, (x, y) in enumerate(b) if max(s, x) < min(e, y)]


def plain_groups(left, right):
    ends = lambda side: np.cumsum([len(x) for _, x in side]).tolist()
    a, b = ends(left), ends(right)
    common = sorted(set(a) & set(b))
    out, before = [], 0
    for c in common:
        own = [",".join(str(t[0]) for t, e in zip(side, e_) if before < e <= c) for side, e_ in ((left, a), (right, b))]
        out.append("|".join(own))
        before = c
    return ";".join(out), len(common)


def plain(libraries, rows):
    found = [(d, *tokens(libraries, t)) for d, t in rows]
    links = [plain_links(left, right) for _, left, right in found]
    counts = collections.Counter(x for per_doc in links for x in per_doc)
    most = collections.defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for (d, left, right), own in zip(found, links):
        text, n = plain_groups(left, right)
        sha = hashlib.sha256(text.encode()).hexdigest() if left else ""
        out.append((d, len(left), len(right), n, len(own), sum(counts[x] == most[x[1]] for x in own), sum(counts[x] for x in own), sha))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ODD = [
    "plain words here", " leading", "trailing ", "two  spaces   three", "line\nbreaks\r\n and\ttabs ", "x;\ry {\r z", "▁ literal", "a▁b c",
    "<|endoftext|> <s> </s> <unk> <0x41>", "日本語 テキスト と 漢字", "é ﬁ Å", "\x00 nul \x1c sep\x85 nel　wide", "don't we'll I'm", "1234567 89",
    "🙂🙃 emoji👩‍👩‍👧", " ", "  ", "\n", "a" * 300, "İstanbul straße", "tab\tonly", "é combining", "﻿bom", "end.\n\n\nnext",
]


def test_chunks_equal_whole_texts(libraries, texts):
    encoders = alignment.TwoEncoders(A_PATH, B_PATH, limit=500)
    assert encoders.by_chunk
    every = [*ODD, "", "x" * 100 + " y", *texts.values()]
    for text, (a, b) in zip(every, [found for k in range(0, len(every), 7) for found in encoders.encode(every[k : k + 7])]):
        left, right = tokens(libraries, text)
        assert np.frombuffer(a, "<u4").tolist() == [t for t, _ in left]
        assert np.frombuffer(b, "<u4").tolist() == [t for t, _ in right]


def test_gallop_finds_first_places():
    rng = np.random.default_rng(1)
    for _ in range(200):
        among = np.sort(rng.choice(500, rng.integers(1, 60), replace=False))
        low = rng.integers(0, len(among), 40)
        high = rng.integers(low, len(among) + 1)
        sought = rng.integers(-5, 505, 40)
        got = alignment.gallop(sought, among, low, high, rng.integers(-3, 70, 40))
        assert got.tolist() == [int(x + np.searchsorted(among[x:y], v)) for v, x, y in zip(sought, low, high)]


@pytest.mark.parametrize("seed", range(5))
def test_links_of_random_cuts(seed):
    rng = random.Random(seed)
    sides = []
    for _ in range(30):
        n = rng.randint(0, 40)
        sides.append([sorted({*rng.sample(range(1, n), rng.randint(0, n - 1)), n}) if n else [] for _ in range(2)])
    sizes = [np.concatenate([np.diff([0, *s[k]]) for s in sides]).astype(np.int64) for k in (0, 1)]
    cuts = [np.r_[0, np.cumsum([len(s[k]) for s in sides])] for k in (0, 1)]
    got = alignment.Aligned(*sizes, *cuts)
    for d, (a, b) in enumerate(sides):
        own = slice(got.link_cuts[d], got.link_cuts[d + 1])
        found = list(zip((got.a_of[own] - cuts[0][d]).tolist(), (got.b_of[own] - cuts[1][d]).tolist()))
        starts = [[0, *s][:-1] for s in (a, b)]
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(starts[0][i], starts[1][j]) < min(a[i], b[j])]
        assert sorted(found) == want and len(want) == len(set(a) | set(b))


def test_query_equals_plain(spark, small, docs, libraries):
    got = {r[0]: r for r in result(queries()["op11_alignment"](spark, small))}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    short = [(d, t) for d, t in rows if len(t or "") < 2500]
    df = spark.createDataFrame(short, "doc_id bigint, text string").repartition(5)
    assert result(alignment.align(df, pairs=500)) == plain(libraries, short)
    for d, t in rows:
        left, right = tokens(libraries, t)
        assert got[d][1:3] == (len(left), len(right)) and got[d][4] == got[d][1] + got[d][2] - got[d][3]
    counts = alignment.pair_counts(df)
    want = collections.Counter(x for _, t in short for x in plain_links(*tokens(libraries, t)))
    assert {(r["a_id"], r["b_id"]): r["n"] for r in counts.collect()} == want


@pytest.mark.parametrize("parts", [1, 4])
def test_odd_rows(spark, edge, empty, libraries, parts):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect() if len(r["text"] or "") < 3000]
    rows += [(100 + k, t) for k, t in enumerate(ODD)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "doc_id AS pair", "1 AS n", "2 AS section", "3 AS kind")
    assert result(alignment.align(df.repartition(parts))) == plain(libraries, rows)
    assert alignment.align(edge).count() == edge.count() and alignment.align(empty).count() == 0
