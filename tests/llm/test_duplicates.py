from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.llm import components, cuckoo, jaccard, repeats


# Exact groups


def test_cuckoo_index_inserts_deletes_and_grows():
    index = cuckoo.CuckooIndex(2, kicks=5)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for i, k in enumerate(keys):
        index.insert(k, i)
    assert index.size == 3000 and all(index.find(k) == i for i, k in enumerate(keys))
    for k in keys[::3]:
        assert index.delete(k) and not index.delete(k)
    assert all((index.find(k) is None) == (i % 3 == 0) for i, k in enumerate(keys)) and index.size == 2000
    assert sorted(v for _, v in index) == [i for i in range(3000) if i % 3]


def test_equal_fingerprints_are_told_apart_by_content():
    index = cuckoo.CuckooIndex(2)
    keys = [b"ab" + b"\0" * 8 + bytes([i]) * 22 for i in range(6)]  # the same print and buckets
    for i, k in enumerate(keys):
        index.insert(k, i)
    assert [index.find(k) for k in keys] == list(range(6)) and index.find(b"ab" + b"\0" * 8 + b"z" * 22) is None


def plain_groups(rows):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[lower(t)].append(d)
    out = []
    for d, t in rows:
        same = groups[lower(t)]
        keep = max((x for x in same if x is not None), default=None)
        out.append((d, keep, len(same), d == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_groups(spark, edge, empty, docs):
    for df in (edge, docs, edge.limit(1)):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        got = cuckoo.exact_groups(df).drop("t", "u").collect()
        assert sorted(map(tuple, got), key=repr) == plain_groups(rows)
    assert cuckoo.exact_groups(empty).count() == 0


def test_hot_group_of_copies(spark):
    rows = [(i, "Copy" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert sorted(map(tuple, cuckoo.exact_groups(df).drop("t", "u").collect()), key=repr) == plain_groups(rows)


# Components


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=40))
def test_components_equal_union_find(spark, edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    want = {(x, find(x)) for u, v in edges if u != v for x in (u, v)}
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    assert {tuple(r) for r in components.components(df).collect()} == want


# Similar documents


def plain_shingles(text):
    words = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())
    if not words:
        return None
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def plain_classes(texts):
    """Per place in the list: (first place of its class, number of links)."""
    sets = [plain_shingles(t) for t in texts]
    root, links = list(range(len(texts))), [0] * len(texts)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(find(i), links[i]) for i in range(len(texts))]


def similar_rows(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(6)
    got = {r["doc_id"]: r for r in jaccard.similarity_classes(df).collect()}
    assert len(got) == len(texts)
    kept = collections.Counter(r["class_id"] for r in got.values() if r["kept"])
    assert set(kept.values()) == {1} and all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got.values())
    return [(got[i]["class_id"], got[i]["n_links"]) for i in range(len(texts))]


def test_classes_equal_all_pairs(spark, texts):
    some = list(texts.values())
    rng = random.Random(4)
    for t in some[:40]:
        words = t.split()
        for edits in (1, 2, 5, 12):
            near = list(words)
            for _ in range(min(edits, len(words))):
                near[rng.randrange(len(near))] = "changed"
            some.append(" ".join(near))
    some += [None, "", "one", "one", "One!", "a b c d", "a, b. C d", "a b c d e", "!!", "!!"]
    assert similar_rows(spark, some) == plain_classes(some)


def test_large_group_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_WEIGHT", 4000)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    some = []
    for _ in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(120)] = f"x{rng.randrange(1000)}"
        some.append(" ".join(words))
    some += [some[0]] * 20
    assert similar_rows(spark, some) == plain_classes(some)


def test_similar_edge_rows(spark, edge, empty):
    got = jaccard.similarity_classes(edge).collect()
    assert len(got) == edge.count()
    by = collections.defaultdict(list)
    for r in got:
        by[r["class_id"]].append(r)
    assert all(sum(r["kept"] for r in rows) == 1 for c, rows in by.items() if c not in (None, 17))  # 17 names two texts
    rows = {r["doc_id"]: r for r in got}
    assert rows[4]["class_id"] == rows[5]["class_id"] == rows[6]["class_id"] == rows[7]["class_id"] == 4
    assert rows[1]["n_links"] == rows[10]["n_links"] == 0 and rows[8]["n_links"] == 1
    assert jaccard.similarity_classes(empty).count() == 0


def test_pruning_bound_is_the_posterior():
    least = jaccard.least_matches(0.8, 1e-6)
    rng = np.random.default_rng(0)
    for n, m in least.items():
        draws = rng.beta(m, n - m + 2, 200_000)  # one match fewer than needed
        assert (draws >= 0.8).mean() < 1e-4
        assert m < 0.8 * n


# Repeats


def plain_repeats(rows, length=repeats.LENGTH):
    """By a table of all passages. Rows with their order key, bytes first seen stay."""
    seen, out = set(), []
    for d, text in rows:
        raw = (text or "").encode()
        mark = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            passage = raw[p : p + length]
            if passage in seen:
                mark[p : p + length] = b"\1" * length
            seen.add(passage)
        kept = bytes(c for c, m in zip(raw, mark) if not m)
        runs = sum(1 for i, m in enumerate(mark) if m and not (i and mark[i - 1]))
        out.append((d, len(raw), sum(mark), runs, hashlib.sha256(kept).hexdigest()))
    return out


def removed_rows(df):
    return [tuple(r) for r in repeats.remove_repeats(df).drop("kept", "rest").collect()]


def place(row):
    """The order of documents: without id first, those of equal id by 128 bits of the SHA-256 of their texts."""
    digest = hashlib.sha256((row[1] or "").encode()).digest()
    return row[0] is not None, row[0] or 0, *[int.from_bytes(digest[k : k + 8], "big", signed=True) for k in (0, 8)]


def plain_repeats_of_rows(rows):
    """Rows equal in id and text are one document, each with its result."""
    once = sorted({(d, t or "") for d, t in rows}, key=place)
    found = dict(zip(once, plain_repeats(once)))
    return sorted((found[d, t or ""] for d, t in rows), key=repr)


def made_texts(seed):
    rng = random.Random(seed)
    base = "".join(rng.choice("abé") for _ in range(400))
    out = []
    for _ in range(120):
        kind = rng.random()
        if kind < 0.3:
            text = "".join(rng.choice("ab") for _ in range(rng.randint(0, 300)))
        elif kind < 0.8:
            a = rng.randint(0, 300)
            text = base[a : a + rng.randint(80, 400)]
            if rng.random() < 0.5:
                p = rng.randint(0, len(text))
                text = text[:p] + "X" + text[p:]
            if rng.random() < 0.3:
                text += text
        else:
            text = "a" * rng.randint(90, 500)
        out.append(text if rng.random() < 0.97 else None)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_a_table_of_all_passages(spark, seed):
    rows = list(enumerate(made_texts(seed)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert sorted(removed_rows(df)) == plain_repeats(rows)


def test_repeats_of_texts_with_a_period(spark):
    """Near the start of such a text several anchors have surroundings that begin at the first byte."""
    rng = random.Random(7)
    block = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    rows = [(k, (block(n) * 20)[: n + rng.randint(100, 150)]) for k, n in enumerate([25, 30, 41, 58, 60, 70] * 10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(removed_rows(df)) == plain_repeats(rows)


def test_repeats_of_documents(spark, docs):
    rows = sorted(tuple(r) for r in docs.select("doc_id", "text").collect())
    assert sorted(removed_rows(docs)) == plain_repeats(rows)


def test_repeats_edge_rows(spark, edge, empty):
    got = repeats.remove_repeats(edge, with_text=True).collect()
    assert len(got) == edge.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[1]["n_bytes"] == by[2]["n_bytes"] == 0 and by[9]["n_removed"] == by[9]["n_bytes"] and by[9]["kept"] == ""
    assert by[8]["n_removed"] == 0 and by[18]["n_removed"] == 699
    assert by[5]["n_removed"] == by[5]["n_bytes"]  # the row without id comes first and holds the same text
    assert repeats.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_equal_rows_keep_their_text_however_they_are_dealt(spark, parts):
    words = random.Random(4)
    text = lambda n: " ".join(str(words.randrange(10**6)) for _ in range(n))
    shared, a, b = text(30), text(70), text(70)
    rows = [(1, a), (1, a), (1, a), (2, b), (2, shared + b[100:]), (None, shared), (None, shared), (3, text(9) + shared + text(9)), (2, b)]
    rows += [(k, text(40)) for k in range(10, 40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    assert sorted(removed_rows(df), key=repr) == plain_repeats_of_rows(rows)


def colliding(spark, head):
    """Two different texts that begin alike and have the same 32-bit hash() in Spark."""
    texts = spark.range(400_000).select(F.concat(F.lit(head), F.col("id").cast("string")).alias("text"))
    pair = texts.groupBy(F.hash("text")).agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b").first()
    return pair["a"], pair["b"]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_texts_of_equal_hash_without_id_are_told_apart(spark, parts):
    head = " ".join(str(k * k) for k in range(200, 240)) + " "
    a, b = colliding(spark, head)
    rows = [(None, a), (None, b), (None, b), (5, "other text " * 9), (6, head)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    assert sorted(removed_rows(df), key=repr) == plain_repeats_of_rows(rows)
    assert sorted(map(tuple, cuckoo.exact_groups(df).drop("t", "u").collect()), key=repr) == plain_groups(rows)
    got = jaccard.similarity_classes(df).collect()
    assert len(got) == len(rows) and sorted(r["n_links"] for r in got) == sorted(len(x[1]) for x in plain_links(rows))


def plain_links(rows):
    sets = [set(jaccard.shingles(t or "").tolist()) for _, t in rows]
    near = lambda x, y: bool(x and y) and len(x & y) >= 0.8 * len(x | y)
    return [(d, [k for k, y in enumerate(sets) if k != i and near(sets[i], y)]) for i, (d, _) in enumerate(rows)]


def test_a_group_of_contexts_in_many_pieces(spark, monkeypatch):
    rng = random.Random(8)
    passage = " ".join(str(rng.randrange(1000)) for _ in range(60))
    rows = [(k, " ".join(str(rng.randrange(10**6)) for _ in range(rng.randint(0, 30))) + passage + str(rng.random())) for k in range(300)]
    assert len({t for _, t in rows}) == 300
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert sorted(removed_rows(df)) == plain_repeats(rows)
    data = np.frombuffer(passage.encode(), np.uint8)
    at = np.arange(len(data) - repeats.LENGTH)
    found = repeats._passage_hashes(np.concatenate([data, data]), np.concatenate([at, at + len(data)]))
    assert len(set(found.tolist())) == len(at) and (found[: len(at)] == found[len(at) :]).all()


def test_maximal_repeats_come_with_all_occurrences(spark):
    passage = "".join(random.Random(9).choice("abcdefgh") for _ in range(130))
    rows = [(i, f"{'xyz'[i % 3] * (i + 3)}{passage}{'uvw'[i % 3] * (i + 2)}") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = collections.defaultdict(set)
    for r in repeats.occurrences(df).collect():
        found[r["anchor"], r["repeat"], r["length"]].add((r["doc_id"], r["start"]))
    whole = {(i, i + 3) for i in range(6)}
    assert any(length == 130 and at == whole for (_, _, length), at in found.items())


def test_interval_tree_of_a_known_word():
    # suffixes of "banana" in order: a, ana, anana, banana, na, nana
    assert sorted(repeats.prefix_intervals([1, 3, 0, 0, 2], 1)) == [(1, 0, 2), (2, 4, 5), (3, 1, 2)]
