from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from lexmill.llm import simhash


def plain_print(text):
    """The votes of each bit, term by term."""
    data = text.lower().encode()
    words = [m.group() for m in re.finditer(rb"[0-9a-z\x80-\xff]+", data)]
    hashed, cuts = simhash._words([text])
    assert len(hashed) == len(words) == cuts[-1]
    width = min(len(words), 5)
    shingle = [
        int(simhash.mix64(np.array([sum(int(hashed[i + k]) * int(simhash._FOLD[k]) for k in range(width)) + width & (1 << 64) - 1], np.uint64))[0])
        for i in range(len(words) - width + 1 if words else 0)
    ]
    terms = [collections.Counter(simhash.mix64(hashed).tolist()), collections.Counter(shingle)]
    votes = [0] * 128
    for counts in terms:
        for h, n in counts.items():
            second = simhash.mix64(np.array([h], np.uint64) * simhash._SECOND + np.uint64(1))[0]
            for bit in range(128):
                value = h if bit < 64 else int(second)
                votes[bit] += n.bit_length() if value >> (bit % 64) & 1 else -n.bit_length()
    return sum((v > 0) << k for k, v in enumerate(votes)).to_bytes(16, "little").hex()


def plain_rows(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256((r[1] or "").encode()).digest()))
    out = []
    for k, (d, t) in enumerate(order):
        text, following = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 3
        edited = text[: len(text) - n] + following[:n]
        own, other, after = (bytes.fromhex(plain_print(x)) for x in (text, edited, following))
        near = []
        for x in (other, after):
            h = sum((a ^ b).bit_count() for a, b in zip(own, x))
            near.append(max(0.0, math.cos(math.pi * h / 128)) if h else 1.0)
        out.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.hex(), other.hex(), *near))
    return out


def compare(got, want):
    key = lambda r: (repr(r[0]), *r[1:5], round(r[6], 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:7] for r in got], [r[5:7] for r in want])


def test_query_equals_plain(spark, small, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    short = [(d, t) for d, t in rows if len(t or "") < 2500]
    df = spark.createDataFrame(short, "doc_id bigint, text string").repartition(6)
    compare([tuple(r) for r in simhash.edited_prints(df).collect()], plain_rows(short))
    got = queries()["op13_fingerprints"](spark, small).collect()
    assert len(got) == len(rows)
    prints = {r["doc_id"]: bytes.fromhex(r["fingerprint"]) for r in got}
    for r in got:
        near = sum(sum((a ^ b).bit_count() for a, b in zip(prints[r["doc_id"]], p)) <= simhash.RADIUS for p in prints.values())
        assert r["n_within"] == (near - 1 if r["doc_id"] % 100 == 0 else None)
    edited, following = (np.array([r[c] for r in got if r["n_chars"] > 200]) for c in ("near_edited", "near_next"))
    assert np.median(edited) > 0.6 > 0.4 > np.median(following)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_odd_rows(spark, edge, empty, parts):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect() if len(r["text"] or "") < 2500]
    short = edge.where("text is null or length(text) < 2500").repartition(parts)
    compare([tuple(r) for r in simhash.edited_prints(short).collect()], plain_rows(rows))
    assert simhash.edited_and_near(edge).count() == edge.count() and simhash.edited_and_near(empty).count() == 0
    alone = spark.createDataFrame([(None, "one two three")], "doc_id bigint, text string")
    compare([tuple(r) for r in simhash.edited_prints(alone).collect()], plain_rows([(None, "one two three")]))


def test_a_third_of_all_rows_equal_in_id_and_text(spark):
    rows = [(7, "the same text again and again") if k % 3 == 0 else (k, f"text number {k} of many") for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    compare([tuple(r) for r in simhash.edited_prints(df).collect()], plain_rows(rows))


def test_equal_texts_in_other_batches_have_equal_prints():
    texts = ["some words that come back", "", "...", "a b", "x" * 5000, "some words that come back"]
    whole = simhash.fingerprints(texts)
    assert (whole == np.concatenate([simhash.fingerprints([t]) for t in texts])).all()
    assert [f.tobytes().hex() for f in whole] == [plain_print(t) for t in texts] and not whole[1].any() and not whole[2].any()


@pytest.mark.parametrize("radius,blocks", [(0, 1), (1, 3), (3, 4), (3, 6), (5, 7)])
def test_tables_find_all_within_the_radius(spark, radius, blocks):
    rng = random.Random(radius)
    prints = []
    for _ in range(40):
        base = rng.getrandbits(128)
        prints.append(base)
        for _ in range(6):
            prints.append(base ^ sum({1 << rng.randrange(128) for _ in range(rng.randint(0, radius + 2))}))
    table = spark.createDataFrame([(p.to_bytes(16, "little").hex(),) for p in prints], "fingerprint string")
    wanted = table.where(F.crc32("fingerprint") % 3 == 0)
    got = [tuple(r) for r in simhash.within_radius(table, wanted, radius, blocks).collect()]
    numbers = {p.to_bytes(16, "little").hex(): p for p in prints}
    asked = {r["fingerprint"] for r in wanted.collect()}
    want = [(a, b, (x ^ y).bit_count()) for a, x in numbers.items() if a in asked for b, y in numbers.items() if (x ^ y).bit_count() <= radius]
    assert sorted(got) == sorted(want)


def test_blocks_must_outnumber_the_radius(spark):
    table = spark.createDataFrame([("00" * 16,)], "fingerprint string")
    with pytest.raises(ValueError):
        simhash.within_radius(table, table, 3, 3)


def exchanged_bytes(df):
    """Bytes of the rows that the exchanges of a plan carry, before compression."""
    df.collect()
    left, total = [df._jdf.queryExecution().executedPlan()], 0
    while left:
        node = left.pop()
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("dataSize").value()
        left += [node.children().apply(k) for k in range(node.children().size())]
    return total


def test_entries_exchanged_are_small(spark):
    rng = random.Random(3)
    rows = [(rng.randbytes(16).hex(),) for _ in range(2000)]
    table = spark.createDataFrame(rows, "fingerprint string")
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        near = simhash.within_radius(table, table.limit(20))
        size = exchanged_bytes(near)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    # once to drop equal ones, then an entry in each of four tables
    assert 0 < size < len(rows) * (64 + 4 * 48) + 100_000
