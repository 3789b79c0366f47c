from __future__ import annotations

import zlib

import numpy as np
import pytest
from check_oracles import difference, sql_session
from pyspark.sql import functions as F

from lexmill.llm import language, licenses, nearest, quality, queries
from lexmill.llm.support import prefix_hash, span_hash

MIDDLE = "/root/testdata/sf0.01"


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_span_hash_depends_on_the_bytes_alone():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 4, 5000).astype(np.uint8)
    sums = prefix_hash(data)
    start = rng.integers(0, 4900, 2000)
    end = start + rng.integers(0, 8, 2000)
    hashes = span_hash(sums, start, end)
    by_bytes: dict = {}
    for a, b, h in zip(start, end, hashes):
        by_bytes.setdefault(data[a:b].tobytes(), set()).add(h)
    assert all(len(h) == 1 for h in by_bytes.values())
    assert len({next(iter(h)) for h in by_bytes.values()}) == len(by_bytes)


# Nearest neighbours


def exact_neighbours(rows, asked, k=20):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    out = {}
    for name, vector in asked:
        scores = (x * np.array(vector, float)).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != name]
        seen, best = set(), []
        for i in order:
            if ids[i] not in seen and len(best) < k:
                seen.add(ids[i])
                best.append((int(ids[i]), scores[i]))
        out[name] = best
    return out


def by_query(df):
    out: dict = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_recall_and_scores(spark):
    vectors = spark.read.parquet(f"{MIDDLE}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    want = exact_neighbours(rows, [r for r in rows if r[0] % 20 == 0])
    got = by_query(queries.QUERIES["op1_nearest"](spark, MIDDLE))
    assert got.keys() == want.keys()
    hits = [len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / len(want[q]) for q in want]
    assert np.mean(hits) >= 0.9
    for q in want:
        assert len(got[q]) == len(want[q]) and got[q] == sorted(got[q], key=lambda x: (-x[1], x[0]))
        true = dict(want[q])
        assert all(abs(true[v] - s) < 1e-12 for v, s in got[q] if v in true)


def test_odd_vectors_and_copies(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 16)
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(50)]  # copies of one vector
    rows += [(200, [3 * v for v in rows[0][1]]), (5, rows[7][1])]  # a long one, a repeated id
    usable = list(rows)
    rows += [
        (300, None), (301, [0.0] * 6), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6),
        (304, [float("inf")] * 6), (305, [1.0, 2.0]), (306, []), (None, rows[3][1]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    df = df.withColumns({"id": F.lit("x"), "vector": F.lit(1), "bucket": F.lit(2)}).repartition(4)
    asked = df.where("vec_id in (0, 5, 20, 300, 301, 305)")
    want = exact_neighbours(usable, [r for r in usable if r[0] in (0, 20)], 10)
    got = by_query(nearest.nearest(df, asked, 10, tables=10, probes=32))
    assert set(got) == {0, 5, 20}
    for q, best in want.items():  # all signed axes are probed, so the answer is exact, ties by id included
        assert [v for v, _ in got[q]] == [v for v, _ in best]
    assert 5 not in {v for v, _ in got[5]}


def test_few_or_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    none = spark.createDataFrame([], schema)
    assert nearest.nearest(none, none).count() == 0
    one = spark.createDataFrame([(1, [1.0, 0.0])], schema)
    assert nearest.nearest(one, one).count() == 0
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [-1.0, 0.5])], schema)
    assert [tuple(r) for r in nearest.nearest(two, two.where("vec_id = 1")).collect()] == [(1, 1, 2, -1.0)]
    assert nearest.nearest(two, none).count() == 0


def test_pseudo_rotations_keep_lengths():
    index = nearest.CrossPolytope(9, 2.0)
    x = np.random.default_rng(0).standard_normal((50, 9))
    x *= 2 / np.linalg.norm(x, axis=1).max()
    assert index.width == 16
    assert np.allclose(np.linalg.norm(index._unit(x, False), axis=1), 1)
    assert np.allclose(np.linalg.norm(index._turned(index._unit(x, True), 3)[:, :16], axis=1), 1)
    assert (index.probes(x, 1) % 32 == np.stack([index._turned(index._unit(x, True), t).argmax(1) for t in range(10)], 1)).all()


# Quality


@pytest.fixture(scope="module")
def judged(spark):
    return quality.classify(
        spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    ).cache()


def test_held_out_accuracy(spark, judged):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = judged.join(labels, "doc_id").where("held_out").collect()
    right = np.mean([r["predicted"] == r["quality"] for r in rows])
    assert len(rows) > 500 and right >= 0.97
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.99


def test_folds_and_ranges(judged):
    rows = judged.collect()
    assert len(rows) == 10_000 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_discriminant_equals_the_densities():
    rng = np.random.default_rng(3)
    d = 4
    x = [rng.standard_normal((300, d)) @ rng.standard_normal((d, d)), rng.standard_normal((200, d)) + 1]
    total = np.stack([np.c_[np.ones(len(v)), v].T @ np.c_[np.ones(len(v)), v] for v in x])
    model = quality.fit(total)
    every = np.concatenate(x)
    z = [(v - every.mean(0)) / every.std(0) for v in x]
    raw = [np.cov(v.T, bias=True) for v in z]
    pooled = (300 * raw[0] + 200 * raw[1]) / 500
    density = []
    for k in (0, 1):
        c = (1 - quality.POOLED) * raw[k] + quality.POOLED * pooled
        c = (1 - quality.DIAGONAL) * c + quality.DIAGONAL * np.diag(np.diag(c)) + quality._FLOOR * np.eye(d)
        away = (every - every.mean(0)) / every.std(0) - z[k].mean(0)
        density.append(-0.5 * ((away @ np.linalg.inv(c) * away).sum(1) + np.linalg.slogdet(c)[1]))
    want = 1 / (1 + np.exp(-(density[1] - density[0] + np.log(200 / 300))))
    assert np.allclose(model.scores(every), want)


def test_quality_edges(spark, edge, empty):
    labels = spark.createDataFrame(
        [(d, d % 2, "x") for d in range(1, 19)] + [(None, 1, "x"), (3, None, "x"), (4, 7, "x")], "doc_id bigint, quality int, text string"
    )
    rows = quality.classify(edge, labels).collect()
    assert len(rows) == edge.count() and all(np.isfinite(r["score"]) for r in rows)
    one_class = quality.classify(edge, labels.where("quality = 1")).collect()
    assert {r["score"] for r in one_class} == {1 / (1 + np.exp(-500.0))}
    assert {r["score"] for r in quality.classify(edge, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(empty, labels).count() == 0
    assert all(np.isfinite(quality.statistics(t)).all() for t in ("", " ", "\n\n", "a", "a" * 100_000, "日本"))


# Language


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    rows = queries.QUERIES["op5_language"](spark, MIDDLE).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and not r["refused"] for r in rows)
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]) >= 0.98


@pytest.fixture(scope="module")
def model(spark):
    return language.train(spark.read.parquet(f"{MIDDLE}/documents.parquet"))


def test_mixed_texts_name_their_languages(spark, model):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").where("n_chars > 3000")
    parts = {lang: docs.where(F.col("lang") == lang).first()["text"][:2000] for lang in ("de", "fr", "es")}
    for names in (("de",), ("de", "fr"), ("es", "fr")):
        text = " ".join(parts[n] for n in names)
        _, score, found, refused = language._judge(model, text, np.frombuffer(text.encode(), np.uint8))
        assert {n for n, share in found if share > 0.05} == set(names) and not refused
        assert score == found[0][1] and abs(sum(s for _, s in found) - 1) < 1e-9
        if len(names) == 2:
            assert all(0.3 < s < 0.7 for n, s in found if n in names)


def test_shares_have_the_largest_likelihood():
    rng = np.random.default_rng(0)
    p = rng.random((3, 50))
    p /= p.sum(axis=1, keepdims=True)
    n = rng.integers(0, 40, 50).astype(float)
    share, fit = language._maximise(p[:2], n)
    grid = max(float(np.log(np.array([a, 1 - a]) @ p[:2]) @ n) for a in np.linspace(0.001, 0.999, 999))
    assert abs(share.sum() - 1) < 1e-9 and fit >= grid - 0.5


def test_trigrams_ignore_case_and_separators():
    grams = lambda t: sorted(language.trigrams(np.frombuffer(t.encode(), np.uint8)).tolist())
    assert grams("Élan VITAL") == grams("élan,,,  vital") == grams("élan\nvital!")
    assert grams("") == grams("123 !!") == []


def test_language_edges(spark, edge, empty, model):
    rows = language.identify(edge, model).collect()
    assert len(rows) == edge.count()
    by = {r["doc_id"]: r for r in rows}
    assert [by[d]["lang_pred"] for d in (1, 2, 3, 10, 11)] == ["und"] * 5
    assert all(by[d]["score"] == 0 and by[d]["refused"] for d in (1, 2, 3, 10, 11))
    assert by[12]["lang_pred"] in model.languages
    kept = language.accepted(edge, model)
    assert kept.schema == edge.schema and {r["doc_id"] for r in kept.collect()}.isdisjoint({1, 2, 3, 10, 11})
    assert language.train(empty).languages == []
    assert language.identify(edge, language.train(empty)).select("lang_pred").distinct().collect()[0][0] == "und"
    assert language.identify(empty, model).count() == 0


# Licenses


def test_scan_equals_sql(spark):
    for sf in ("/root/testdata/sf0.001", MIDDLE):
        assert difference(queries.QUERIES["op10_licenses"](spark, sf), sql_session(sf), licenses.oracle()) is None


def test_scan_uses_built_in_functions_only(spark):
    plan = queries.QUERIES["op10_licenses"](spark, MIDDLE)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))


def test_own_templates_and_edges(spark, edge, empty):
    templates = spark.createDataFrame(
        [("long", " ".join(f"term{i}" for i in range(40))), ("null", None), ("short", "two words"), (None, "a b c d"), ("long", "other text of it")],
        "license_id string, text string",
    )
    words = [f"term{i}" for i in range(40)]
    rows = [
        (1, "before " + " ".join(words) + " after"),
        (2, " ".join(words[:-5])),  # 33 of 38 shingles
        (3, " ".join(words[:30])),  # 28 of 38
        (4, "x " * 500 + "other, TEXT of it! " + "y " * 500),
        (5, None),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"hashes": F.lit(1), "t": F.lit(2)})
    got = {(r["doc_id"], r["n_found"], r["n_shingles"]) for r in licenses.scan(df, templates).collect()}
    assert got == {(1, 38, 38), (2, 33, 38), (4, 2, 2)}
    assert licenses.scan(edge).count() == 0 and licenses.scan(empty).count() == 0
    assert licenses.scan(df, templates.limit(0)).count() == 0


def test_the_number_of_templates_is_bounded(spark, edge, monkeypatch):
    monkeypatch.setattr(licenses, "MOST_TEMPLATES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        licenses.scan(edge)


# Registered queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, small, name):
    assert difference(queries.QUERIES[name](spark, small), sql_session(small), queries.ORACLES[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
