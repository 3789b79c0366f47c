from __future__ import annotations

import math

import numpy as np
import pytest
import truth
from pyspark.sql import functions as F

from lexmill.catalog import fixtures as fx
from lexmill.functions.weights import arg_max, one_hot
from lexmill.operators import features, labels, metrics, network
from lexmill.sources import workspace


def forward(x: dict[int, float], divisor: float, k: int) -> list[float]:
    z = [j / 10 + sum(v * (((31 * i + 17 * j) % 101 - 50) / divisor) for i, v in x.items()) for j in range(5)]
    h = [max(v, 0.0) for v in z]
    outs = [c / 100 + sum(h[j] * ((13 * j + 7 * c) % 11 - 5) / 5 for j in range(5)) for c in range(k)]
    return [1 / (1 + math.exp(-o)) for o in outs]


def test_scores_equal_plain_python(spark, small):
    fit = fx.fitted(spark, small)
    model = fx.fixed_model(spark, small, None, 1000.0)
    vocab = {r["word"]: (r["n"], r["df"], r["idx"]) for r in fit.vocab.collect()}
    extra = [(10_001, []), (10_002, ["neverseen", "neverseen", "other"])]
    docs = [(r["doc_id"], truth.tokens(r["clean"])) for r in fit.prepared.collect()] + extra
    frame = spark.createDataFrame([(d, " ".join(t)) for d, t in docs], "doc_id bigint, clean string")
    got = {r["doc_id"]: (r["scores"], r["label_idx"]) for r in network.score_documents(frame, model).collect()}
    assert len(got) == len(docs)
    for doc_id, tokens in docs:
        wanted = forward(truth.tfidf(tokens, vocab, fit.n_docs, None), 1000.0, 4)
        assert got[doc_id][0] == pytest.approx(wanted, abs=2e-9)
        assert got[doc_id][1] == int(np.argmax(np.round(wanted, 9)))


def test_scores_do_not_depend_on_how_words_are_looked_up(spark, small):
    model = fx.fixed_model(spark, small, None, 1000.0)
    docs = fx.fitted(spark, small).prepared.select("doc_id", "clean")
    docs = docs.unionByName(spark.createDataFrame([(-1, ""), (-2, "nowhere " * 500)], docs.schema))
    one = network.score_documents(docs, model)
    rows = lambda df: {r["doc_id"]: (r["scores"], r["label_idx"]) for r in df.collect()}
    a = rows(one)
    for limits in ({"broadcast_bytes": 1000}, {"broadcast_bytes": 1000, "answer_bytes": 0}):
        b = rows(network.score_documents(docs, model, frequent_rows=50, **limits))
        assert a.keys() == b.keys() and len(a) == docs.count()
        for d in a:
            assert a[d][0] == pytest.approx(b[d][0], abs=2e-9) and a[d][1] == b[d][1]


def test_a_small_batch_does_not_move_a_large_vocabulary(spark, monkeypatch):
    vocab = spark.range(50_000).select(F.concat(F.lit("w"), "id").alias("word"), (F.col("id") + 2).alias("idx"))
    vocab = workspace.materialise(vocab, "vocabulary")
    docs = spark.createDataFrame([(1, "w5 w5 none w49999"), (2, ""), (None, "w7")], "doc_id bigint, clean string")
    counts = features.term_frequencies(docs, keep_empty=True)
    plans = {}

    def noted(df, name, *a, **k):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return workspace.materialise(df, name, *a, **k)

    monkeypatch.setattr(features, "materialise", noted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = features.lookup_words(counts, vocab, ["idx"], broadcast_bytes=100_000)
        got = sorted((r["doc_id"] or 0, r["word"] or "", r["n"] or 0, r["idx"] or 0) for r in found.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [(0, "w7", 1, 9), (1, "none", 1, 0), (1, "w49999", 1, 50_001), (1, "w5", 2, 7), (2, "", 0, 0)]
    assert set(plans) == {"words_counted", "words_met"} and "BroadcastHashJoin" in plans["words_met"]


def test_one_document_of_many_words(spark):
    text = " ".join(f"w{i % 7000}" for i in range(20_000))
    docs = spark.createDataFrame([(1, text), (2, "a b a"), (3, "")], "doc_id bigint, clean string")
    got = features.term_frequencies(docs, keep_empty=True).collect()
    assert sum(r["n"] for r in got if r["doc_id"] == 1) == 20_000 and sum(r["doc_id"] == 1 for r in got) == 7000
    assert sorted((r["word"] or "", r["n"] or 0) for r in got if r["doc_id"] != 1) == [("", 0), ("a", 2), ("b", 1)]
    assert "Exchange" not in features.term_frequencies(docs)._jdf.queryExecution().executedPlan().toString()


def test_arg_max_takes_the_lowest_index(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.7],), ([0.5, 0.5, 0.5],)], "p array<double>")
    assert [r[0] for r in df.select(arg_max(F.col("p"))).collect()] == [1, 0]


def test_one_hot_sums_to_one(spark):
    df = spark.range(4).select(one_hot(F.col("id"), F.lit(4).cast("bigint")).alias("v"))
    assert [r["v"] for r in df.orderBy(F.array_position("v", F.lit(1.0))).collect()] == np.eye(4).tolist()


def test_loss_is_clipped_and_scaled(spark):
    df = spark.createDataFrame([([0.2, 0.6], 1, 1), ([0.0, 1.0], 1, 0)], "scores array<double>, label_idx bigint, target_idx bigint")
    row = metrics.test_metrics(df).first()
    assert row["loss"] == pytest.approx((-math.log(0.75) - math.log(1e-7)) / 2)
    assert row["accuracy"] == 0.5


def test_unknown_label_raises_only_when_strict(spark):
    rows = spark.createDataFrame([("a",), ("zz",)], "l string")
    fit = labels.fit_labels(rows.where("l = 'a'"), "l")
    assert {r["l"]: r["label_idx"] for r in labels.encode_labels(rows, "l", fit).collect()} == {"a": 0, "zz": None}
    with pytest.raises(Exception, match="unknown to the encoder: zz"):
        labels.encode_labels(rows, "l", fit, strict=True).collect()


def test_labels_sort_by_code_point(spark):
    names = ["b", "B", "é", "a", "Z", "10", "9"]
    fit = labels.fit_labels(spark.createDataFrame([(x,) for x in names], "l string"), "l")
    assert [r["label"] for r in fit.orderBy("label_idx").collect()] == sorted(names)


def test_class_counts_are_checked():
    labels.require_classes(10_000_000)
    with pytest.raises(labels.JobConfigError):
        labels.require_classes(0)


def test_labels_survive_every_kind_of_lookup(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"l{i}") for i in range(300)] + [(300, None)], "id bigint, l string")
    fit = labels.fit_labels(rows, "l")
    wanted = sorted(map(tuple, labels.encode_labels(rows, "l", fit).select("id", "label_idx").collect()))
    for limits in ({"broadcast_bytes": 0, "frequent_rows": 5}, {"broadcast_bytes": 0, "frequent_rows": 5, "answer_bytes": 0}):
        got = labels.encode_labels(rows, "l", fit, **limits).select("id", "label_idx").collect()
        assert sorted(map(tuple, got)) == wanted
