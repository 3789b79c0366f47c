from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest
import truth
from pyspark.sql import functions as F

from lexmill.catalog import fixtures as fx
from lexmill.config import STOP_WORDS
from lexmill.functions import text as tx
from lexmill.functions.text import tokens
from lexmill.operators import counting, features, vocabulary


@pytest.fixture(scope="module")
def plain(spark, small):
    """The same fit in plain Python."""
    rows = fx.documents(spark, small).select("doc_id", "text").collect()
    rows.sort(key=lambda r: (hashlib.md5(f"1:{r['doc_id']}".encode()).hexdigest(), r["doc_id"]))
    docs = [(r["doc_id"], truth.tokens(truth.clean([r["text"]]))) for r in rows]
    holdout = -(-3 * len(docs) // 10)
    train = docs[holdout:]
    return dict(docs), dict(train), truth.vocabulary([t for _, t in train])


def test_vocabulary_equals_plain_python(spark, small, plain):
    _, train, vocab = plain
    fit = fx.fitted(spark, small)
    assert fit.n_docs == len(train)
    assert {r["word"]: (r["n"], r["df"], r["idx"]) for r in fit.vocab.collect()} == vocab


@pytest.mark.parametrize("limit", [None, 200])
def test_tfidf_equals_plain_python(spark, small, plain, limit):
    docs, train, vocab = plain
    fit = fx.fitted(spark, small)
    got: dict[int, dict[int, float]] = {d: {} for d in docs}
    for r in features.tfidf(fx.cleaned(spark, small), fit.vocab, fit.n_docs, limit).collect():
        got[r["doc_id"]][r["idx"]] = r["tfidf"]
    for d, words in docs.items():
        assert got[d] == pytest.approx(truth.tfidf(words, vocab, len(train), limit), rel=1e-12)


def test_counts_add_up(spark, small):
    fit = fx.fitted(spark, small)
    n_tokens = fit.train.agg(F.sum(F.size(tokens(F.col("clean"))))).first()[0]
    assert fit.vocab.agg(F.sum("n")).first()[0] == n_tokens
    assert features.term_frequencies(fit.train).agg(F.sum("n")).first()[0] == n_tokens
    indices = [r["idx"] for r in fit.vocab.select("idx").collect()]
    assert sorted(indices) == list(range(2, len(indices) + 2))


def test_large_vocabulary_lookup_equals_broadcast(spark):
    """A word holding a third of all rows, a frequent unknown word, and rows without a word."""
    words = ["hot"] * 400 + ["gone"] * 300 + [f"w{i}" for i in range(300)]
    rows = spark.createDataFrame(list(enumerate(words)) + [(5000 + i, None) for i in range(50)], "doc_id bigint, word string")
    vocab = spark.createDataFrame([("hot", 2, 9)] + [(f"w{i}", i + 3, 1) for i in range(0, 300, 2)], "word string, idx bigint, df bigint")
    one = features.lookup_words(rows, vocab, ["idx", "df"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        two = features.lookup_words(rows, vocab, ["idx", "df"], broadcast_bytes=10, frequent_rows=100).select(one.columns)
        assert "SortMergeJoin" in two._jdf.queryExecution().executedPlan().toString()
        got = two.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(got) == len(words) + 50
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, got), key=repr)


def test_ties_follow_first_appearance(spark):
    docs = spark.createDataFrame([(7, 2, "b a a"), (8, 1, "d c d")], "doc_id bigint, k bigint, clean string")
    got = vocabulary.fit_vocabulary(docs, "k").orderBy("idx").collect()
    assert [(r["word"], r["n"], r["df"], r["idx"]) for r in got] == [("d", 2, 1, 2), ("a", 2, 1, 3), ("c", 1, 1, 4), ("b", 1, 1, 5)]


def test_listing_starts_with_the_oov_entry(spark, small):
    first = vocabulary.top_entries(fx.fitted(spark, small).vocab, 3).orderBy("idx").collect()
    assert [r["idx"] for r in first] == [1, 2, 3] and first[0]["word"] == "***UNK***"


def test_fit_exchanges_words_not_documents(spark, small):
    """The words of a document are counted in its row, without an exchange."""
    rows = vocabulary.first_uses(fx.fitted(spark, small).train, "clean", "order_key")
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_tfidf_exchanges_one_number_per_document(spark, small):
    fit = fx.fitted(spark, small)
    rows = features.tfidf(fit.prepared, fit.vocab, fit.n_docs)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_row") == 1 and "partial_sum(n" in plan


def test_documents_with_one_order_key_are_ordered_by_id(spark):
    rows = [(9, 5, "late early"), (2, 5, "x first"), (4, 7, "other"), (1, 8, "late")]
    for n in (1, 3):
        docs = spark.createDataFrame(rows, "doc_id bigint, k bigint, clean string").repartition(n)
        got = [r["word"] for r in vocabulary.fit_vocabulary(docs, "k").orderBy("idx").collect()]
        assert got == ["late", "x", "first", "early", "other"]


def test_words_counted_in_columns(spark):
    texts = ["b a b", "", None, "A_b-a\tx\nx", " . ", "\u00c9t\u00e9 \u00e9t\u00e9 \u0130", "cr\rlf x\x0bx", "w " * 3000 + "last"]
    docs = spark.createDataFrame([(k // 2 if k else None, t) for k, t in enumerate(texts)], "doc_id int, clean string")
    numbered = features.with_row(docs.repartition(3))
    got = counting.counted_words(numbered, ["doc_id", features.ROW]).collect()
    listed = numbered.select(features.ROW, F.posexplode_outer(tokens(F.col("clean"))).alias("place", "word"))
    runs = listed.groupBy(features.ROW, "word").agg(F.min("place").alias("place"), F.count("place").alias("n")).collect()
    key = lambda rows: sorted((r["word"] or "", r["place"] or 0, r["n"] or 0) for r in rows)
    assert key(got) == key(runs) and len({r[features.ROW] for r in got}) == len(texts)


def test_slices_of_texts_change_nothing(spark, small, monkeypatch):
    batches = [pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(["a b a " * k for k in range(50)])], ["k", "text"])]
    whole = counting._counted(batches[0])
    parts = [counting._counted(b) for b in counting.sliced(iter(batches), 1, 40)]
    assert len(parts) > 20
    rows = lambda bs: sorted((tuple(r.values()) for b in bs for r in b.to_pylist()), key=repr)
    assert rows([whole]) == rows(parts)


def _skewed(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "the").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("w"), F.col("id") % 700)).alias("word"), "id"
    )
    words = rows.where("word is not null").select("word").distinct()
    return rows, words.where("word <> 'w7'").select("word", F.crc32("word").alias("idx"))


def test_next_frequent_words_are_broadcast_as_far_as_they_fit(spark, monkeypatch):
    """Rows of words answered by broadcast are not exchanged; of the others each meets its word once."""
    rows, vocab = _skewed(spark)
    expected = sorted(map(tuple, rows.join(vocab, "word", "left").select("id", "word", "idx").collect()))
    for limit in (0, 20_000, 1 << 26):
        monkeypatch.setattr(features, "FILLED_BYTES", limit)
        found = features.lookup_words(rows, vocab, ["idx"], broadcast_bytes=0, frequent_rows=500)
        assert sorted(map(tuple, found.select("id", "word", "idx").collect())) == expected
    met = rows.groupBy("word").agg(F.count("*").alias("_n"))
    assert [features._filled_bar(met, 500, limit) for limit in (0, 1000, 1 << 26)] == [500, 31, 1]  # "the" 1000 rows, null 40, other words 2 to 5


def test_salted_lookup_copies_a_word_by_its_own_number_of_rows(spark):
    rows, vocab = _skewed(spark)
    expected = sorted(map(tuple, rows.join(vocab, "word", "left").select("id", "word", "idx").collect()))
    found = features.lookup_words(rows, vocab, ["idx"], broadcast_bytes=0, frequent_rows=100, answer_bytes=0)
    assert sorted(map(tuple, found.select("id", "word", "idx").collect())) == expected
    # the rows are read for the join once, not for frequent and other words apart
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1


def test_texts_go_to_python_in_small_batches(spark):
    """Workers keep the most they ever held, so a batch is bounded by its bytes, not by 10 000 rows."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name)
    spark.conf.set(name, "64m")
    try:
        docs = spark.createDataFrame([(1, "a b a")], "doc_id bigint, clean string")
        assert counting.counted_words(docs, ["doc_id"]).count() == 2
        assert int(spark.conf.get(name).rstrip("b")) <= 4 << 20
        spark.conf.set(name, "1000b")
        counting.counted_words(docs, ["doc_id"])
        assert spark.conf.get(name) == "1000b"
    finally:
        spark.conf.set(name, held)


def test_stop_words_dropped_while_counting_as_by_cleaning(spark):
    rng = random.Random(4)
    bits = ["the", "The", "and", "of", "them", "cat", "CAT", "the_cat", "_", "of_", "caf\u00e9", "\u0130s", "x2", "it\u2019s", "t-shirt"]
    blanks = [" ", "  ", "\t", "\n", "\r\n", "\x0b", "\x0c", "\x1c", "\x1f", "\u00a0", "\u2028", ",", ";the;", "\x07", "\x85"]
    texts = ["", " ", "the and", "the", "_the_"] + ["".join(rng.choice(bits) + rng.choice(blanks) for _ in range(rng.randrange(30))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, t string").repartition(3)

    def counted(text, **how):
        rows = counting.counted_words(docs.select("doc_id", text.alias("clean")), ["doc_id"], **how).collect()
        return sorted(rows, key=lambda r: (r["doc_id"], r["word"] or ""))

    for stop in (STOP_WORDS, ("cat", "of_")):
        want = counted(tx.clean([F.col("t")], stop))
        assert counted(tx.plain([F.col("t")]), stop_words=stop) == want and any(r["word"] is None for r in want)
