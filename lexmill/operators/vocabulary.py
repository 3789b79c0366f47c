"""Vocabulary: counts, document frequencies and the frequency-ordered index.

Documents come as cleaned text, one row each. It is stored as such, being much smaller than its token
arrays, and split where the tokens are used; it is never exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.config import OOV_INDEX, OOV_WORD
from lexmill.functions.text import tokens
from lexmill.operators.counting import counted_words
from lexmill.operators.order import number_rows
from lexmill.sources.workspace import materialise


def explode_words(docs: DataFrame, words: Column, *keep: str) -> DataFrame:
    """One row per element of ``words``.

    The outer form with a filter behind it: for the inner form the optimiser adds a test that
    the array is not empty and moves it below, which would work the array out twice.
    """
    return docs.select(*keep, F.explode_outer(words).alias("word")).where(F.col("word").isNotNull())


def word_counts(docs: DataFrame, column: str = "clean") -> DataFrame:
    """Occurrences of each word; counted before the exchange, so frequent words cost one row per task."""
    return explode_words(docs, tokens(F.col(column))).groupBy("word").agg(F.count("*").alias("n"))


def document_frequencies(docs: DataFrame, column: str = "clean") -> DataFrame:
    """Documents containing each word. A document holds its own tokens, so no distinct pairs are exchanged."""
    return explode_words(docs, F.array_distinct(tokens(F.col(column)))).groupBy("word").agg(F.count("*").alias("df"))


def first_uses(docs: DataFrame, column: str, *keep: str) -> DataFrame:
    """``(keep, word, place, hits)``: the different words of each row, where each first stands and how often."""
    return counted_words(docs, keep, column).where(F.col("word").isNotNull()).withColumnRenamed("n", "hits")


def word_statistics(docs: DataFrame, order_key: str, column: str = "clean", id_column: str = "doc_id") -> DataFrame:
    """Per word: occurrences, documents, and where it first appears in the order of ``order_key``, ties by id.

    Each document yields one row per different word. All aggregates are numbers: they combine before the one
    exchange, on the word. Should documents share a key, the words first met in those are looked at again with their ids.
    """
    rows = first_uses(docs, column, order_key)
    stats = materialise(
        rows.groupBy("word").agg(
            F.sum("hits").alias("n"),
            F.count("*").alias("df"),
            F.min(order_key).alias("first_doc"),
            F.min_by("place", order_key).alias("first_place"),
        ),
        "word_statistics",
    )
    shared = materialise(
        docs.groupBy(order_key).agg(F.count("*").alias("_n")).where("_n > 1").select(order_key), "shared_keys"
    )
    nothing = F.lit(None).cast(docs.schema[id_column].dataType)
    if shared.isEmpty():
        return stats.withColumn("first_id", nothing)
    again = first_uses(docs.join(shared, order_key, "left_semi"), column, order_key, id_column)
    exact = again.groupBy("word", F.col(order_key).alias("first_doc")).agg(
        F.min(F.struct(id_column, "place")).alias("_first")
    )
    return stats.join(exact, ["word", "first_doc"], "left").select(
        "word", "n", "df", "first_doc",
        F.coalesce(F.col(f"_first.{id_column}"), nothing).alias("first_id"),
        F.coalesce("_first.place", "first_place").alias("first_place"),
    )


def fit_vocabulary(docs: DataFrame, order_key: str, column: str = "clean", path: str | None = None) -> DataFrame:
    """``vocab(word, n, df, idx)``: words by falling count, ties by first appearance, numbered from 2.

    Index 1 stands for unknown words, 0 is unused. The counts are stored before they are
    ordered, so the corpus is read once. ``path`` stores the result.
    """
    order = [F.desc("n"), F.col("first_doc"), F.col("first_id"), F.col("first_place"), F.col("word")]
    stats = word_statistics(docs, order_key, column)
    vocab = number_rows(stats, order, "idx", start=OOV_INDEX + 1).select("word", "n", "df", "idx")
    return vocab if path is None else materialise(vocab, "vocabulary", path)


def within_limit(vocab: DataFrame, num_words: int | None) -> DataFrame:
    """The words a word limit leaves: indices below it."""
    return vocab if num_words is None else vocab.where(F.col("idx") < num_words)


def index_width(n_words: int, num_words: int | None) -> int:
    """Number of columns of the document-term matrix."""
    return n_words + 2 if num_words is None else num_words


def with_oov(vocab: DataFrame) -> DataFrame:
    """The index as a listing, with the entry for unknown words in first place."""
    spark = vocab.sparkSession
    oov = spark.range(1).select(F.lit(OOV_WORD).alias("word"), F.lit(OOV_INDEX).cast("bigint").alias("idx"))
    return oov.unionByName(vocab.select("word", "idx"))


def word_count_report(vocab: DataFrame, num_words: int | None = None) -> DataFrame:
    """Count and share of each word, the share taken over all words, for the ``num_words`` first ones."""
    total = vocab.agg(F.sum("n")).scalar()
    shares = vocab.select(
        "idx", "word", F.col("n").alias("quantity"), (F.col("n") / total * 100).alias("percent")
    )
    return shares if num_words is None else shares.where(F.col("idx") < OOV_INDEX + 1 + num_words)


def top_words(vocab: DataFrame, k: int = 20) -> DataFrame:
    return vocab.where(F.col("idx") <= OOV_INDEX + k).select("word", "n", "idx").orderBy("idx")


def top_entries(vocab: DataFrame, k: int = 20) -> DataFrame:
    return with_oov(vocab.where(F.col("idx") <= k)).orderBy("idx")


def corpus_statistics(docs: DataFrame, train: DataFrame, vocab: DataFrame, label: str) -> DataFrame:
    """Documents, classes overall and in training, and words including the entry for unknown ones."""
    n_docs = train.agg(F.count("*")).scalar()
    n_train_classes = train.agg(F.count_distinct(label)).scalar()
    n_words = vocab.agg(F.count("*") + 1).scalar()
    return docs.agg(F.count_distinct(label).alias("n_classes")).select(
        n_docs.alias("n_documents"),
        "n_classes",
        n_train_classes.alias("n_classes_train"),
        n_words.alias("n_unique_words"),
    )
