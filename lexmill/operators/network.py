"""The classifier's forward pass as joins, sums and array expressions.

Model tables: ``hidden(idx, weights)`` holds one row of input weights per vocabulary index,
``network(hidden_bias, output_weights, output_bias)`` is one row, its size set by the numbers of
neurons and classes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.config import OOV_INDEX
from lexmill.functions.weights import arg_max, dot, relu, sigmoid, term_weight
from lexmill.operators.features import ROW, idf_of, lookup_words, numbered_for, oov_idf, term_frequencies
from lexmill.operators.labels import decode_labels
from lexmill.operators.vocabulary import within_limit
from lexmill.sources.workspace import materialise

# Fixed precision: scores are rounded before the arg-max, because sums depend on row order in the last bits.
SCORE_DECIMALS = 9
# Fixed value: probabilities are kept this far from 0 and 1 in the loss.
EPSILON = 1e-7

NETWORK_SCHEMA = "hidden_bias array<double>, output_weights array<array<double>>, output_bias array<double>"


@dataclass(frozen=True)
class Model:
    """The fitted tables that scoring needs."""

    vocab: DataFrame
    labels: DataFrame
    hidden: DataFrame
    network: DataFrame
    n_docs: int
    neurons: int
    num_words: int | None = None


def network_table(
    spark: SparkSession,
    hidden_bias: Sequence[float],
    output_weights: Sequence[Sequence[float]],
    output_bias: Sequence[float],
) -> DataFrame:
    """``output_weights`` has one list per class."""
    row = (
        [float(v) for v in hidden_bias],
        [[float(v) for v in per_class] for per_class in output_weights],
        [float(v) for v in output_bias],
    )
    return spark.createDataFrame([row], NETWORK_SCHEMA)


def class_scores(hidden: Column, network: Column) -> Column:
    """Sigmoid output per class."""
    return F.transform(
        F.arrays_zip(network["output_weights"].alias("w"), network["output_bias"].alias("b")),
        lambda o: sigmoid(o["b"] + dot(hidden, o["w"])),
    )


def rounded(scores: Column) -> Column:
    return F.transform(scores, lambda p: F.round(p, SCORE_DECIMALS))


def predicted_class(scores: Column) -> Column:
    """Index of the best rounded score, the lowest one on ties."""
    return arg_max(rounded(scores)).cast("bigint")


def with_scores(df: DataFrame, sums: Sequence[Column], network: DataFrame) -> DataFrame:
    """Add ``scores`` from the weighted input sums of each neuron."""
    parts = network.select(F.struct("hidden_bias", "output_weights", "output_bias")).scalar()
    biased = F.zip_with("_sums", "_network.hidden_bias", lambda z, b: relu(z + b))
    return (
        df.withColumns({"_sums": F.array(*sums), "_network": parts})
        .withColumn("_hidden", biased)
        .withColumn("scores", class_scores(F.col("_hidden"), F.col("_network")))
        .drop("_sums", "_network", "_hidden")
    )


def scoring_words(model: Model) -> DataFrame:
    """Each known word with its idf and input weights: all a token needs for scoring."""
    words = idf_of(within_limit(model.vocab, model.num_words), model.n_docs)
    return words.join(model.hidden, "idx").select("word", "idx", "idf", "weights")


def score_documents(
    docs: DataFrame,
    model: Model,
    key: str = "doc_id",
    words: DataFrame | None = None,
    keep: Sequence[str] = (),
    stop_words: Sequence[str] = (),
    **limits: int | bool,
) -> DataFrame:
    """``(doc_id, scores, label_idx)`` for every document, those without tokens included, and the columns in ``keep``.

    Documents are rows: those that share an id or have none are scored each by itself. Unknown words share one index whose weight depends on their joint count, so that
    count is summed per document and weighted at the end. The sums of a document combine before
    their exchange: it holds a few numbers per document. Without ``words`` the dictionary is stored first. Texts that still hold
    ``stop_words`` lose them while their words are counted.
    """
    dictionary = materialise(scoring_words(model), "scoring_words") if words is None else words
    columns = ["idx", "idf", "weights"]
    numbered, fits = numbered_for(docs, dictionary, columns, **limits)
    counts = term_frequencies(numbered, key, [*keep, ROW], keep_empty=True, stop_words=stop_words)
    found = lookup_words(counts, dictionary, columns, **{**limits, "fits": fits})
    weight = term_weight(F.col("n")) * F.col("idf")
    unknown = F.when(F.col("word").isNotNull() & F.col("idx").isNull(), F.col("n"))
    sums = found.groupBy(ROW, key, *keep).agg(
        F.sum(unknown).alias("unknown"),
        *[F.sum(weight * F.get("weights", F.lit(j))).alias(f"z{j}") for j in range(model.neurons)],
    )
    oov = model.hidden.where(F.col("idx") == OOV_INDEX).select("weights").scalar()
    oov_weight = term_weight(F.col("unknown")) * oov_idf(model.n_docs)
    zero = F.lit(0.0)
    z = [
        F.coalesce(F.col(f"z{j}"), zero) + F.coalesce(oov_weight * F.get("_oov", F.lit(j)), zero)
        for j in range(model.neurons)
    ]
    raw = with_scores(sums.withColumn("_oov", oov), z, model.network)
    scored = raw.select(key, *keep, rounded(F.col("scores")).alias("scores"))
    return scored.withColumn("label_idx", arg_max(F.col("scores")).cast("bigint"))


def predict_labels(
    docs: DataFrame,
    model: Model,
    key: str = "doc_id",
    words: DataFrame | None = None,
    keep: Sequence[str] = (),
    stop_words: Sequence[str] = (),
    **limits: int | bool,
) -> DataFrame:
    """``(doc_id, label, score)``: the predicted label of every document and its score, and the columns in ``keep``."""
    scored = score_documents(docs, model, key, words, keep, stop_words, **limits)
    best = scored.select(key, *keep, "label_idx", F.array_max("scores").alias("score"))
    return decode_labels(best, "label_idx", model.labels).select(key, *keep, "label", "score")


def cross_entropy(scores: Column, target: Column) -> Column:
    """Loss of one row: the scores are scaled to sum to one first. Scores that are all zero give the largest loss."""
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)
    share = F.coalesce(F.try_divide(F.get(scores, target.cast("int")), total), F.lit(0.0))
    return -F.log(F.least(F.greatest(share, F.lit(EPSILON)), F.lit(1 - EPSILON)))
