"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Each text gives a row of statistics, transformed so that they are near to normal within a class. Per class the mean and the
covariance are estimated over all labelled documents that may be learned from; the covariance is shrunk towards its
diagonal and the covariance of both classes together. The score is the logistic function of the difference of the
two normal log-densities (Mahalanobis distances through cached Cholesky factors) and of the classes' frequencies.

Texts are taken whole, null as empty; an empty text has a row of statistics like any other. Labels other than 0 and 1 and null
ids teach nothing; if a class has no document, every score is the share of label 1, or 0.5 without labels.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.support import held_out, materialise, slices, texts_of

CUT = 0.3
#: Shares of the pooled covariance and of the diagonal in the shrunk one.
POOLED, DIAGONAL = 0.8, 0.2
_FLOOR = 0.03  # added to each variance of the standardised statistics
STATISTICS = (
    "characters", "words", "word_length", "word_length_spread", "capitals", "digits", "signs", "bars", "marks", "lines",
    "line_length", "distinct_words", "commonest_word", "repeated_word", "distinct_lines", "repeated_line", "sentence_words",
    "byte_entropy", "short_words", "distinct_pairs",
)


def _kinds() -> np.ndarray:
    """Class of each byte: 0 other, 1 capital, 2 digit, 3 sign, 4 bar, 5 exclamation or question mark, 6 full stop."""
    kind = np.zeros(256, np.int64)
    for k, letters in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "\"#$%&'()*+,-/:;<=>@[\\]^_`{}~", "|", "!?", "."), 1):
        kind[[ord(c) for c in letters]] = k
    return kind


_KIND = _kinds()


def statistics(text: str) -> list[float]:
    """The transformed statistics, in the order of ``STATISTICS``."""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = max(len(raw), 1)
    seen = np.bincount(raw, minlength=256)
    kinds = np.bincount(_KIND, weights=seen, minlength=7)
    share = seen[seen > 0] / n
    words = text.lower().split()
    w = max(len(words), 1)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    again = sum(a == b for a, b in pairwise(words))
    lines = [x for x in text.split("\n") if x.strip()]
    each_line = Counter(lines)
    rows = max(len(lines), 1)
    return [
        np.log1p(len(raw)),
        np.log1p(len(words)),
        np.log1p(lengths.mean()),
        np.log1p(lengths.std()),
        np.sqrt(kinds[1] / n),
        np.sqrt(kinds[2] / n),
        np.sqrt(kinds[3] / n),
        np.sqrt(kinds[4] / n),
        np.sqrt(kinds[5] / n),
        np.log1p(len(lines)),
        np.log1p(len(raw) / rows),
        np.log((len(counts) + 1) / (w + 1)),
        np.log((max(counts.values(), default=0) + 1) / (w + 1)),
        np.sqrt(again / w),
        len(each_line) / rows,
        np.sqrt((max(each_line.values(), default=1) - 1) / rows),
        np.log1p(len(words) / (kinds[5] + kinds[6] + 1)),
        float(-(share * np.log(share)).sum()),
        np.sqrt((lengths <= 3).sum() / w),
        np.log((len(set(pairwise(words))) + 1) / (w + 1)),
    ]


@dataclass
class Discriminant:
    """Class means, triangular factors of the inverse covariances, log-determinants and log-odds of label 1."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_dets: list[float]
    log_odds: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        density = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets):
            away = (z - mean) @ factor
            density.append(-0.5 * ((away * away).sum(axis=1) + log_det))
        odds = self.log_odds + (density[1] - density[0] if density else np.zeros(len(x)))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def document_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, stats) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = pa.array([statistics(t) for t in b.column(1).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), rows], ["doc_id", "stats"])

    return texts_of(docs, id_column, text_column).mapInArrow(run, "doc_id bigint, stats array<double>")


def train(stats: DataFrame, labels: DataFrame, label_column: str = "quality", id_column: str = "doc_id") -> Discriminant:
    """Counts, sums and products per class over all labelled documents outside the held-out fold.

    The driver gets one row per class and task, of as many numbers as there are pairs of statistics.
    """
    d = len(STATISTICS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros((d + 1, d + 1)) for k in (0, 1)}
        for b in batches:
            label = b.column(0).to_numpy()
            x = np.ones((b.num_rows, d + 1))
            x[:, 1:] = b.column(1).flatten().to_numpy().reshape(-1, d)
            for k in (0, 1):
                total[k] += x[label == k].T @ x[label == k]
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array([total[k].reshape(-1).tolist() for k in (0, 1)])], ["label", "moments"]
        )

    marked = labels.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(label_column).cast("int").alias("label"))
    learned = (
        stats.where(~held_out(F.col("doc_id")))
        .join(marked.where("label in (0, 1)"), "doc_id")
        .select("label", "stats")
        .mapInArrow(moments, "label int, moments array<double>")
        .select("label", F.posexplode("moments"))
        .groupBy("label", "pos")
        .agg(F.sum("col").alias("total"))
        .toArrow()
    )
    total = np.zeros((2, (d + 1) ** 2))
    total[learned.column("label").to_numpy(), learned.column("pos").to_numpy()] = learned.column("total").to_numpy()
    return fit(total.reshape(2, d + 1, d + 1))


def fit(total: np.ndarray) -> Discriminant:
    """The model from the matrices of sums of products of (1, statistics) of both classes."""
    n = total[:, 0, 0]
    d = total.shape[1] - 1
    log_odds = float(np.log(n[1] / n[0])) if n.all() else (0.0 if not n.any() else float(np.sign(n[1] - n[0]) * 500))
    both = total.sum(axis=0)
    if not n.all():
        return Discriminant(np.zeros(d), np.ones(d), [], [], [], log_odds)
    centre = both[0, 1:] / n.sum()
    variance = np.diag(both)[1:] / n.sum() - centre**2
    scale = np.sqrt(np.maximum(variance, 1e-12))
    means, covariances = [], []
    for k in (0, 1):
        mean = total[k, 0, 1:] / n[k]
        covariance = (total[k, 1:, 1:] / n[k] - np.outer(mean, mean)) / np.outer(scale, scale)
        means.append((mean - centre) / scale)
        covariances.append(covariance)
    pooled = (n[0] * covariances[0] + n[1] * covariances[1]) / n.sum()
    factors, log_dets = [], []
    for covariance in covariances:
        shrunk = (1 - POOLED) * covariance + POOLED * pooled
        shrunk = (1 - DIAGONAL) * shrunk + DIAGONAL * np.diag(np.diag(shrunk)) + _FLOOR * np.eye(d)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower).T)
        log_dets.append(2 * float(np.log(np.diag(lower)).sum()))
    return Discriminant(centre, scale, means, factors, log_dets, log_odds)


def score(stats: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of statistics."""
    shared = stats.sparkSession.sparkContext.broadcast(model)
    d = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = shared.value.scores(b.column(1).flatten().to_numpy().reshape(-1, d))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores)], ["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )


def classify(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    stats = materialise(document_statistics(docs, id_column, text_column), "statistics")
    return score(stats, train(stats, labels))
