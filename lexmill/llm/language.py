"""Language identification of texts in several languages.

A model has one distribution over hashed letter trigrams per language. A text is taken as a mixture: expectation
maximisation estimates the share of each language from the likelihoods of the text's trigrams. Starting from
the best single language, languages are added while the likelihood, less a penalty for each language that grows with
the logarithm of the number of trigrams, rises. The prediction is the language of the largest share.

Texts without a letter, and null texts, are ``und`` with score 0 and no languages. Repeated rows are judged each. A text of
letters is refused if every language explains it worse than noise over all trigrams.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.support import held_out, slices, utf8

UNKNOWN = "und"
BUCKETS = 1 << 15
_ROUNDS = 12
_SMOOTHING = 0.5


def _letter_codes() -> np.ndarray:
    """A number per byte: 0 for what separates words, one for each ASCII letter whatever its case, one for each byte from 128 on."""
    code = np.zeros(256, np.uint32)
    letters = np.arange(97, 123)
    code[letters] = code[letters - 32] = np.arange(1, 27)
    code[128:] = np.arange(27, 155)
    return code


_CODE = _letter_codes()


def trigrams(text: np.ndarray) -> np.ndarray:
    """Bucket of every three neighbouring symbols with a letter in the middle; runs of separators count as one.

    Letters beyond ASCII are bytes of UTF-8; the capitals of Latin-1 (second byte below 0x9F after 0xC3) are lowered.
    """
    if not len(text):
        return np.zeros(0, np.int64)
    capital = np.zeros(len(text), bool)
    capital[1:] = (text[:-1] == 0xC3) & (text[1:] >= 0x80) & (text[1:] < 0x9F)
    code = _CODE[np.where(capital, text + np.uint8(32), text)] if capital.any() else _CODE[text]
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] > 0) | (code[:-1] > 0)
    code = np.concatenate([[np.uint32(0)], code[keep], [np.uint32(0)]]).astype(np.uint32)
    middle = code[1:-1] > 0
    three = (code[:-2] * np.uint32(155) + code[1:-1]) * np.uint32(155) + code[2:]
    return ((three[middle] * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int64)


@dataclass
class LanguageModel:
    languages: list[str]
    probability: np.ndarray  # languages x buckets

    def mixture(self, grams: np.ndarray) -> tuple[list[tuple[str, float]], float]:
        """The languages of a text with their shares, largest first, and the log-likelihood per trigram."""
        used, n = np.unique(grams, return_counts=True) if len(grams) < 4096 else _counted(grams)
        p = self.probability[:, used]
        n = n.astype(float)
        total = n.sum()
        alone = np.log(p) @ n
        chosen = [int(alone.argmax())]
        share, best = np.ones(1), alone.max()
        penalty = math.log(total + 1)
        while len(chosen) < len(p):
            # the likelihood is concave in the shares, so its slope towards a language bounds what that can add
            slope = p @ (n / (share @ p[chosen])) - total
            slope[chosen] = 0
            trials = []
            for k in np.flatnonzero(slope > penalty).tolist():
                weight, fit = _maximise(p[[*chosen, k]], n)
                trials.append((fit, -k, weight))
            if not trials:
                break
            fit, k, weight = max(trials, key=lambda x: x[:2])
            if fit - penalty <= best:
                break
            best, share = fit - penalty, weight
            chosen.append(-k)
        fit = float(np.log(share @ p[chosen]) @ n) / total
        order = np.lexsort((chosen, -share))
        return [(self.languages[chosen[k]], float(share[k])) for k in order], fit

    @property
    def noise(self) -> float:
        return -math.log(self.probability.shape[1])


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.bincount(grams, minlength=BUCKETS)
    used = np.flatnonzero(n)
    return used, n[used]


def _maximise(p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the rows of ``p`` that make the trigrams likeliest, and the log-likelihood, by expectation maximisation."""
    share = np.full(len(p), 1 / len(p))
    total = n.sum()
    for _ in range(_ROUNDS):
        joint = share[:, None] * p
        share = (joint / joint.sum(axis=0)) @ n / total
    return share, float(np.log(share @ p) @ n)


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> LanguageModel:
    """Counts over all documents that may be learned from. The driver gets one row per language and bucket that occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for b in slices(batches):
            data, at = utf8(b.column(1))
            for k, lang in enumerate(b.column(0).to_pylist()):
                counts = seen.setdefault(lang, np.zeros(BUCKETS, np.int64))
                counts += np.bincount(trigrams(data[at[k] : at[k + 1]]), minlength=BUCKETS)
        for lang, counts in seen.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(counts[used])], ["lang", "bucket", "n"]
            )

    learned = docs.where(
        F.col(lang_column).isNotNull() & F.col(text_column).isNotNull() & ~held_out(F.col(id_column))
    ).select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    counted = learned.mapInArrow(count, "lang string, bucket bigint, n bigint")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(rows.column("lang").to_pylist()))
    place = {lang: k for k, lang in enumerate(languages)}
    counts = np.full((len(languages), BUCKETS), _SMOOTHING)
    row = np.array([place[x] for x in rows.column("lang").to_pylist()], np.int64)
    counts[row, rows.column("bucket").to_numpy()] += rows.column("n").to_numpy()
    return LanguageModel(languages, counts / counts.sum(axis=1, keepdims=True))


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _judge(model: LanguageModel, text: str | None, raw: np.ndarray) -> tuple[str, float, list[tuple[str, float]], bool]:
    """(prediction, score, languages with shares, refused)."""
    if text is None or not _has_letter(text) or not model.languages:
        return UNKNOWN, 0.0, [], True
    grams = trigrams(raw)
    if not len(grams):
        return UNKNOWN, 0.0, [], True
    found, fit = model.mixture(grams)
    return found[0][0], min(found[0][1], 1.0), found, fit < model.noise


def _judged(model: LanguageModel, text: pa.Array) -> list[tuple[str, float, list[tuple[str, float]], bool]]:
    data, at = utf8(text.fill_null(""))
    return [_judge(model, t, data[at[k] : at[k + 1]]) for k, t in enumerate(text.to_pylist())]


def identify(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, languages, refused) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = _judged(shared.value, b.column(2))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.float64()),
                    pa.array([[{"lang": x, "share": s} for x, s in r[2]] for r in rows], kinds),
                    pa.array([r[3] for r in rows], pa.bool_()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "languages", "refused"],
            )

    kinds = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
    texts = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        held_out(F.col(id_column)).alias("held_out"),
        F.col(text_column).cast("string").alias("text"),
    )
    schema = (
        "doc_id bigint, held_out boolean, lang_pred string, score double, "
        "languages array<struct<lang: string, share: double>>, refused boolean"
    )
    return texts.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is in the model's languages, as they are; nothing is exchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield b.filter(pa.array([not r[3] for r in _judged(shared.value, b.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
