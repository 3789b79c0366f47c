"""Sparse TF-IDF features: token lookup, counts per document, weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.config import OOV_INDEX
from lexmill.functions.weights import inverse_document_frequency, term_weight
from lexmill.operators.counting import counted_words
from lexmill.operators.vocabulary import within_limit
from lexmill.sources.workspace import BROADCAST_BYTES, fits_broadcast, materialise, row_bytes

# Fixed sizes of the lookup in a vocabulary too large to broadcast. A word is frequent if it has more
# rows than one task should take; raising the bar with the data bounds how many such words there are.
# The answers broadcast for frequent words are filled up to a bound with the next frequent ones, whose rows then stay where they are.
FREQUENT_ROWS = 1_000_000
FREQUENT_WORDS = 100_000
FILLED_BYTES = 64 * 1024 * 1024


def _filled_bar(met: DataFrame, bar: int, limit: int) -> int:
    """The lowest number of rows, a power of two less one and ``bar`` at most, above which the words' answers fit ``limit`` bytes."""
    level = F.length(F.bin("_n")).alias("level")
    sizes = met.groupBy(level).agg(F.sum(row_bytes(met)).alias("size")).orderBy(F.desc("level")).collect()
    so_far = 0
    for r in sizes:
        so_far += r["size"]
        if so_far > limit:
            break
        bar = min(bar, (1 << (r["level"] - 1)) - 1)
    return bar


def lookup_words(
    rows: DataFrame,
    vocab: DataFrame,
    columns: list[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    frequent_rows: int = FREQUENT_ROWS,
    answer_bytes: int = BROADCAST_BYTES,
    fits: bool | None = None,
    on: str = "word",
) -> DataFrame:
    """Left join of rows holding ``word``, or the column named in ``on``, with a stored vocabulary.

    A vocabulary within ``broadcast_bytes`` is broadcast, and the rows stay where they are; ``fits`` says
    so if the caller has measured it. Beyond that the different words of the rows, counted in each task
    first, are looked up once and stored with their number of rows; if they fit, they go to the vocabulary instead of it
    being exchanged, so what a small batch moves does not grow with the vocabulary. The part found is broadcast if it fits. Else
    the answers for words frequent in the rows, known or not, are broadcast if they fit ``answer_bytes``, with those of the next
    frequent words as long as they stay small; only the rows of the other words are exchanged, once, by word.
    If they do not fit, all rows are exchanged once by word and salt: a frequent word has as many salts as its number of rows asks for, and
    tasks know that number by the word's hash, for ``FREQUENT_WORDS`` words at most. So no task
    gets all the rows of a frequent word. The rows are read anew for every join and never stored: they must be
    the same each time.
    """
    wanted = vocab.select(on, *columns)
    if fits if fits is not None else fits_broadcast(wanted, broadcast_bytes):
        return rows.join(F.broadcast(wanted), on, "left")
    counts = materialise(rows.groupBy(on).agg(F.count("*").alias("_n")), "words_counted")
    if fits_broadcast(counts, broadcast_bytes):
        wanted = wanted.join(F.broadcast(counts.select(on)), on)  # the vocabulary stays where it lies
    met = materialise(counts.join(wanted, on, "left"), "words_met")
    if fits_broadcast(met, broadcast_bytes):
        return rows.join(F.broadcast(met.drop("_n")), on, "left")
    size = met.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total")).first()
    bar = max(frequent_rows, size["total"] // FREQUENT_WORDS)
    filled = _filled_bar(met, bar, min(answer_bytes, FILLED_BYTES))
    often = (F.col("_n") > filled) | F.col(on).isNull()
    answers = materialise(met.where(often).drop("_n").withColumnRenamed(on, "_word"), "frequent_words")
    same = F.col(on).eqNullSafe(F.col("_word"))
    if fits_broadcast(answers, answer_bytes):
        others = met.where(~often).drop("_n")
        by_answer = rows.join(F.broadcast(answers), same).drop("_word")
        without = rows.join(F.broadcast(answers.select("_word")), same, "left_anti")
        return by_answer.unionByName(without.join(others, on))
    share = F.ceil(F.col("_n") / bar).cast("bigint")
    copies = F.broadcast(
        met.where(F.col("_n") > bar).groupBy(F.xxhash64(on).alias("_hash")).agg(F.max(share).alias("_copies"))
    )

    def with_copies(df: DataFrame) -> DataFrame:
        """A word without an entry has one salt."""
        counted = df.withColumn("_hash", F.xxhash64(on)).join(copies, "_hash", "left").drop("_hash")
        return counted.withColumn("_copies", F.coalesce("_copies", F.lit(1).cast("bigint")))

    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1))
    salted = with_copies(rows).withColumn("_salt", F.monotonically_increasing_id() % F.col("_copies")).drop("_copies")
    answers = with_copies(met.drop("_n")).withColumn("_copy", every).drop("_copies").withColumnRenamed(on, "_word")
    same = same & (F.col("_salt") == F.col("_copy"))
    return salted.join(answers.hint("shuffle_hash"), same, "left").drop("_word", "_salt", "_copy")


def _index_or_oov() -> Column:
    return F.coalesce(F.col("idx"), F.lit(OOV_INDEX).cast("bigint"))


def lookup_index(rows: DataFrame, vocab: DataFrame, num_words: int | None = None, **limits: int) -> DataFrame:
    """Add ``idx``: the word's index, or 1 for a word unknown or beyond the word limit."""
    found = lookup_words(rows, within_limit(vocab, num_words), ["idx"], **limits)
    return found.withColumn("idx", _index_or_oov())


#: Name of the generated number that tells rows apart, whatever ids they have.
ROW = "_row"


def with_row(docs: DataFrame) -> DataFrame:
    """The rows with a number of their own. It holds for one reading of the rows: it goes along with what is made of a row."""
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def numbered_for(
    docs: DataFrame,
    words: DataFrame,
    columns: Sequence[str],
    fits: bool | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    **others: int,
) -> tuple[DataFrame, bool]:
    """Documents with their row number for a look-up of their words, and whether the words may be broadcast.

    A look-up that reads the documents more than once needs numbers that stay: the documents are then stored, not their words.
    """
    if fits is None:
        fits = fits_broadcast(words.select("word", *columns), broadcast_bytes)
    numbered = with_row(docs)
    return (numbered if fits else materialise(numbered, "numbered")), fits


def term_frequencies(
    docs: DataFrame,
    key: str = "doc_id",
    keep: Sequence[str] = (),
    keep_empty: bool = False,
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """``(doc_id, word, n)``: occurrences of each word in each document, with the columns named in ``keep``.

    A document is one row of cleaned text, or of plain text with the ``stop_words`` to drop, also if others have its id. With ``keep_empty`` one without tokens has one row
    whose word is null.
    """
    rows = counted_words(docs, [key, *keep], stop_words=stop_words).drop("place")
    return rows if keep_empty else rows.where(F.col("word").isNotNull())


def idf_of(vocab: DataFrame, n_docs: int | Column) -> DataFrame:
    """The vocabulary with each word's ``idf``."""
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    return vocab.withColumn("idf", inverse_document_frequency(n, F.col("df")))


def oov_idf(n_docs: int | Column) -> Column:
    """The unknown word was seen in no document."""
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    return inverse_document_frequency(n, F.lit(0))


def tfidf(
    docs: DataFrame,
    vocab: DataFrame,
    n_docs: int | Column,
    num_words: int | None = None,
    key: str = "doc_id",
    keep: Sequence[str] = (),
    keep_empty: bool = False,
    **limits: int,
) -> DataFrame:
    """Sparse rows ``(doc_id, idx, tfidf)``, with the columns of the document named in ``keep``.

    A document without tokens has no row, or with ``keep_empty`` one without index. Known words and
    indices are one to one, so their rows are final after the lookup. Only the unknown words, which share an
    index, are summed per document: the exchange holds a number for each document that has any. Documents
    are rows: those that share an id or have none are weighted each by itself.
    """
    words = idf_of(within_limit(vocab, num_words), n_docs)
    numbered, fits = numbered_for(docs, words, ["idx", "idf"], **limits)
    counts = term_frequencies(numbered, key, [*keep, ROW], keep_empty)
    found = lookup_words(counts, words, ["idx", "idf"], **{**limits, "fits": fits})
    known = F.col("idx").isNotNull()
    empty = F.col("word").isNull()
    placed = found.where(known | empty).select(key, *keep, "idx", (term_weight(F.col("n")) * F.col("idf")).alias("tfidf"))
    unknown = found.where(~known & ~empty).groupBy(ROW, key, *keep).agg(F.sum("n").alias("n"))
    others = unknown.select(
        key, *keep, F.lit(OOV_INDEX).cast("bigint").alias("idx"), (term_weight(F.col("n")) * oov_idf(n_docs)).alias("tfidf")
    )
    return placed.unionByName(others)
