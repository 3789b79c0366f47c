"""A corpus pipeline over documents: stages that each read what the one before kept.

Language, exact duplicates, similar documents, repeated passages, packing. All stages but the last return the columns of
their input. Rows are told apart by doc_id and 128 bits of the SHA-256 of their texts; of rows equal in both, the exact-duplicate
and the similar-document stage keep one, the others keep each. Null texts count as empty. A stage's result is read once, when it is written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import cuckoo, jaccard, language, packing, repeats
from lexmill.llm.support import documents, materialise, partitions, text_marks
from lexmill.sources.workspace import job_folder, new_path, remove_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Most bytes of rows that travel to a Python worker at a time. The stages hand over whole texts; workers live through all of them.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def _stage(work: Stage) -> Stage:
    """A stage whose Python workers get texts in small batches; the session keeps that setting, or its own if that is smaller."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if int(spark.conf.get(_BATCH).rstrip("b")) > BATCH_BYTES:
            spark.conf.set(_BATCH, f"{BATCH_BYTES}b")
        return work(spark, docs, sf_dir)

    return run_stage


def _unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, longer where ``docs`` has such columns."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def _same_row(columns: list[str]):
    """For each row of a batch its (doc_id, t, u)."""

    def keys(b: pa.RecordBatch) -> list[tuple]:
        return list(zip(*[b.column(c).to_pylist() for c in columns]))

    return keys


def _only(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row of ``docs`` for each (doc_id, t, u) of ``chosen``, which has each once.

    Each task first leaves one of its own equal rows; then rows and chosen names meet by name, in one exchange.
    """
    names = _unused(docs, "row_id", "row_t", "row_u", "row_named")
    named, key = names[-1], _same_row(names[:3])
    marks = text_marks(F.coalesce(F.col("text"), F.lit("")))
    own = dict(zip(names, [F.col("doc_id").cast("bigint"), marks["t"], marks["u"], F.lit(False)]))
    keyed = docs.select("*", *[c.alias(n) for n, c in own.items()])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for b in batches:
            new = []
            for k in key(b):
                new.append(k not in seen)
                seen.add(k)
            yield b.filter(pa.array(new, pa.bool_()))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by name, the chosen name before the rows that have it: the first of these stays."""
        open_: tuple | None = None
        for b in batches:
            kept = []
            for k, is_name in zip(key(b), b.column(named).to_pylist()):
                kept.append(not is_name and k == open_)
                if is_name:
                    open_ = k
                elif kept[-1]:
                    open_ = None
            yield b.filter(pa.array(kept, pa.bool_()))

    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields]
    given = [F.col(c).alias(n) for c, n in zip(("doc_id", "t", "u"), names)]
    asked = chosen.select(*nothing, *given, F.lit(True).alias(named))
    met = keyed.mapInArrow(first, keyed.schema).unionByName(asked).repartition(partitions(docs.sparkSession), *names[:3])
    ordered = met.sortWithinPartitions(*names[:3], F.desc(named))
    return ordered.mapInArrow(take, ordered.schema).select(*[F.col(f"`{c}`") for c in docs.columns])


@_stage
def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs, language.train(docs))


@_stage
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = cuckoo.exact_groups(docs).where("kept")
    chosen = groups.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "t", "u")).alias("row"))
    return _only(docs, chosen.select("row.*"))


@_stage
def without_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _only(docs, jaccard.similarity_classes(docs).where("kept").select("doc_id", "t", "u").distinct())


@_stage
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each row; a text that was null stays null."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    absent = _unused(docs, "text_absent")[0]
    rest = F.struct(*others, F.col("text").isNull().alias(absent))
    cut = repeats.remove_repeats(docs, with_text=True, rest=rest)
    text = F.when(~F.col(f"rest.{absent}"), F.col("kept"))
    columns = {c: F.col(f"rest.`{c}`") for c in docs.columns} | {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return cut.select(*[columns[c].alias(c) for c in docs.columns])


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_languages),
    ("exact_duplicates", without_copies),
    ("similar_documents", without_similar),
    ("repeated_passages", without_repeats),
    ("packing", packed),
]
#: SQL cannot express the language model, the similarity classes or the curve: see the tests.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What one stored on the way goes when its result is written; what the last one reads stays until the session ends."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        with job_folder(spark):
            docs = materialise(stage(spark, docs, sf_dir), name, path)
        if before:
            remove_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
