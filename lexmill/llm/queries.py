"""Registered queries of the corpus operators. Each reads its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import alignment, binary_ids, bpe, cuckoo, jaccard, language, licenses, nearest, packing, quality, repeats, runs, simhash
from lexmill.llm.support import documents


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = binary_ids.scratch_folder(spark)
    binary_ids.write(documents(spark, sf_dir), folder)
    return binary_ids.read_digests(spark, folder)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir)).drop("kept", "rest")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.train(docs))


def op6_exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo.exact_groups(documents(spark, sf_dir)).drop("t", "u")


def op7_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_classes(documents(spark, sf_dir)).drop("t", "u")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(documents(spark, sf_dir))


def op9_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(documents(spark, sf_dir))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_and_near(documents(spark, sf_dir))


QUERIES = {
    "op1_nearest": op1_nearest,
    "op2_token_files": op2_token_files,
    "op3_quality": op3_quality,
    "op4_repeats": op4_repeats,
    "op5_language": op5_language,
    "op6_exact_groups": op6_exact_groups,
    "op7_similar": op7_similar,
    "op8_bpe": op8_bpe,
    "op9_curve_packing": op9_curve_packing,
    "op10_licenses": op10_licenses,
    "op11_alignment": op11_alignment,
    "op12_runs": op12_runs,
    "op13_fingerprints": op13_fingerprints,
}

ORACLES: dict[str, str] = {
    "op6_exact_groups": """
        WITH normal AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM normal WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op10_licenses": licenses.oracle(),
}
