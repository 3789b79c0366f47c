"""Neighbours of few rows, and of rows whose norms differ much."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_models import by_query, exact_neighbours

from lexmill.llm import nearest

LARGE = "/root/testdata/sf0.1"


def rows_of(spark):
    rows = spark.read.parquet(f"{LARGE}/embeddings.parquet").orderBy("vec_id").limit(2000).collect()
    return [(r["vec_id"], [float(v) for v in r["embedding"]]) for r in rows]


@pytest.mark.parametrize("n", [15, 21, 60])
def test_few_rows_are_all_ranked(spark, n):
    rows = rows_of(spark)[:n]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got, want = by_query(nearest.nearest(df, df)), exact_neighbours(rows, rows)
    assert {q: [v for v, _ in a] for q, a in got.items()} == {q: [v for v, _ in a] for q, a in want.items()}


@pytest.mark.parametrize("factor", [3.0, 100.0])
def test_one_long_row_moves_only_its_range(spark, factor):
    rows = rows_of(spark)
    rows[7] = (rows[7][0], [v * factor for v in rows[7][1]])
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    asked = [r for r in rows if r[0] % 20 == 0]
    got, want = by_query(nearest.nearest(df, df.where("vec_id % 20 = 0"))), exact_neighbours(rows, asked)
    assert got.keys() == want.keys() and all(len(a) == 20 for a in got.values())
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want]) >= 0.95


def test_a_query_that_met_too_few_is_completed(spark):
    rows = rows_of(spark)[:300]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = by_query(nearest.nearest(df, df.where(F.col("vec_id") % 20 == 0), tables=1, probes=1))
    want = exact_neighbours(rows, [r for r in rows if r[0] % 20 == 0])
    assert got.keys() == want.keys() and all(len(got[q]) == 20 for q in want)


def test_queries_of_another_length_do_not_silence_the_others(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(200)] + [(1000 + k, rng.normal(size=4).tolist()) for k in range(20)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    asked = [rows[0], rows[40], *rows[200:203]]
    got = by_query(nearest.nearest(df, spark.createDataFrame(asked, df.schema)))
    want = exact_neighbours(rows[:200], asked[:2])
    assert got.keys() == want.keys() and all(len(a) == 20 for a in got.values())


def test_large_components_do_not_overflow(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(250)]
    rows[5] = (5, [1e200, -1e200] + [0.0] * 6)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    asked = [r for r in rows if r[0] % 20 == 0]
    got, want = by_query(nearest.nearest(df, df.where("vec_id % 20 = 0"))), exact_neighbours(rows, asked)
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want]) >= 0.95
    assert np.isfinite(nearest.norms_of(np.array([[1e200, 1e200], [0.0, 0.0], [3.0, 4.0]]))).all()
