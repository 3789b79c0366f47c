from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from lexmill.config import JobConfigError
from lexmill.operators import order


@pytest.mark.parametrize("n", [3, 10, 33, 101, 1000])
def test_split_sizes_are_exact(spark, n):
    counts = {r["split"]: r["count"] for r in order.assign_split(spark.range(n), "id", 0.3, 1).groupBy("split").count().collect()}
    holdout = math.ceil(0.3 * n)
    validation = math.ceil(holdout / 2)
    wanted = {"train": n - holdout, "test": holdout - validation, "validation": validation}
    assert counts == {k: v for k, v in wanted.items() if v}


def test_split_does_not_move_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = order.assign_split(docs, "doc_id", 0.3, 1)._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Exchange" not in main


def test_split_depends_on_the_seed_only(spark):
    a = order.assign_split(spark.range(500), "id", 0.3, 1)
    b = order.assign_split(spark.range(500).repartition(7), "id", 0.3, 1)
    c = order.assign_split(spark.range(500), "id", 0.3, 2)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(a) == rows(b) != rows(c)


def test_empty_split_is_an_error():
    order.require_non_empty_splits(10, 0.3)
    with pytest.raises(JobConfigError):
        order.require_non_empty_splits(3, 0.3)
    with pytest.raises(JobConfigError):
        order.require_non_empty_splits(2, 0.9)


def test_cap_uses_the_loaded_size(spark):
    rows = spark.range(100)
    assert order.cap_rows(rows, "id", 40).count() == 40
    assert order.cap_rows(rows, "id", 100).count() == 100
    assert order.cap_rows(rows, "id", 100, loaded_rows=100).count() == 100
    # 120 rows were loaded and 20 dropped: more than 110 were loaded, so the shuffle applies, and all 100 stay
    assert order.cap_rows(rows, "id", 110, loaded_rows=120).count() == 100


def test_capped_rows_are_the_first_of_the_shuffle(spark):
    rows = spark.range(300)
    ranked = order.shuffle_rank(rows, "id", 0)
    first = {r["id"] for r in ranked.where("shuffle_rank <= 50").collect()}
    assert {r["id"] for r in order.cap_rows(rows, "id", 50, seed=0).collect()} == first


def test_number_rows_with_one_value_in_a_third_of_them(spark):
    df = spark.range(3000).withColumn("v", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50))
    got = order.number_rows(df, [F.desc("v"), F.col("id")], "place").collect()
    wanted = sorted(got, key=lambda r: (-r["v"], r["id"]))
    assert [r["place"] for r in wanted] == list(range(1, 3001))
