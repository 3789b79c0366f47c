"""Every registered query against its SQL, or for rows where it has none."""

from __future__ import annotations

import pytest
from check_oracles import difference, sql_session

from __spark_entry__ import entry
from lexmill.catalog.oracles import ORACLES
from lexmill.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return sql_session(small)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_equals_sql(spark, small, con, name):
    assert difference(QUERIES[name](spark, small), con, ORACLES[name]) is None


def test_only_training_lacks_sql():
    assert set(QUERIES) - set(ORACLES) == {"train_mlp", "train_job", "retrain_job"}
    assert not set(ORACLES) - set(QUERIES)


def test_training_query_learns(spark, small):
    history = QUERIES["train_mlp"](spark, small).collect()
    assert len(history) == 10 and history[-1]["val_accuracy"] >= 0.5


def test_entry(spark):
    assert entry(spark).count() == 200
