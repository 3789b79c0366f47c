from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexmill.config import JobConfigError, ModelName, TrainingParams
from lexmill.plans import publishing, retraining, training
from lexmill.sources import artifacts, delimited, workspace
from lexmill.streaming.scoring import read_batches, score_stream

PARAMS = TrainingParams(feature_columns=("source", "text"), target_column="lang", num_words=300, epochs=3)


@pytest.fixture(scope="module")
def files(spark, small, tmp_path_factory):
    base = tmp_path_factory.mktemp("files")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    delimited.write_delimited(docs.select("source", "text", "lang"), f"{base}/train")
    delimited.write_delimited(docs.select("source", "text"), f"{base}/features")
    delimited.write_delimited(docs.select(F.when(F.col("doc_id") % 9 == 0, "new").otherwise(F.col("lang")).alias("lang")), f"{base}/targets")
    return base


@pytest.fixture(scope="module")
def run(spark, files):
    name = ModelName("lang", "languages", {"team": "tests"})
    return training.train_job(
        spark, f"{files}/train", PARAMS, name, f"{files}/model", f"{files}/registry", {"features": "f", "targets": "t"}, "local"
    )


@pytest.fixture(scope="module")
def published(spark, run):
    return publishing.load_published(spark, run.folder, "lang")


def test_run_is_stored_and_registered(spark, files, run):
    runs = artifacts.read_registry(spark, f"{files}/registry").collect()
    assert [r["run_id"] for r in runs] == [run.run_id] and runs[0]["experiment"] == "languages"
    assert artifacts.read_registry(spark, f"{files}/registry", "metrics").count() == PARAMS.epochs
    assert publishing.load_published(spark, run.folder).params == PARAMS
    counts = spark.read.option("sep", ";").option("header", True).csv(f"{run.folder}/readable/word_counts")
    assert counts.columns == ["palavra", "quantidade", "percentual"] and counts.count() == 300
    assert artifacts.current_version(spark, run.folder)["dataset_names"].count() == 2
    shapes = {r["split"]: (r["n_rows"], r["n_columns"]) for r in spark.read.json(f"{run.folder}/readable/split_shapes").collect()}
    assert shapes == {"train": (140, 300), "test": (30, 300), "validation": (30, 300)}
    assert spark.read.json(f"{run.folder}/readable/preview").count() == 10


def test_info_and_version(run, published):
    info = publishing.model_info(published)
    assert publishing.model_version(published) == run.run_id == info["run_id"]
    assert sorted(r["label"] for r in published.known_labels.collect()) == ["de", "en", "es", "fr"] and info["train_accuracy"].endswith("%")


def test_requests_are_read_once_and_told_apart(spark, published):
    """Rows that share an id, or have none, each get an answer; they are checked while they are scored."""
    passed = spark.sparkContext.accumulator(0)

    def counting(batches):
        for b in batches:
            passed.add(b.num_rows)
            yield b

    rows = [(1, "src;the and of"), (1, "src;le la en les"), (None, "x;"), (None, "x;"), (None, "y;the")] * 3
    asked = spark.createDataFrame(rows, "request_id bigint, request string").repartition(3)
    read = asked.mapInArrow(counting, asked.schema)
    got = publishing.predict(spark, published, read).collect()
    assert sorted((r["request_id"] or 0) for r in got) == [0] * 9 + [1] * 6 and passed.value == 15
    alone = [publishing.predict(spark, published, [t]).first() for _, t in rows[:5]]
    assert sorted((r["label"], r["score"]) for r in got) == sorted((r["label"], r["score"]) for r in alone * 3)


def test_predictions_for_every_request(spark, published):
    rows = ["src;the and of", "src;le la en les", "x;"]
    got = publishing.predict(spark, published, rows).collect()
    assert sorted(r["request_id"] for r in got) == [0, 1, 2] and all(r["label"] for r in got)


@pytest.mark.parametrize("bad", [[], ["a;b", "a"], [1], "text", None])
def test_bad_requests_give_a_message(spark, published, bad):
    assert isinstance(publishing.predict(spark, published, bad), str)


def test_evaluate_and_feedback(spark, published, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    data = docs.select(F.col("doc_id").alias("request_id"), F.concat_ws(";", "source", "text").alias("request"), F.col("lang").alias("label"))
    assert publishing.evaluate(spark, published, data).first()["accuracy"].endswith("%")
    assert publishing.evaluate(spark, published, ["s;the and of", "s;le la"], ["zz", "zz"]).first()["accuracy"] == "0.00%"
    assert "2 and 1" in publishing.evaluate(spark, published, ["a;b", "c;d"], ["x"])
    assert "1 and 0" in publishing.judged_pairs(spark, ["a"], [])
    judged = publishing.judged_pairs(spark, ["en", "en"], ["en", "xx"])
    report, unknown = publishing.feedback(published, judged)
    assert report.first()["n_unknown_rows"] == 1 and [r["label"] for r in unknown.collect()] == ["xx"]


def test_retraining_loop(spark, files, published):
    sets = {"features": f"{files}/features", "targets": f"{files}/targets"}
    decision, batches, unknown = retraining.evaluate_for_retraining(spark, published, sets, batch_rows=60)
    by_lines = {k: f"{v}-lines" for k, v in sets.items()}
    for k, columns in (("features", ["source", "text"]), ("targets", ["lang"])):
        rows = delimited.read_delimited(spark, sets[k], columns)
        flat = rows.select(*[F.regexp_replace(c, r"[\r\n]+", " ").alias(c) for c in columns])
        delimited.write_delimited(flat, by_lines[k])
    one_line, _, _ = retraining.evaluate_for_retraining(spark, published, by_lines, provider="local", multi_line=False)
    row = decision.first()
    assert row["retrain"] and row["n_unknown_labels"] == 1 and row["evaluated_run_id"] == publishing.model_version(published)
    assert sorted(r["n_rows"] for r in batches.collect()) == [20, 60, 60, 60]
    assert [r["label"] for r in unknown.collect()] == ["new"] and one_line.first()["n_correct"] == row["n_correct"]
    small_params = TrainingParams(**{**PARAMS.as_mapping(), "feature_columns": PARAMS.feature_columns, "epochs": 1, "max_rows": 100})
    again = training.retrain_job(spark, sets, small_params, ModelName("lang", "languages"), f"{files}/model2", decision, f"{files}/registry", new_labels=unknown)
    assert again.model.n_docs == 70
    record = artifacts.model_info(artifacts.read_registry(spark, f"{files}/registry"), again.run_id).first()
    labels = artifacts.read_registry(spark, f"{files}/registry", "labels").where(F.col("run_id") == again.run_id)
    assert record["run_name"] == "self_training" and "new" in {r["label"] for r in labels.collect()}
    reasons = spark.read.json(f"{files}/model2/readable/training_reasons").first()
    assert reasons["retrain"] is True and reasons["unknown_labels"].startswith("new=")
    assert artifacts.current_version(spark, f"{files}/model2")["new_labels"].first()["label"] == "new"


def test_missing_dataset_or_parameter(spark, published):
    with pytest.raises(JobConfigError, match="targets"):
        retraining.evaluate_for_retraining(spark, published, {"features": "x"})
    values = PARAMS.as_mapping()
    values.pop("separator")
    with pytest.raises(JobConfigError, match="separator"):
        TrainingParams.from_mapping(values)
    with pytest.raises(JobConfigError):
        TrainingParams(holdout_share=1.5)


def test_jobs_leave_no_intermediate_tables(spark, run):
    path = spark._jvm.org.apache.hadoop.fs.Path(workspace.session_folder(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    assert not [f for f in files if f.getPath().getName().startswith("job-")]
    assert run.model.vocab.count() and run.model.hidden.count() and run.history.count() == PARAMS.epochs


def _stream(spark, published, base):
    return score_stream(
        spark, f"{base}/in", "request_id bigint, request string", f"{base}/out", f"{base}/rejects", f"{base}/cp",
        lambda batch: publishing.score_or_reject(published, batch), files_per_batch=1,
    )


def _rows(df):
    return sorted(map(tuple, df.select("request_id", "label", F.round("score", 6)).collect()))


def test_stream_equals_batch(spark, published, small, tmp_path):
    turns = spark.read.parquet(f"{small}/conversations.parquet").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"), F.concat_ws(";", "role", "text").alias("request")
    )
    turns.repartition(3).write.parquet(f"{tmp_path}/in")
    wanted = _rows(publishing.predict(spark, published, turns))
    for _ in range(2):
        _stream(spark, published, tmp_path).awaitTermination()
        assert _rows(read_batches(spark, f"{tmp_path}/out")) == wanted
        assert read_batches(spark, f"{tmp_path}/rejects").count() == 0


def test_stream_goes_on_after_bad_requests(spark, published, tmp_path):
    schema = "request_id bigint, request string"
    good, bad = [(1, "src;the mill"), (2, "src;le moulin")], [(3, "one field"), (4, None), (5, "a;b;c"), (6, "")]
    for rows in (good[:1] + bad[:2], bad[2:], [], good[1:]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        _stream(spark, published, tmp_path).awaitTermination()  # each time started again from the same checkpoint
    assert [r[0] for r in _rows(read_batches(spark, f"{tmp_path}/out"))] == [1, 2]
    reasons = {r["request_id"]: r["reason"] for r in read_batches(spark, f"{tmp_path}/rejects").collect()}
    assert reasons == {
        3: "expected 2 field(s), found 1", 4: "the request holds no text",
        5: "expected 2 field(s), found 3", 6: "expected 2 field(s), found 1",
    }


def test_selected_columns_are_read_and_repaired(spark, tmp_path):
    rows = [(f"w{i % 4} x{i % 3}", "ab"[i % 2], None if i % 5 == 0 else "s") for i in range(60)]
    delimited.write_delimited(spark.createDataFrame(rows, "text string, lang string, origin string"), f"{tmp_path}/in")
    params = TrainingParams(target_column="lang", selected_columns=("text", "origin"), drop_missing=True, epochs=1, shards=2)
    done = training.train_job(spark, f"{tmp_path}/in", params, ModelName("m", "e"), f"{tmp_path}/model")
    assert done.model.n_docs == 48 - 15  # 12 rows lack their origin; 30 % of the others are held out, rounded up
    assert publishing.load_published(spark, done.folder).params == params
