from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lexmill.config import JobConfigError, TrainingParams
from lexmill.operators import quality
from lexmill.plans import training
from lexmill.sources import artifacts, delimited, requests, workspace


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_fields_as_documented(spark, tmp_path):
    uri = write(
        tmp_path / "a.csv",
        'id,text,label\n1,"a, ""q"" b",x\n2,"multi\nline",y\n3,NA,"NA"\n4,"",null\n5,  sp ,z\n6,short\n\n7,é,n/a\n',
    )
    got = {r["id"]: (r["text"], r["label"]) for r in delimited.read_delimited(spark, uri).collect()}
    assert got == {
        "1": ('a, "q" b', "x"),
        "2": ("multi\nline", "y"),
        "3": (None, None),
        "4": (None, None),
        "5": ("  sp ", "z"),
        "6": ("short", None),
        "7": ("é", None),
    }


def test_separator_and_encoding(spark, tmp_path):
    uri = write(tmp_path / "b.csv", "t;l\nção;1,5\n", "latin-1")
    row = delimited.read_delimited(spark, uri, ["l", "t"], ";", "ISO-8859-1").first()
    assert (row["t"], row["l"]) == ("ção", "1,5")


def test_missing_column_names_are_listed(spark, tmp_path):
    uri = write(tmp_path / "c.csv", "a,b\n1,2\n")
    with pytest.raises(JobConfigError, match="zz, yy"):
        delimited.read_delimited(spark, uri, ["a", "zz", "yy"])
    with pytest.raises(JobConfigError, match="target"):
        quality.project_roles(delimited.read_delimited(spark, uri), ["a"], "q")


def test_files_must_share_their_header(spark, tmp_path):
    write(tmp_path / "1.csv", "a,b\n1,2\n")
    write(tmp_path / "2.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        delimited.read_delimited(spark, str(tmp_path)).collect()


def test_row_index_follows_file_names(spark, tmp_path):
    sizes = [5, 1, 300, 40, 2]
    n = 0
    for i, size in enumerate(sizes):
        write(tmp_path / f"part-{i}.csv", "v\n" + "".join(f"{n + j}\n" for j in range(size)))
        n += size
    got = delimited.read_delimited(spark, str(tmp_path), ["v"], with_index=True).collect()
    assert len(got) == n and all(int(r["v"]) == r["row_index"] for r in got)


def test_paired_files_of_different_length_are_rejected(spark, tmp_path):
    x = write(tmp_path / "x.csv", "text\na\nb\nc\n")
    y = write(tmp_path / "y.csv", "label\n1\n\n3\n")
    with pytest.raises(JobConfigError, match="3 rows but targets have 2"):
        delimited.read_paired(spark, x, y, ["text"], ["label"])


def test_paired_files_align_by_position(spark, tmp_path):
    for i, values in enumerate((["a", "b"], ["c"], ["d", "e", "f"])):
        write(tmp_path / f"x{i}.csv", "text\n" + "".join(f"{v}\n" for v in values))
    y = write(tmp_path / "y.csv", "other,label\n" + "".join(f"0,{v}\n" for v in "ABCDEF"))
    got = delimited.read_paired(spark, str(tmp_path / "x*.csv"), y, ["text"], ["label"]).collect()
    assert sorted((r["row_index"], r["text"], r["label"]) for r in got) == [(i, c, c.upper()) for i, c in enumerate("abcdef")]


def test_row_index_survives_another_packing_of_the_files(spark, tmp_path):
    for i in range(8):
        write(tmp_path / f"x{i}.csv", "text\n" + "".join(f"t{i * 100 + j}\n" for j in range(100)))
        write(tmp_path / f"y{i}.csv", "label\n" + "".join(f"l{i * 100 + j}\n" for j in range(100)))
    frame = delimited.read_paired(spark, str(tmp_path / "x*.csv"), str(tmp_path / "y*.csv"), ["text"], ["label"])
    settings = {"spark.sql.files.minPartitionNum": "64", "spark.sql.files.maxPartitionBytes": "200"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = frame.collect()
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert sorted((r["row_index"], r["text"], r["label"]) for r in got) == [(i, f"t{i}", f"l{i}") for i in range(800)]


def test_paired_head_is_taken_before_the_join(spark, tmp_path):
    x = write(tmp_path / "x.csv", "text\n" + "".join(f"t{i}\n" for i in range(50)))
    y = write(tmp_path / "y.csv", "label\n" + "".join(f"l{i}\n" for i in range(50)))
    got = delimited.read_paired(spark, x, y, ["text"], ["label"], first_rows=7).collect()
    assert sorted(r["row_index"] for r in got) == list(range(7))


def test_a_paired_head_from_one_file_is_dealt_out(spark, tmp_path):
    x = write(tmp_path / "x.csv", "text\n" + "".join(f"t{i}\n" for i in range(400)))
    y = write(tmp_path / "y.csv", "label\n" + "".join(f"l{i}\n" for i in range(400)))
    got = delimited.read_paired(spark, x, y, ["text"], ["label"], first_rows=300)
    assert sorted(map(tuple, got.collect())) == sorted((i, f"t{i}", f"l{i}") for i in range(300))
    held = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert len(held) >= spark.sparkContext.defaultParallelism and max(held) < 100


def test_written_files_are_short_and_keep_the_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(delimited, "FILE_ROWS", 10)
    delimited.write_delimited(spark.range(95).select(F.col("id").alias("v")).coalesce(2), f"{tmp_path}/out")
    assert len(list((tmp_path / "out").glob("*.csv"))) == 10
    got = delimited.read_delimited(spark, f"{tmp_path}/out", ["v"], with_index=True).collect()
    assert sorted((r["row_index"], int(r["v"])) for r in got) == [(i, i) for i in range(95)]


def test_files_split_otherwise_give_right_positions_or_an_error(spark, tmp_path):
    uri = write(tmp_path / "l.csv", "text\n" + "".join(f"t{i}\n" for i in range(3000)))
    key = "spark.sql.files.maxPartitionBytes"
    right = [(i, f"t{i}") for i in range(3000)]
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "2000")
        frame = delimited.read_delimited(spark, uri, ["text"], with_index=True, multi_line=False)
        assert frame.rdd.getNumPartitions() > 4 and sorted(map(tuple, frame.collect())) == right
        files = delimited.file_rows(spark, uri, ["text"], multi_line=False)
        spark.conf.set(key, "4000")
        assert sorted(map(tuple, files.all().collect())) == right and sorted(map(tuple, files.head(700).collect())) == right[:700]
        spark.conf.set(key, "1500")
        with pytest.raises(Exception, match="split otherwise"):
            files.all().collect()
    finally:
        spark.conf.set(key, before)


def stored_bytes(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(workspace.session_folder(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def test_a_head_is_not_stored_and_later_files_are_not_read(spark, tmp_path):
    for i in range(6):
        write(tmp_path / f"x{i}.csv", "text\n" + "".join(f"{i} {j} {'long ' * 200}\n" for j in range(400)))
    scan = delimited._scan(spark, str(tmp_path / "x*.csv"), ",", "utf-8")
    before = stored_bytes(spark)
    head = delimited.first_rows(scan, ["text"], 450)
    assert [r["row_index"] for r in head.orderBy("row_index").collect()] == list(range(450))
    assert stored_bytes(spark) - before < 20_000  # counts per split only; the files hold 2.4 MB
    assert head.where("text not like '0 %' and text not like '1 %'").count() == 0
    write(tmp_path / "x5.csv", "text\nchanged since\n")  # not among the first splits: it doesn't matter
    assert head.count() == 450


def test_a_sample_writes_the_texts_of_its_rows_alone(spark, tmp_path, monkeypatch):
    for i in range(3):
        write(tmp_path / f"x{i}.csv", "text,label\n" + "".join(f"{i} {j} {'w%d ' % j * 300},{'ab'[j % 2]}\n" for j in range(400)))
    params = TrainingParams(feature_columns=("text",), target_column="label", max_rows=60, drop_missing=True)
    uri = str(tmp_path / "x*.csv")
    whole = delimited.read_delimited(spark, uri, ["text", "label"], with_index=True)
    want = training.prepare(whole, params, delimited.ROW_INDEX)
    before = stored_bytes(spark)
    written = []
    monkeypatch.setattr(training, "materialise", lambda df, name, *a, **k: written.append(name) or workspace.materialise(df, name, *a, **k))
    got = training.prepare_files(delimited.file_rows(spark, uri, ["text", "label"]), params)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 60
    assert written == ["chosen", "wanted", "prepared"] and stored_bytes(spark) - before < 100_000  # the files hold 1.6 MB


def test_lines_without_multi_line_are_rows(spark, tmp_path):
    uri = write(tmp_path / "l.csv", 'a,b\n1,"x, y"\n2,z\n')
    got = delimited.read_delimited(spark, uri, multi_line=False).collect()
    assert [tuple(r) for r in got] == [("1", "x, y"), ("2", "z")]


def test_missing_value_policy(spark):
    df = spark.createDataFrame([("a", "x"), (None, "y"), ("b", None), (None, None)], "t string, l string")
    assert quality.repair(df, ["t", "l"], drop=True).count() == 1
    filled = {tuple(r) for r in quality.repair(df, ["t", "l"], drop=False).collect()}
    assert filled == {("a", "x"), ("nanvazio", "y"), ("b", "nanvazio"), ("nanvazio", "nanvazio")}
    assert {tuple(r) for r in quality.null_profile(df, ["t", "l"]).collect()} == {("t", 2), ("l", 2)}
    assert tuple(quality.cleaning_report(df, ["t", "l"]).first()) == (4, 3, 1, "75.00%")
    assert quality.cleaning_report(df.limit(1), ["t", "l"]).count() == 0


def test_request_checks(spark):
    def check(rows):
        seen = Observation()
        requests.watched(requests.with_fields(requests.requests_from_list(spark, rows)), seen).collect()
        return requests.request_problem(seen.get)

    assert check(["a;b", "c;d"]) is None
    assert check([]) == requests.EMPTY_REQUEST
    assert "between 1 and 2" in check(["a;b", "c"])
    assert "no text" in check(["a", None])


def test_missing_artifact_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="vocabulary"):
        artifacts.load_table(spark, str(tmp_path), "vocabulary")


def test_a_version_is_current_when_its_manifest_is_written(spark, tmp_path):
    folder = str(tmp_path / "model")
    words = lambda *w: spark.createDataFrame([(x,) for x in w], "word string")
    artifacts.save_tables(artifacts.version_folder(folder, "r1"), {"a": words("x", "y"), "b": words("z")})
    artifacts.publish_version(spark, folder, "r1", ["a", "b"])
    artifacts.save_tables(artifacts.version_folder(folder, "r2"), {"a": words("new")})
    with pytest.raises(FileNotFoundError, match="'b'"):
        artifacts.publish_version(spark, folder, "r2", ["a", "b"])  # a job that broke half-way
    assert {n: t.count() for n, t in artifacts.current_version(spark, folder).items()} == {"a": 2, "b": 1}
    artifacts.save_tables(artifacts.version_folder(folder, "r2"), {"b": words("new", "newer", "newest")})
    artifacts.publish_version(spark, folder, "r2", ["a", "b"])
    assert {n: t.count() for n, t in artifacts.current_version(spark, folder).items()} == {"a": 1, "b": 3}
    artifacts.save_tables(artifacts.version_folder(folder, "r2"), {"b": words("changed")})
    with pytest.raises(artifacts.BrokenVersionError, match="'b' of version r2"):
        artifacts.current_version(spark, folder)


def test_registry_grows_by_run(spark, tmp_path):
    registry = str(tmp_path / "reg")
    for run in ("r1", "r2"):
        rows = spark.createDataFrame([("e", run, "n")], "experiment string, run_id string, run_name string")
        artifacts.register_run(registry, rows)
    assert artifacts.read_registry(spark, registry).count() == 2
    info = artifacts.model_info(artifacts.read_registry(spark, registry), "r2").first()
    assert (info["run_id"], info["version"]) == ("r2", "r2")


def test_dataset_uri():
    assert delimited.dataset_uri("local", "/a/b.csv") == "file:///a/b.csv"
    assert delimited.dataset_uri("object_store", "bucket/b.csv") == "s3a://bucket/b.csv"
    assert delimited.dataset_uri("local", "hdfs://x/y") == "hdfs://x/y"
    assert delimited.dataset_uri(None, "/a/b.csv") == "/a/b.csv"
    with pytest.raises(JobConfigError):
        delimited.dataset_uri("tape", "/a")
