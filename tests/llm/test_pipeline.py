"""The pipeline against the same decisions made in plain Python."""

from __future__ import annotations

import collections
import zlib

import numpy as np
import pytest
from test_duplicates import colliding, place, plain_classes, plain_repeats
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from lexmill.llm import language
from lexmill.llm.support import materialise
from lexmill.llm.words import default_vocabulary
from lexmill.sources import workspace


@pytest.fixture(scope="module")
def stages(spark, docs, small):
    out, kept = [docs], docs
    for name, stage in corpus_pipeline.STAGES:
        kept = materialise(stage(spark, kept, small), name)
        out.append(kept)
    return out


def rows_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stage_names_and_columns(docs, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "exact_duplicates", "similar_documents", "repeated_passages", "packing",
    ]
    assert all(s.columns == docs.columns and s.dtypes == docs.dtypes for s in stages[:-1])


def test_language_stage_keeps_what_the_model_knows(docs, stages):
    model = language.train(docs)
    want = {
        d: t for d, t in rows_of(docs).items() if not language._judge(model, t, np.frombuffer((t or "").encode(), np.uint8))[3]
    }
    assert rows_of(stages[1]) == want and len(want) >= 190


def test_copies_leave_the_largest_id(stages):
    before = rows_of(stages[1])
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    last = {lower(t): d for d, t in sorted(before.items())}
    assert rows_of(stages[2]) == {d: before[d] for d in last.values()}


def test_similar_documents_leave_the_smallest_id(stages):
    before = sorted(rows_of(stages[2]).items())
    classes = plain_classes([t for _, t in before])
    assert rows_of(stages[3]) == {d: t for k, (d, t) in enumerate(before) if classes[k][0] == k}


def test_repeats_are_cut_from_the_texts(stages):
    before, after = sorted(rows_of(stages[3]).items()), rows_of(stages[4])
    assert after.keys() == {d for d, _ in before}
    for d, _, removed, _, _ in plain_repeats(before):
        if not removed:
            assert after[d] == dict(before)[d]
        else:
            assert len(after[d].encode()) <= len(dict(before)[d].encode()) - removed
    assert all(r["n_chars"] == len(r["text"]) for r in stages[4].collect())


def test_what_is_left_is_packed(stages):
    library = Tokenizer.from_file(default_vocabulary())
    ids = {d: np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4") for d, t in rows_of(stages[4]).items()}
    pieces = stages[5].collect()
    assert sum(p["length"] for p in pieces) == sum(map(len, ids.values()))
    for p in pieces:
        assert zlib.crc32(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"]
    filled = collections.Counter()
    for p in pieces:
        filled[p["sequence_id"]] += p["length"]
    assert sum(n < 4096 for n in filled.values()) <= 1


def test_run_applies_all_stages(spark, small, stages):
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(queries()["pipeline"](spark, small)) == key(stages[5])


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_equal_rows_and_texts_of_equal_hash(spark, small, parts):
    long = " ".join(str(k * k) for k in range(100, 160)) + " "
    a, b = colliding(spark, long)
    other = "an entirely different text about the weather of the coming days and nights " * 3
    rows = [(None, a), (None, b), (None, b), (7, other), (7, other), (7, other), (8, None), (8, None), (9, "")]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df = df.repartition(parts)
    stages = dict(corpus_pipeline.STAGES)
    got = lambda name: sorted(((r["doc_id"], r["text"]) for r in stages[name](spark, df, small).collect()), key=repr)
    assert got("exact_duplicates") == sorted([(None, a), (None, b), (7, other), (9, "")], key=repr)
    assert [d for d, _ in got("similar_documents")].count(None) == 1 and (7, other) in got("similar_documents")
    after = got("repeated_passages")
    assert [d for d, _ in after] == [d for d, _ in sorted(rows, key=repr)]
    assert after.count((8, None)) == 2 and after.count((7, other)) == 0 and len({t for d, t in after if d == 7}) == 1
    first, second = sorted((a, b), key=lambda t: place((None, t)))
    assert [t for d, t in after if d is None].count(first) == (1 if first == a else 2)


def test_the_pipeline_leaves_no_job_folder(spark, small, stages):
    path = spark._jvm.org.apache.hadoop.fs.Path(workspace.session_folder(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    assert not [f for f in files if f.getPath().getName().startswith("job-")]


def test_stages_take_odd_rows_and_empty_tables(spark, edge, empty, small):
    for docs in (edge, empty):
        clashing = docs.withColumnRenamed("key", "row_id").withColumnRenamed("t", "row_t").withColumnRenamed("h", "rest")
        kept = clashing
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = materialise(stage(spark, kept, small), name)
            assert kept.columns == clashing.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, small)
        assert packed.count() >= kept.count()
