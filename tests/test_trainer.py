from __future__ import annotations

import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from lexmill.config import TrainingParams
from lexmill.operators import trainer

WIDTH, CLASSES = 12, 3


def rows_of(n: int, seed: int = 3):
    rng = np.random.default_rng(seed)
    out = []
    for d in range(n):
        label = int(rng.integers(CLASSES))
        split = ("train", "train", "train", "test", "validation")[d % 5]
        if d == 7:
            out.append((d, split, label, None, None))
            continue
        picked = {1 + label * 3 + int(rng.integers(3)) for _ in range(3)} | {int(rng.integers(1, WIDTH))}
        out += [(d, split, label, i, float(rng.uniform(0.5, 2))) for i in sorted(picked)]
    return out


@pytest.fixture(scope="module")
def data(spark):
    rows = rows_of(200)
    schema = "doc_id bigint, split string, label_idx bigint, idx bigint, tfidf double"
    vocab = spark.createDataFrame([(f"w{i}", 1, 1, i) for i in range(2, WIDTH)], "word string, n bigint, df bigint, idx bigint")
    return rows, spark.createDataFrame(rows, schema), vocab


def params(**changes):
    return TrainingParams(**{"epochs": 2, "batch_size": 8, "neurons": 4, "shards": 1, "averages_per_epoch": 1, **changes})


def dense_truth(rows, p: TrainingParams, w1: np.ndarray, shard: int = 0, members: set[int] | None = None):
    """The same network trained on dense matrices, every parameter updated at every step."""
    docs = sorted({r[0] for r in rows if r[1] == "train" and (members is None or r[0] in members)})
    x, y = np.zeros((len(docs), WIDTH)), np.zeros((len(docs), CLASSES))
    for d, _, label, i, v in rows:
        if d in docs:
            y[docs.index(d), label] = 1
            if i is not None:
                x[docs.index(d), i] = v
    start = trainer.initial_dense(p.neurons, CLASSES, p.seed)
    values = [w1.copy(), start.hidden_bias.copy(), start.output_weights.copy(), start.output_bias.copy()]
    m, s, t = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for epoch in range(1, p.epochs + 1):
        order = np.random.default_rng([p.seed, epoch, shard]).permutation(len(docs))
        for at in range(0, len(docs), p.batch_size):
            b = order[at : at + p.batch_size]
            z = x[b] @ values[0] + values[1]
            h = np.maximum(z, 0)
            q = 1 / (1 + np.exp(-(h @ values[2] + values[3])))
            total = q.sum(1, keepdims=True)
            d_q = (1 / total - y[b] / q) / len(b)
            d_o = d_q * q * (1 - q)
            d_z = (d_o @ values[2].T) * (z > 0)
            grads = [x[b].T @ d_z, d_z.sum(0), h.T @ d_o, d_o.sum(0)]
            t += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                values[k] -= 0.001 * np.sqrt(1 - 0.999**t) / (1 - 0.9**t) * m[k] / (np.sqrt(s[k]) + 1e-7)
    return values, len(docs)


def starting_weights(spark, p: TrainingParams) -> np.ndarray:
    start = trainer.initial_weights(spark.range(1, WIDTH).withColumnRenamed("id", "idx"), WIDTH, p.neurons, p.seed)
    w1 = np.zeros((WIDTH, p.neurons))
    for r in start.collect():
        w1[r["idx"]] = [r[f"w{j}"] for j in range(p.neurons)]
    return w1


def check(fit, wanted):
    for r in fit.hidden.collect():
        assert r["weights"] == pytest.approx(wanted[0][r["idx"]], abs=1e-10)
    net = fit.network.first()
    assert net["hidden_bias"] == pytest.approx(wanted[1], abs=1e-10)
    assert np.array(net["output_weights"]) == pytest.approx(wanted[2].T, abs=1e-10)
    assert net["output_bias"] == pytest.approx(wanted[3], abs=1e-10)


def test_one_shard_equals_dense_training(spark, data):
    rows, features, vocab = data
    p = params()
    fit = trainer.train_network(features, vocab, WIDTH - 2, CLASSES, 120, p)
    check(fit, dense_truth(rows, p, starting_weights(spark, p))[0])


def test_shards_are_averaged_by_documents(spark, data):
    rows, features, vocab = data
    p = params(epochs=1, shards=3)
    fit = trainer.train_network(features, vocab, WIDTH - 2, CLASSES, 120, p)
    ids = {r[0] for r in rows if r[1] == "train"}
    dealt = spark.createDataFrame([(d,) for d in ids], "doc_id bigint").select(
        "doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(3)).cast("int").alias("shard")
    )
    members: dict[int, set[int]] = {}
    for r in dealt.collect():
        members.setdefault(r["shard"], set()).add(r["doc_id"])
    w1 = starting_weights(spark, p)
    parts = [dense_truth(rows, p, w1, shard, docs) for shard, docs in members.items()]
    assert len(parts) == 3 and sum(n for _, n in parts) == 120
    check(fit, [sum(values[i] * (n / 120) for values, n in parts) for i in range(4)])


def test_loss_falls_over_many_shards(data):
    _, features, vocab = data
    fit = trainer.train_network(features, vocab, WIDTH - 2, CLASSES, 120, params(epochs=4, batch_size=2, shards=4, averages_per_epoch=2))
    history = fit.history.orderBy("epoch").collect()
    assert [r["epoch"] for r in history] == [1, 2, 3, 4]
    losses = [r["loss"] for r in history]
    assert losses == sorted(losses, reverse=True) and history[-1]["val_loss"] < history[0]["val_loss"]


def test_saturated_scores_stay_finite(data):
    _, features, vocab = data
    huge = features.withColumn("tfidf", F.col("tfidf") * 1e6)
    fit = trainer.train_network(huge, vocab, WIDTH - 2, CLASSES, 120, params(epochs=1))
    row = fit.history.first()
    assert np.isfinite([row["loss"], row["val_loss"], fit.test_loss]).all()


def test_dropout_runs_and_differs(data):
    _, features, vocab = data
    with_it = trainer.train_network(features, vocab, WIDTH - 2, CLASSES, 120, params(epochs=1, use_dropout=True))
    without = trainer.train_network(features, vocab, WIDTH - 2, CLASSES, 120, params(epochs=1))
    assert with_it.hidden.orderBy("idx").collect() != without.hidden.orderBy("idx").collect()


def test_untouched_words_keep_their_weights(spark, data):
    _, features, vocab = data
    more = vocab.unionByName(spark.createDataFrame([("rare", 1, 1, 500)], vocab.schema))
    p = params(epochs=1)
    fit = trainer.train_network(features, more, WIDTH - 1, CLASSES, 120, p)
    start = trainer.initial_weights(spark.createDataFrame([(500,)], "idx bigint"), WIDTH + 1, p.neurons, p.seed).first()
    kept = fit.hidden.where(F.col("idx") == 500).first()["weights"]
    assert kept == [start[f"w{j}"] for j in range(p.neurons)]


def test_weights_do_not_depend_on_partitions(spark, data):
    _, features, vocab = data
    p = params(epochs=2, shards=4, averages_per_epoch=2, use_dropout=True)
    results = []
    for n in (1, 4, 16):
        fit = trainer.train_network(features.repartition(n), vocab, WIDTH - 2, CLASSES, 120, p)
        rows = sorted((r["idx"], *r["weights"]) for r in fit.hidden.collect())
        results.append((np.array(rows), np.array(fit.network.first()["output_weights"])))
    for hidden, output in results[1:]:
        assert np.abs(hidden - results[0][0]).max() < 1e-9 and np.abs(output - results[0][1]).max() < 1e-9


def test_many_classes_need_no_square_matrix(spark):
    rows = [(d, ("train", "test", "validation")[d % 3], d % 20_000, 1 + d % 5, 1.0) for d in range(60)]
    features = spark.createDataFrame(rows, "doc_id bigint, split string, label_idx bigint, idx bigint, tfidf double")
    vocab = spark.createDataFrame([(f"w{i}", 1, 1, i) for i in range(2, 7)], "word string, n bigint, df bigint, idx bigint")
    fit = trainer.train_network(features, vocab, 5, 20_000, 20, params(epochs=1, neurons=2, shards=2))
    assert np.isfinite(fit.test_loss)


def test_full_gradient_is_the_slope_of_the_loss(spark, data):
    rows, features, _ = data
    p = params()
    w1 = starting_weights(spark, p)
    dense = trainer.initial_dense(p.neurons, CLASSES, p.seed)
    train = features.where("split = 'train'").drop("split")
    hidden = spark.createDataFrame([(i, w.tolist()) for i, w in enumerate(w1) if i], "idx bigint, weights array<double>")

    def loss(weights: np.ndarray) -> float:
        x, label = {}, {}
        for d, split, y, i, v in rows:
            if split == "train":
                label[d] = y
                x.setdefault(d, np.zeros(WIDTH))
                if i is not None:
                    x[d][i] += v
        total = 0.0
        for d, values in x.items():
            h = np.maximum(values @ weights + dense.hidden_bias, 0)
            q = 1 / (1 + np.exp(-(h @ dense.output_weights + dense.output_bias)))
            total -= np.log(q[label[d]] / q.sum())
        return total / len(x)

    got = trainer.full_gradient(train, hidden, dense.table(train), 120, p.neurons).collect()
    slopes = {(r["idx"], r["neuron"]): r["gradient"] for r in got if r["part"] == "word"}
    for at in [(1, 0), (4, 2), (7, 3)]:
        up, down = w1.copy(), w1.copy()
        up[at] += 1e-6
        down[at] -= 1e-6
        assert slopes[at] == pytest.approx((loss(up) - loss(down)) / 2e-6, abs=1e-7)
    assert sum(r["part"] == "output_weight" for r in got) == CLASSES * p.neurons


def test_a_shard_holds_its_documents_as_flat_arrays():
    """However its rows are cut and ordered the result is the same, and little more is held than the words' numbers."""
    rng, n, per, neurons = np.random.default_rng(5), 2000, 40, 3
    dense = trainer.initial_dense(neurons, 2, 1)
    step = trainer._shard_step(dense, TrainingParams(neurons=neurons), 1, 1)
    idx = np.sort(rng.integers(1, 5000, (n, per)), axis=1).astype(np.int32)
    docs = pa.table({
        "shard": [2] * n, "doc_id": np.arange(n) * 3, "label_idx": rng.integers(0, 2, n),
        "idx": pa.array(list(idx)), "tfidf": pa.array(list(rng.random((n, per)))),
    })
    used = np.unique(idx).astype(np.int64)
    words = pa.table({"shard": [2] * len(used), "idx": used, **{c: rng.random(len(used)) for c in trainer._state_columns(neurons)}})
    tracemalloc.start()
    one = step((pa.scalar(2),), docs, words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * idx.size + 8 * 12 * neurons * len(used)
    cut = pa.concat_tables([docs.slice(900), docs.slice(0, 500), docs.slice(500, 400)])
    two = step((pa.scalar(2),), cut, words.take(pa.array(rng.permutation(len(used)))))
    assert two.sort_by("idx").equals(one.sort_by("idx")) and one["docs"][0].as_py() == n
    moved = one.filter(pc.greater(one["idx"], 0))
    assert moved["idx"].to_numpy().tolist() == used.tolist() and np.abs(moved["d0"].to_numpy()).min() >= 0


def test_no_two_shards_share_a_task(spark):
    """With as many partitions as shards, three of eight met in one task."""
    shards = spark.range(8).select(F.col("id").cast("int").alias("shard"))
    dealt = shards.repartition(trainer._partitions_for(spark, 8), "shard")
    assert dealt.select(F.spark_partition_id()).distinct().count() == 8
    assert trainer._partitions_for(spark, 1) == 1


def test_steps_without_gradient_are_added_in_closed_form():
    """For any size of the moments, and from one step to many, what a word does while no document has it."""
    rng = np.random.default_rng(2)
    first = rng.normal(size=(300, 2)) * 10.0 ** rng.uniform(-12, 1, (300, 1))
    second = first**2 * 10.0 ** rng.uniform(-3, 1, (300, 1))
    second[:10], first[:10] = 0, 0
    for before, after in ((0, 1), (0, 40), (7, 9), (3, 900), (5000, 5300)):
        wanted = np.stack([np.zeros_like(first), first, second])
        for t in range(before + 1, after + 1):
            wanted[1] *= 0.9
            wanted[2] *= 0.999
            wanted[0] -= 0.001 * np.sqrt(1 - 0.999**t) / (1 - 0.9**t) * wanted[1] / (np.sqrt(wanted[2]) + 1e-7)
        got = trainer._faded(np.stack([np.zeros_like(first), first, second]), before, after)
        assert np.allclose(got, wanted, rtol=1e-11, atol=0)


def test_a_step_costs_what_its_documents_hold(spark):
    """Words that a batch lacks were updated at every step: with these it took 6.6 s, without them 0.11 s."""
    n, rare, neurons = 1500, 400_000, 5
    docs = pa.table({"shard": [0] * n, "doc_id": range(n), "label_idx": [d % 2 for d in range(n)], "idx": pa.array([[1 + d % 9] for d in range(n)], pa.list_(pa.int32())), "tfidf": [[1.0]] * n})
    seconds = []
    for more in (0, rare):
        idx = np.arange(1, 10 + more)
        words = pa.table({"shard": np.zeros(len(idx), int), "idx": idx, **{c: np.full(len(idx), 0.1) for c in trainer._state_columns(neurons)}})
        step = trainer._shard_step(trainer.initial_dense(neurons, 2, 1), TrainingParams(neurons=neurons, batch_size=2, averages_per_epoch=1), 1, 1)
        began = time.perf_counter()
        step((pa.scalar(0),), docs, words)
        seconds.append(time.perf_counter() - began)
    assert seconds[1] < 10 * seconds[0] + 2


def test_one_round_of_weights_is_kept(spark, data, tmp_path):
    _, features, vocab = data
    trainer.train_network(features, vocab, WIDTH - 2, CLASSES, 120, params(epochs=2, shards=2, averages_per_epoch=2), f"{tmp_path}/t")
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["documents", "weights-2-2"]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("lexmill_")]


def test_documents_cut_into_pieces_are_whole():
    """However batches cut a shard's documents, they come with all their words, in order; those without words too."""
    rng = np.random.default_rng(4)
    per = [0, 3, 40, 1, 17, 0, 25]
    rows = [(10 - d, d % 3, int(i), float(i) / 7) for d, n in enumerate(per) for i in sorted(rng.choice(90, n, replace=False) + 1)]
    rows += [(10 - d, d % 3, None, None) for d, n in enumerate(per) if not n]
    keys = ["split", "shard", "doc_id", "label_idx"]
    found = []
    for size in (7, 1000):
        batch = pa.RecordBatch.from_arrays(
            [pa.array(["train"] * len(rows)), pa.array([0] * len(rows), pa.int32()), *[pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.float64()))]],
            [*keys, "idx", "tfidf"],
        )
        cut = [batch.slice(at, size) for at in range(0, len(rows), size)]
        words, docs = trainer._documents(pa.Table.from_batches(trainer._fragments(keys)(iter(cut))), 4)
        _, at = docs.words_of(np.arange(len(docs.length)))
        found.append((words.tolist(), docs.targets.tolist(), docs.length.tolist(), words[docs.column[at]].tolist(), docs.value[at].tolist()))
    assert found[0] == found[1]
    assert found[0][2] == per[::-1] and found[0][1] == [d % 3 for d in range(len(per))][::-1]
    assert found[0][3] == [i for d in reversed(range(len(per))) for x, _, i, _ in rows if x == 10 - d and i is not None]
