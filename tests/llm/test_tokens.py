from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lexmill.llm import binary_ids, bpe, packing
from lexmill.llm.words import default_vocabulary, library_encoder


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_vocabulary())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


UNUSUAL = [
    "it's We'RE !'s <|endoftext|> x<|startoftext|>", "", "Ωmega ΣΑΣ ß ÿ µ x́", "''s 'd 12ab'll", "a\x1cb\x85c\xa0d 　e",
    "İstanbul ǅ", "x<|y", "ÀÉ'S ½ ²", "日本語 한국어 😀", "aaaaaaaaaaaaaaaa " * 3, "\x00\x01", "!!!??? ...",
]


def test_words_once_equal_whole_texts(library, texts):
    encoder = library_encoder(default_vocabulary())
    for text in [*texts.values(), *UNUSUAL]:
        assert np.frombuffer(next(encoder.encode([text])), "<u4").tolist() == ids_of(library, text)


def test_small_memory_gives_the_same_ids(library, texts):
    encoder = library_encoder(default_vocabulary())
    small = type(encoder)(encoder.encode_piece, encoder.encode_whole, limit=20)
    some = list(texts.values())[:40]
    assert [np.frombuffer(i, "<u4").tolist() for i in small.encode(some)] == [ids_of(library, t) for t in some]


def test_prefix_encoding_equals_the_library(library, texts):
    codec = bpe.Codec(default_vocabulary())
    encoder = codec.text_encoder()
    rng = random.Random(1)
    made = ["".join(rng.choice("aeinothsr ") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    for text in [*texts.values(), *UNUSUAL, *made]:
        ids = memoryview(next(encoder.encode([text]))).cast("I").tolist()
        assert ids == ids_of(library, text)
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_automaton_finds_every_suffix_that_is_a_token():
    strings = [[1], [2], [1, 2], [2, 1], [1, 2, 1], [2, 2], [1, 1, 2, 2]]
    auto = bpe.SuffixAutomaton(strings, 4)
    rng = random.Random(2)
    for _ in range(200):
        text = [rng.choice([1, 2]) for _ in range(12)]
        state = matched = 0
        for end, symbol in enumerate(text, 1):
            while symbol not in [s for s in (1, 2) if state * 4 + s in auto.step] and state:
                state = auto.link[state]
                matched = auto.length[state]
            state, matched = auto.step[state * 4 + symbol], matched + 1
            at = state if auto.token[state] >= 0 and auto.length[state] <= matched else auto.shorter[state]
            found = set()
            while at:
                found.add(auto.token[at])
                at = auto.shorter[at]
            assert found == {k for k, s in enumerate(strings) if text[:end][-len(s):] == s}


def test_bpe_rows(spark, library, edge, empty):
    got = sorted(map(tuple, bpe.round_trip_digests(edge).collect()), key=repr)
    want = []
    for d, text in [tuple(r) for r in edge.select("doc_id", "text").collect()]:
        ids = ids_of(library, text)
        want.append((
            d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest(),
        ))
    assert got == sorted(want, key=repr)
    assert bpe.round_trip_digests(empty).count() == 0
    decoded = bpe.decode(bpe.encode(edge))
    assert sorted(map(repr, decoded.collect())) and decoded.count() == edge.count()


def test_pack_and_unpack_numbers():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        values = (rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        control, data = binary_ids.pack(values)
        assert len(control) == -(-n // 4) and (binary_ids.unpack(control, data, n) == values).all()


def expected_files(library, rows):
    out, start = [], 0
    coded = [(d, np.array([*ids_of(library, t), 2], "<u4")) for d, t in rows]
    for d, ids in sorted(coded, key=lambda x: (x[0] is not None, x[0] or 0, x[1].tolist())):
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_give_the_ids_back(spark, library, edge, docs, tmp_path):
    for k, df in enumerate((edge, docs)):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        binary_ids.write(df, f"{tmp_path}/{k}")
        got = [tuple(r) for r in binary_ids.read_digests(spark, f"{tmp_path}/{k}").collect()]
        want = expected_files(library, rows)
        if k:
            assert sorted(got) == want
        else:  # rows of one id, or of none, are ordered by their stored ids, whatever that order is
            assert sorted((d or 0, n, c) for d, _, n, c in got) == sorted((d or 0, n, c) for d, _, n, c in want)
            ends = sorted((s, s + n) for _, s, n, _ in got)
            assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
            order = [d for d, s, _, _ in sorted(got, key=lambda r: r[1])]
            assert order == sorted(order, key=lambda d: (d is not None, d or 0))


def test_commonest_ids_get_the_smallest_ranks(spark, docs, tmp_path):
    binary_ids.write(docs, str(tmp_path))
    ranks = spark.read.parquet(f"{tmp_path}/ids").orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == list(range(len(ranks)))
    assert [r["n"] for r in ranks] == sorted((r["n"] for r in ranks), reverse=True)
    sizes = binary_ids.read(spark, str(tmp_path)).selectExpr("sum(size(ids)) AS n").first()["n"]
    assert sum(r["n"] for r in ranks) == sizes


def test_empty_table_of_files(spark, empty, tmp_path):
    binary_ids.write(empty, str(tmp_path))
    assert binary_ids.read_digests(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_neighbours_touch(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
    keys = packing.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def check_packing(rows, pieces, library, width):
    coded: dict = {}
    for d, t in rows:
        coded.setdefault(d, []).append(np.array([*ids_of(library, t), 2], "<u4"))
    total = sum(len(i) for c in coded.values() for i in c)
    assert sum(p["length"] for p in pieces) == total
    for p in pieces:
        possible = {zlib.crc32(i[p["start"] : p["start"] + p["length"]].tobytes()) for i in coded[p["doc_id"]] if len(i) == p["doc_tokens"]}
        assert p["ids_crc32"] in possible and p["length"] > 0
    sequences: dict = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    lengths = []
    for _, parts in sorted(sequences.items()):
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        lengths.append(at)
    assert sorted(sequences) == list(range(len(sequences)))
    assert all(n == width for n in lengths[:-1]) and 0 < lengths[-1] <= width


def test_packing_fills_sequences(spark, library, edge, docs, empty):
    for df, width in ((edge, 64), (docs, 4096)):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        check_packing(rows, packing.pack(df, width).collect(), library, width)
    assert packing.pack(empty).count() == 0


def test_copies_lie_side_by_side(spark, docs):
    some = docs.limit(40).select("doc_id", "text")
    twice = some.unionByName(some.selectExpr("doc_id + 100000 AS doc_id", "text"))
    place = {(p["doc_id"], p["start"]): p["sequence_id"] * 4096 + p["offset"] for p in packing.pack(twice).collect()}
    tokens = {p["doc_id"]: p["doc_tokens"] for p in packing.pack(twice).collect()}
    order = sorted(tokens, key=lambda d: place[d, 0])
    where = {d: k for k, d in enumerate(order)}
    assert sum(abs(where[d] - where[d + 100000]) <= 3 for d in tokens if d < 100000) >= 38
