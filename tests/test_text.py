from __future__ import annotations

import random
import re
import sys
import unicodedata

import pytest
import truth
from pyspark.sql import functions as F

from lexmill.functions import text as tx
from lexmill.functions.folding import blank_symbols, fold_ascii, strip

GOLDEN = [
    (
        "the miller said it’s because of the rain that they can not grind, and we’re waiting now",
        "miller said rain grind re waiting",
    ),
    ("amanhã nós vamos à estação buscar o pão", "amanha nos vamos estacao buscar o pao"),
    ("the and of", ""),
    ("a;b", "b"),
    ("Straße ½ ﬁn", "Strae 12 fin"),
    ("café café", "cafe cafe"),
    ("", ""),
]


def column(spark, values, expr):
    df = spark.createDataFrame(list(enumerate(values)), "i bigint, t string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


@pytest.mark.parametrize("raw,wanted", GOLDEN)
def test_golden_clean(spark, raw, wanted):
    assert column(spark, [raw], tx.clean([F.col("t")])) == [wanted]
    assert truth.clean([raw]) == wanted


def test_two_fields_and_kept_stop_words(spark):
    df = spark.createDataFrame([("  The_cat isn't HERE now  ", "Straße ½ ﬁn")], "a string, b string")
    fields = [F.col("a"), F.col("b")]
    row = df.select(
        tx.clean(fields).alias("removed"),
        tx.clean(fields, remove=False).alias("kept"),
        tx.tokens(tx.clean(fields)).alias("tokens"),
    ).first()
    assert row["removed"] == "The_cat isn Strae 12 fin"
    assert row["kept"] == "The_cat isn t HERE now Strae 12 fin"
    assert row["tokens"] == ["the", "cat", "isn", "strae", "12", "fin"]


def test_every_code_point_matches_python(spark):
    """Symbols, white space and folding agree with Python on all of Unicode."""
    points = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    lines = ["x".join(chr(c) for c in points[i : i + 512]) for i in range(0, len(points), 512)]
    assert column(spark, lines, blank_symbols(F.col("t"))) == [re.sub(r"[^\w\s]", " ", t) for t in lines]
    folded = [unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in lines]
    assert column(spark, lines, fold_ascii(F.col("t"))) == folded
    blanks = [f"{chr(c)}a b{chr(c)}" for c in points if c < 0x3100]
    assert column(spark, blanks, strip(F.col("t"))) == [t.strip() for t in blanks]


def test_random_texts_match_python(spark):
    rng = random.Random(7)
    alphabet = "aZ_9 \t\n\r\x0b\x0c\x1c\x1f.,;'’“é́ß½ﬁ⑴⒈🄁　 \u0085ࡰ\U00011f02中한 —İ" + "the of "
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(4000)]
    assert column(spark, texts, tx.clean([F.col("t")])) == [truth.clean([t]) for t in texts]
    assert column(spark, texts, tx.clean([F.col("t")], remove=False)) == [truth.clean([t], False) for t in texts]
    kept = [truth.clean([t], False) for t in texts]
    assert column(spark, kept, tx.tokens(F.col("t"))) == [truth.tokens(t) for t in kept]


def test_stop_list_has_its_size():
    assert len(tx.STOP_WORDS) == 131 and len(set(tx.STOP_WORDS)) == 131


def test_split_fields_keeps_trailing_empties(spark):
    assert column(spark, ["a;b;;", "", "x"], tx.split_fields(F.col("t"))) == [["a", "b", "", ""], [""], ["x"]]


def test_percent_text_rounds_like_python(spark):
    from lexmill.functions.display import percent_text

    rng = random.Random(1)
    shares = [0.00125, 0.02675, 0.5, 0.0, 1.0, 12.3456] + [rng.random() for _ in range(2000)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shares)], "i bigint, s double").orderBy("i")
    got = df.select(percent_text(F.col("s")).alias("a"), percent_text(F.col("s"), 4).alias("b")).collect()
    assert [r["a"] for r in got] == [f"{s * 100:.2f}%" for s in shares]
    assert [r["b"] for r in got] == [f"{s * 100:.4f}%" for s in shares]
