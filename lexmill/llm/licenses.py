"""License notices in documents, with built-in functions only.

Words are runs of a-z and 0-9 after lower-casing, a shingle is ``SHINGLE`` words in a row. Windows of ``WINDOW`` shingles
overlap by half. A window's MinHash values are taken by one permutation: the smallest hash in each of 4 096 ranges of hashes that
the window meets. A template has the like over all its shingles; one equal value, a band of one row, retrieves
it. A template's smallest hashes stay the smallest in every window that lies inside a copy of it, so an unchanged copy of more than
a window is always retrieved. The shortest notices, of one shingle, share their window with seven others: these hide the value with a
probability of 7 / 8 192, and hardly ever in both windows that hold the notice.

With windows this short that comes to a look-up of nearly every shingle: a shingle is hidden in a window with a probability of at most
7 / 8 192. A template retrieves by its ``SKETCH`` smallest values at most. A document that holds ``CONTAINED`` of a longer template, the
lost shingles being independent of their hashes, misses all of them with a probability below 0.2 ** 64.

What is retrieved is verified exactly: the share of the template's shingles that the document holds must reach ``CONTAINED``.
A license has several templates: whole text, header, wordings. A document gives one row for each license, that of the
template of which it holds most shingles, then of the shorter one. Licenses that share their wording, as GPL versions, can all be given.
Everything is local to a row; nothing is exchanged. The templates are a small table that every task holds: their number is checked.

Null and empty texts, and those of fewer than three words, match nothing. Repeated rows are scanned each; templates that are null or
shorter than a shingle are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.license_templates import shipped
from lexmill.llm.support import texts_of

SHINGLE = 3
WINDOW, STRIDE = 8, 4
CONTAINED = 0.8
MOST_TEMPLATES = 4096
SKETCH = 64
_RANGE_BITS = 12

# Short notices of common licenses.
NOTICES: tuple[tuple[str, str], ...] = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("mit", "Released under the MIT License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd", "Use of this source code is governed by a BSD-style license."),
    ("all-rights-reserved", "All rights reserved."),
)


def notices(spark: SparkSession) -> DataFrame:
    """The templates shipped: ``NOTICES``, and whole texts, headers and other wordings."""
    return spark.createDataFrame([*NOTICES, *shipped()], "license_id string, text string")


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once per row: later filters and projections cannot pull its expression up."""
    return df.select(*df.columns, F.explode(F.array(value)).alias(name))


def _with_shingles(texts: DataFrame) -> DataFrame:
    """(..., hashes): hashes of the shingles of ``text`` in order."""
    words = _once(texts, "words", F.array_remove(F.split(F.lower("text"), "[^a-z0-9]+"), "")).drop("text")
    at = F.sequence(F.lit(0), F.size("words") - SHINGLE)
    w = F.col("words")
    hashed = F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
    nothing = F.array().cast("array<bigint>")
    return _once(words, "hashes", F.when(F.size("words") >= SHINGLE, hashed).otherwise(nothing)).drop("words")


def _range_minima(ordered: Column) -> Column:
    """Of sorted hashes the first of each range."""
    part = lambda x: F.shiftrightunsigned(x, 64 - _RANGE_BITS)
    return F.filter(ordered, lambda x, i: (i == 0) | (part(x) != part(F.get(ordered, i - 1))))


def _with_windows(shingled: DataFrame) -> DataFrame:
    """(..., hashes, minima): the MinHash values of all windows."""
    h = F.col("hashes")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(h) - (WINDOW - STRIDE)), F.lit(STRIDE))
    windows = _once(shingled, "windows", F.transform(starts, lambda s: F.sort_array(F.slice(h, s, WINDOW))))
    return _once(windows, "minima", F.flatten(F.transform("windows", _range_minima))).drop("windows")


def _templates(templates: DataFrame, id_column: str, text_column: str) -> list:
    """(license_id, shingles, bands) of every usable template."""
    rows = templates.select(F.col(id_column).cast("string").alias("license_id"), F.col(text_column).cast("string").alias("text"))
    shingled = _with_shingles(rows.where("license_id IS NOT NULL AND text IS NOT NULL"))
    sets = _once(shingled, "shingles", F.sort_array(F.array_distinct("hashes"))).where(F.size("shingles") > 0)
    found = sets.select("license_id", "shingles", F.slice(_range_minima(F.col("shingles")), 1, SKETCH).alias("bands")).distinct()
    kept = found.orderBy("license_id", "shingles").limit(MOST_TEMPLATES + 1).collect()
    if len(kept) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates: scan in parts")
    return kept


def _longs(values: list[int]) -> Column:
    """One literal once folded, however many values."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _literal(templates: list) -> Column:
    return F.array(
        *[
            F.struct(F.lit(t["license_id"]).alias("license_id"), _longs(t["shingles"]).alias("shingles"), _longs(t["bands"]).alias("bands"))
            for t in templates
        ]
    )


def _foremost(held: Column) -> Column:
    """Of each license the entry with most shingles found, then with the fewest shingles."""
    before = lambda x, y: (y["n_found"] > x["n_found"]) | ((y["n_found"] == x["n_found"]) & (y["n_shingles"] < x["n_shingles"]))
    beaten = lambda x: F.exists(held, lambda y: (y["license_id"] == x["license_id"]) & before(x, y))
    return F.array_distinct(F.filter(held, lambda x: ~beaten(x)))


def scan(
    docs: DataFrame,
    templates: DataFrame | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    template_id: str = "license_id",
    template_text: str = "text",
) -> DataFrame:
    """(doc_id, license_id, n_found, n_shingles, containment) for every document and license it contains."""
    spark = docs.sparkSession
    known = _templates(templates if templates is not None else notices(spark), template_id, template_text)
    result = ["doc_id", "license_id", "n_found", "n_shingles", "containment"]
    if not known:
        return spark.createDataFrame([], "doc_id bigint, license_id string, n_found int, n_shingles int, containment double")
    bands = _longs(sorted({b for t in known for b in t["bands"]}))
    minima = F.col("minima")
    scanned = _with_windows(_with_shingles(texts_of(docs, id_column, text_column))).where(F.arrays_overlap(minima, bands))
    near = _once(scanned, "hits", F.array_intersect(bands, minima)).drop("minima")
    retrieved = _once(near, "near", F.filter(_literal(known), lambda t: F.arrays_overlap(t["bands"], F.col("hits")))).drop("hits")
    counted = F.transform(
        "near",
        lambda t: F.struct(
            t["license_id"].alias("license_id"),
            F.size(F.array_intersect(t["shingles"], F.col("hashes"))).alias("n_found"),
            F.size(t["shingles"]).alias("n_shingles"),
        ),
    )
    share = lambda t: t["n_found"] / t["n_shingles"]
    held = _once(_once(retrieved, "counted", counted).drop("near", "hashes"), "held", F.filter("counted", lambda t: share(t) >= CONTAINED))
    rows = held.select("doc_id", F.explode(_foremost(F.col("held"))).alias("t")).select("doc_id", "t.*")
    return rows.withColumn("containment", F.col("n_found") / F.col("n_shingles")).select(*result)


def oracle() -> str:
    """The same rows in DuckDB, from every shingle of every document."""
    known = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in NOTICES)
    words = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda w: w <> '')"
    grams = "SELECT DISTINCT {id}, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])) AS gram FROM {src}"
    return f"""
        WITH known(license_id, notice) AS (VALUES {known}),
        template AS ({grams.format(id="license_id", src=f"(SELECT license_id, {words.format('notice')} AS w FROM known)")}),
        sizes AS (SELECT license_id, count(*) AS total FROM template GROUP BY 1),
        held AS ({grams.format(id="doc_id", src=f"(SELECT doc_id, {words.format('text')} AS w FROM documents)")}),
        hits AS (SELECT doc_id, license_id, count(*) AS found FROM held JOIN template USING (gram) GROUP BY 1, 2)
        SELECT doc_id, license_id, CAST(found AS INTEGER) AS n_found, CAST(total AS INTEGER) AS n_shingles,
               CAST(found AS DOUBLE) / total AS containment
        FROM hits JOIN sizes USING (license_id) WHERE CAST(found AS DOUBLE) / total >= {CONTAINED}
    """
