"""Whole license texts and reworded notices are found with the templates shipped."""

from __future__ import annotations

from lexmill.llm import license_templates, licenses

WORDED = [
    ("This project is licensed under the MIT License.", "mit"),
    ("Licensed under the Apache License 2.0", "apache-2.0"),
    ("Copyright (c) 2020 A. Body. Distributed under the terms of the Apache License, Version 2.0", "apache-2.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gpl-3.0"),
    ("You can use it under the GNU Lesser General Public License, version 2.1 or later", "lgpl-2.1"),
    ("Licensed under the GNU Affero General Public License v3.0", "agpl-3.0"),
    ("// SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
     "from this software without specific prior written permission.", "bsd-3-clause"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
     "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "mpl-2.0"),
    ("Photos are licensed under CC BY 4.0.", "cc-by-4.0"),
]


def test_whole_texts_and_reworded_notices_are_found(spark):
    noise = " ".join(f"noise{i}" for i in range(300))
    whole = {k: license_templates._TEXTS / file for k, file in enumerate(license_templates._FILES)}
    rows = [(k, f"{noise}\n{path.read_text(encoding='utf-8')}\n{noise}") for k, path in whole.items()]
    rows += [(100 + k, f"{noise} {text} {noise}") for k, (text, _) in enumerate(WORDED)] + [(200, noise)]
    got: dict = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect():
        assert r["license_id"] not in got.setdefault(r["doc_id"], {})  # a license once
        got[r["doc_id"]][r["license_id"]] = r["containment"], r["n_shingles"]
    for k, license_id in enumerate(license_templates._FILES.values()):
        share, size = got[k][license_id]
        assert share == 1.0 and size > 90  # the whole text, not a notice in it
    for k, (_, license_id) in enumerate(WORDED):
        assert got[100 + k][license_id][0] == 1.0
    assert 200 not in got


def test_the_version_of_a_notice_matters(spark):
    rows = [(1, "under the GNU General Public License, version 2"), (2, "under the GNU General Public License, version 3")]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "license_id").collect()
    assert {tuple(r) for r in found} == {(1, "gpl-2.0"), (2, "gpl-3.0")}


def test_a_damaged_copy_of_a_whole_text_is_found(spark):
    words = (license_templates._TEXTS / "MPL-2.0").read_text(encoding="utf-8").split()
    damaged = " ".join("changed" if k % 40 == 0 else w for k, w in enumerate(words))  # about 3 of 40 shingles lost
    found = licenses.scan(spark.createDataFrame([(1, damaged)], "doc_id bigint, text string")).collect()
    assert any(r["license_id"] == "mpl-2.0" and 0.8 <= r["containment"] < 1 and r["n_shingles"] > 1000 for r in found)
