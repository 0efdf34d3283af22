import re

import duckdb

from martloom.llm import licences, queries
from tests.llm.test_operators import ODD, SF, frame

MIT = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
BSD = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
# 1. Redistributions of source code must retain the above copyright notice, this
#    list of conditions and the following disclaimer.
# 2. Redistributions in binary form must reproduce the above copyright notice,
#    this list of conditions and the following disclaimer in the documentation
#    and/or other materials provided with the distribution.
"""
THIRD = """# 3. Neither the name of the Example Project nor the names of its
#    contributors may be used to endorse or promote products derived from this
#    software without specific prior written permission.
"""
APACHE = """ * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
"""
GNU = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n" \
    "the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."
TEXTS = {
    MIT: ["MIT"], BSD: ["BSD-2-Clause"], BSD + THIRD: ["BSD-3-Clause"], APACHE: ["Apache-2.0"], GNU: ["GPL-3.0-or-later"],
    "prose without a stop\nLicensed under CC BY-NC 4.0.\nmore prose": ["CC-BY-NC-4.0"],
    "Released under the MIT License.": ["MIT"],
    "This work is licensed under the GNU General Public License, version 3.": ["GPL-3.0-only"],
    "This work is licenced under the terms of the GNU Lesser General Public Licence, version 2.1 or (at your option) any later version!": ["LGPL-2.1-or-later"],
    "// SPDX-License-Identifier: AGPL-3.0-only": ["AGPL-3.0-only"],
    "It is released under the mit license of old. We met mit.": [],
    "Released under the MIT License.\n\nReleased under\nthe MIT\nLicense.": ["MIT", "MIT"],
    MIT + APACHE: ["MIT", "Apache-2.0"], "mit": [], "x " * 200000 + "\nReleased under the MIT License.": ["MIT"],
}


def test_texts_of_licences(spark):
    df = frame(spark, list(enumerate(TEXTS)))
    got = {r["doc_id"]: r["licenses"] for r in licences.licensed(df).collect()}
    assert got == dict(enumerate(TEXTS.values()))


def _header(thing, words, sign, version):
    """The header the Free Software Foundation publishes with a licence."""
    return f"""    Copyright (C) 2001  Some Body

    This {thing} is free software{':' if sign == ',' else sign} you can redistribute it and/or
    modify it under the terms of the GNU {words}General Public
    License as published by the Free Software Foundation{sign} either
    version {version} of the License, or (at your option) any later version.

    This {thing} is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
    {words}General Public License for more details.
"""


MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
HEADERS = {
    _header("program", "", ";", "2"): ["GPL-2.0-or-later"], _header("program", "", ",", "3"): ["GPL-3.0-or-later"],
    _header("library", "Lesser ", ";", "2.1"): ["LGPL-2.1-or-later"], _header("library", "Lesser ", ",", "3"): ["LGPL-3.0-or-later"],
    _header("library", "Library ", ";", "2"): ["LGPL-2.0-or-later"], _header("program", "Affero ", ",", "3"): ["AGPL-3.0-or-later"],
    _header("program", "Affero ", ";", "3").replace("\n", "\n * "): ["AGPL-3.0-or-later"], MPL: ["MPL-2.0"],
    "int x;\n" + MPL.replace("Public\n * License", "Public License").replace("v. 2.0", "version 2.0"): ["MPL-2.0"],
    "Licensed under the Mozilla Public License, v. 2.0.": ["MPL-2.0"],
    _header("program", "", ";", "2").replace("version 2 of the License, or (at your option) any later version", "version 2 of the License"): ["GPL-2.0-only"],
    "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License version 2 as\n"
    "published by the Free Software Foundation.": ["GPL-2.0-only"],
    _header("program", "", ";", "2") + MPL + _header("library", "Lesser ", ";", "2.1"): ["GPL-2.0-or-later", "MPL-2.0", "LGPL-2.1-or-later"],
}


def test_published_headers(spark):
    df = frame(spark, list(enumerate(HEADERS)))
    rows = {r["doc_id"]: r for r in licences.licensed(df).collect()}
    assert {i: r["licenses"] for i, r in rows.items()} == dict(enumerate(HEADERS.values()))
    assert all(None not in r["sentences"] for r in rows.values()) and rows[0]["n_other"] == rows[7]["n_other"] == 0
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(HEADERS)))
    for i, sentences, names, other in con.execute(f"WITH {licences.sql('documents')} SELECT doc_id, sentences, licenses, n_other FROM scanned").fetchall():
        assert (sentences, names, other) == (rows[i]["sentences"], rows[i]["licenses"], rows[i]["n_other"])
    odd = licences.licensed(frame(spark, [(1, _header("program", "", ";", "7"))])).first()
    assert odd["licenses"] == [] and odd["n_other"] > 0


def test_odd_rows_and_clashing_names(spark):
    df = frame(spark, ODD).selectExpr("*", "1 AS LICENSES", "2 AS n_other", "3 AS _form2")
    rows = licences.licensed(df).collect()
    assert len(rows) == len(ODD) and all(r["sentences"] == r["licenses"] == [] and r["n_other"] == 0 for r in rows)
    assert licences.licensed(frame(spark, [])).count() == 0
    other = licences.licensed(frame(spark, [(1, "This is licensed under a licence agreement of our own.")])).first()
    assert (other["licenses"], other["n_other"]) == ([], 2)


def test_query_against_single_lines(spark):
    """The table has whole-line licence sentences; read them line by line."""
    known = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
    }
    for sf in (SF, SF.replace("0.001", "0.01")):
        docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
        got = {r["doc_id"]: r["licenses"] for r in queries.op5_licence_rules(spark, sf).collect()}
        assert got == {i: ",".join(known[x] for x in re.split(r"[\r\n]", t or "") if x in known) for i, t in docs.items()}


def test_rules_name_known_sentences():
    assert {k for ids, _ in licences.RULES for k in ids} | licences.IGNORED <= set(licences.SENTENCES)
