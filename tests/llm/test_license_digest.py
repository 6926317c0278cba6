"""Operator 5: canonical forms, whole-text and line matches, SQL."""

import contextlib
import io
import re

import duckdb
import pytest

from pomelo.llm import license_digest as L
from pomelo.llm.common import prepare, table

SF = "/root/testdata/sf0.01"


def forms(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r[0] for r in df.select(L.whole(L.canonical(df.text))).collect()]


def test_canonical_form(spark):
    prepare(spark)
    same = ["Licence, 'Programme' -- organisation!", "license\nPROGRAM   organization", "LICENCE programme licence".replace(" licence", " organisation"),
            "Copyright (c) 2020 Some Body\nlicense program organization", " (C) 1999 x\n© y\nAll rights reserved.\nlicense/program: organization"]
    assert set(forms(spark, same)) == {"license program organization"}
    got = forms(spark, ["licence licence licence", "sub-licence", "copyright\nowner x", "copyright holders be", "licences", None, "", "©"])
    assert got == ["license license license", "sublicense", "copyright holder x", "copyright holders be", "licences", "", "", ""]


def test_whole_texts_and_lines(spark):
    prepare(spark)
    mit = L.KNOWN["MIT"][0]
    rewrapped = "The MIT License\n\nCopyright (c) 2024 Jane Doe\n\n" + re.sub(r"(.{60}\S*) ", r"\1\n", mit).upper()
    rows = [(1, mit), (2, "Copyright 2020 A\n" + mit.replace("sublicense", "sublicence").lower()), (3, rewrapped.split("\n", 1)[1]),
            (4, "some words\nReleased under the MIT License.\n  licensed UNDER the Apache licence, version 2.0\nmore"),
            (5, mit + " and more"), (6, ""), (7, None), (None, "SPDX-License-Identifier: GPL-3.0"), (1, mit), (8, "x " * 100_000)]
    df = spark.createDataFrame([(*r, "k", "z") for r in rows], "doc_id long, text string, digest string, lines string")
    got = sorted(((r.doc_id, r.license_id, r.line_licenses) for r in L.report(df).collect()), key=repr)
    want = [(1, "MIT", ""), (1, "MIT", ""), (2, None, ""), (3, "MIT", ""), (4, None, "Apache-2.0,MIT"), (5, None, ""), (6, None, ""),
            (7, None, ""), (8, None, ""), (None, "GPL-3.0", "GPL-3.0")]
    assert got == sorted(want, key=repr)


def wrapped(text):
    return re.sub(r"(.{60}\S*) ", r"\1\n", text.replace("\n", "\n\n"))


def test_stock_license_files_as_they_are(spark):
    """Title line, notice and wrapped text; nothing is taken off first."""
    prepare(spark)
    titles = {"MIT": ["MIT License", "The MIT License (MIT)", "The MIT License"], "ISC": ["ISC License", "The ISC License"],
              "BSD-2-Clause": ["BSD 2-Clause License"], "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License"],
              "Zlib": ["zlib License", "The zlib/libpng License"], "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"], "Unlicense": ["The Unlicense"]}
    notices = ["Copyright (c) 2024 Jane Doe", "Copyright (c) 2017, Some Body\nAll rights reserved.",
               "Copyright 2011-2024 The First Authors,\nThe Second Authors and\ntheir contributors", "© 2020 X"]
    rows = []
    for license_id, names in titles.items():
        text = L.KNOWN[license_id][1 if license_id == "Unlicense" else 0]
        for name in names:
            for notice in notices:
                rows.append((license_id, f"{name}\n\n{notice}\n\n{wrapped(text)}\n"))
        rows.append((license_id, "  " + notices[0] + "\n\n" + wrapped(text).upper()))
    rows.append(("BSD-3-Clause", notices[1] + "\n\n" + wrapped(L.KNOWN["BSD-3-Clause"][0]).replace("1. ", "  * ").replace("2. ", "  * ").replace("3. ", "  * ")))
    rows += [(None, "MIT License\n\nwith other words"), ("MIT", "The MIT License"), (None, "mit license of mine\n" + wrapped(L.KNOWN["MIT"][0]))]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.license_id for r in L.report(df).collect()}
    assert [(i, got[i]) for i in got if got[i] != rows[i][0]] == []


def test_digests_of_longer_licenses(spark):
    """Of the system's own copies of the texts, where it has them."""
    import os
    folder = "/usr/share/common-licenses"
    files = {i: f"{folder}/{i.removesuffix('.0') if i[:3] in ('GPL', 'LGP') and i != 'LGPL-2.1' else i}" for i in L.KNOWN_DIGESTS}
    files = {i: f for i, f in files.items() if os.path.exists(f)}
    if not files:
        pytest.skip("no license texts on this system")
    prepare(spark)
    rows = [(i, open(f, encoding="utf-8", errors="replace").read()) for i, f in files.items()]
    df = spark.createDataFrame([*rows, ("none", rows[0][1] + " more")], "doc_id string, text string")
    assert {r.doc_id: r.license_id for r in L.report(df).collect()} == {**{i: i for i in files}, "none": None}


@pytest.mark.parametrize("limit", [0, 100_000])
def test_own_licenses_joined_either_way(spark, monkeypatch, limit):
    prepare(spark)
    monkeypatch.setattr(L, "BROADCAST_ROWS", limit)
    known = L.known_licenses(spark, spark.createDataFrame([("own", "My very own terms."), ("b", "my VERY own terms")], "license_id string, text string"))
    df = spark.createDataFrame([(1, "my very, own... terms"), (2, "a\nMy very own terms")], "doc_id long, text string")
    assert sorted((r.doc_id, r.license_id, r.line_licenses) for r in L.report(df, known).collect()) == [(1, "b", "b"), (2, None, "b")]


def test_query_against_sql_and_without_python(spark):
    from pomelo.llm.queries import ORACLES, QUERIES
    out = QUERIES["op5_license_digest"](spark, SF)
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        out.explain("formatted")
    assert not re.search("Python|Pandas|Arrow", text.getvalue())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got, want = out.collect(), con.execute(ORACLES["op5_license_digest"]).fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum(bool(r.line_licenses) for r in got) > 5
    assert len(got) == table(spark, SF, "documents").count()


def test_empty_table(spark):
    assert L.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
