"""Whole licence texts in other clothes, and texts that are none."""

from __future__ import annotations

import textwrap

import duckdb
from pyspark.sql import functions as F

from tariffa.llm import license_scan

SCHEMA = "doc_id long, text string, license_id string, text_digest string"


def test_disguised_texts_are_found(spark):
    mit, isc = license_scan.KNOWN["MIT"], license_scan.KNOWN["ISC"]
    texts = {
        1: mit,
        2: "Copyright (c) 2020 Somebody\n# © 2021 Another\n" + mit.upper(),
        3: "\n".join(f" * {line}" for line in mit.replace("License", "Licence").split("\n")),
        4: mit.replace("sublicense", "sub-licence").replace(" ", "   "),
        5: isc,
        6: mit + " and one more word",
        7: mit[:-20],
        8: None,
        9: "",
        10: "Copyright 2020 me\n",
        11: "!!! ???",
        12: "word " * 100_000,
    }
    rows = [(i, t, "x", "y") for i, t in texts.items()] + [(None, mit, "x", "y"), (1, mit, "x", "y")]
    found = license_scan.scan(spark.createDataFrame(rows, SCHEMA), license_scan.known_licenses(spark)).collect()
    assert len(found) == len(rows)
    assert {(r["doc_id"], r["license_id"]) for r in found} == {
        (1, "MIT"), (2, "MIT"), (3, "MIT"), (4, "MIT"), (None, "MIT"), (5, "ISC"), *((i, None) for i in range(6, 13))
    }


def test_known_texts_differ_and_find_themselves(spark):
    known = license_scan.known_licenses(spark)
    found = license_scan.scan(known.withColumnRenamed("license_id", "doc_id"), known).collect()
    assert all(r["doc_id"] == r["license_id"] for r in found) and len({r["text_digest"] for r in found}) == len(license_scan.KNOWN)


def test_equal_texts_go_by_the_smaller_name(spark):
    known = spark.createDataFrame([("b", "Some Licence"), ("a", "some LICENSE."), ("none", None)], "license_id string, text string")
    docs = spark.createDataFrame([(1, "SOME license", "", "")], SCHEMA)
    assert license_scan.scan(docs, known).first()["license_id"] == "a"
    assert license_scan.scan(docs, known.limit(0)).first()["license_id"] is None
    assert license_scan.scan(docs.limit(0), known).count() == 0


def test_sql_has_the_same_canonical_form(spark):
    texts = ["The Organisation's  sub-licence!", "x\n(c) me\ny", "* Copyright you\nz", "Ä ÖL", "whilst WHILST", ""]
    column = spark.createDataFrame([(t,) for t in texts], "text string").select(license_scan.canonical(F.col("text")))
    got = [r[0] for r in column.collect()]
    con = duckdb.connect()
    want = [con.execute(f"SELECT {license_scan.canonical_sql('t')} FROM (SELECT ? AS t)", [t]).fetchone()[0] for t in texts]
    assert got == want


TITLES = {
    "MIT": ["The MIT License (MIT)", "MIT License"],
    "ISC": ["ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": ["The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License'],
    "0BSD": ["Zero-Clause BSD License", "BSD Zero Clause License"],
    "Zlib": ["zlib License"],
}
NOTICES = ["", "Copyright (c) 2020, Some Body\nAll rights reserved.", "Copyright 1990, 1993\n\tThe Regents.  All rights reserved.", "© The Authors", "Copyright [yyyy] [owner]"]


def published():
    """Each licence with a title and without, with notices of several kinds, wrapped at several widths."""
    for name, titles in TITLES.items():
        lines = license_scan.KNOWN[name].split("\n")
        body = lines if name.startswith("BSD") else lines[1:]
        for title in ["", *titles]:
            for width in (*range(40, 100, 3), 10_000):
                wrapped = "\n\n".join(textwrap.fill(line, width) for line in body)
                yield name, f"{title}\n\n{NOTICES[width % len(NOTICES)]}\n\n{wrapped}\n"


def test_published_layouts_at_several_widths(spark):
    cases = list(published())
    docs = spark.createDataFrame([(i, t, "", "") for i, (_, t) in enumerate(cases)], SCHEMA)
    found = {r["doc_id"]: r["license_id"] for r in license_scan.scan(docs, license_scan.known_licenses(spark)).collect()}
    assert [found[i] for i in range(len(cases))] == [name for name, _ in cases]


def test_long_licences_are_known(spark):
    names = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0"]
    texts = [textwrap.indent(license_scan.KNOWN[n], " * ", lambda _: True).replace("[yyyy] [name", "2021 [name") for n in names]
    docs = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], SCHEMA)
    found = {r["doc_id"]: r["license_id"] for r in license_scan.scan(docs, license_scan.known_licenses(spark)).collect()}
    assert [found[i] for i in range(len(names))] == names


def test_sentences_about_copyright_stay():
    con = duckdb.connect()
    for text in ("copyright notice and this permission notice appear", "c you must retain", "copyright holders and others"):
        given = text.replace("c you", "(c) You")
        assert con.execute(f"SELECT {license_scan.canonical_sql('t')} FROM (SELECT ? AS t)", [given]).fetchone()[0] == text


def test_sql_drops_the_same_notices(spark):
    texts = [t for _, t in published()][::7] + ["a\r\n(C) 2020 x\r\nAll rights reserved.\r\nb", "a\rcopyright 2020 b", "MIT License", "x\u2028© y"]
    column = spark.createDataFrame([(t,) for t in texts], "text string").select(license_scan.canonical(F.col("text")))
    con = duckdb.connect()
    want = [con.execute(f"SELECT {license_scan.canonical_sql('t')} FROM (SELECT ? AS t)", [t]).fetchone()[0] for t in texts]
    assert [r[0] for r in column.collect()] == want
