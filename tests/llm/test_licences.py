"""Licence scan: texts that differ in form only have one digest."""

import textwrap

import duckdb
import pytest
from pyspark.sql import functions as F

from shardlog.llm import licences
from tests.llm.cases import awkward, documents

MIT = dict((n, t) for n, t in licences.KNOWN if len(t) > 500)["MIT"]


@pytest.mark.parametrize("text,license,lines", [
    (MIT, "MIT", ""),
    ("Copyright (c) 2020 Somebody\n\n" + MIT.upper().replace("SUBLICENSE", "sub-licence"), "MIT", ""),
    ("© 2020 me\n" + MIT.replace("\n", "  \r\n").replace('"', "''").replace("copyright holders", "copyright owners"), "MIT", ""),
    (MIT + " And no more.", None, ""),
    ("Some text.\nreleased under the mit licence\nmore\nLicensed under CC BY-NC 4.0.", None, "CC-BY-NC-4.0,MIT"),
    ("Released under the MIT License.", "MIT", "MIT"),
    ("This says it is not Released under the MIT License.", None, ""),
    (None, None, ""), ("", None, ""), ("...", None, ""),
])
def test_forms(spark, text, license, lines):
    got = licences.licences(documents(spark, [(1, text, None, None)]), licences.known_digests(spark)).first()
    assert (got.license, got.line_licenses) == (license, lines)
    assert (got.text_digest is None) == (not text or text == "...")


SOFTWARE = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
AUTHOR = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
# as they are published
PUBLISHED = {
    "MIT": ("""Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""", """The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.""", SOFTWARE),
    "ISC": ("""Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""", AUTHOR),
    "0BSD": ("""Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.""", AUTHOR),
}


def test_wrapping_does_not_matter(spark):
    texts = []
    for name, parts in PUBLISHED.items():
        plain = [" ".join(p.split()) for p in parts]
        for width in (None, 10_000, *range(20, 130, 3)):
            texts.append((name, "Copyright (c) 2015 Some Body\n\n" + "\n\n".join(parts if width is None else (textwrap.fill(p, width) for p in plain))))
    docs = documents(spark, [(i, t, None, None) for i, (_, t) in enumerate(texts)])
    got = {r.doc_id: r.license for r in licences.licences(docs, licences.known_digests(spark)).collect()}
    assert [got[i] for i in range(len(texts))] == [n for n, _ in texts]


def test_whole_licence_files(spark):
    """As files hold them: title, holder, terms, and the appendix or not."""
    mine, files = "Copyright (c) 2015 Some Body\n\n", {p.stem: p.read_text().split("\f\n") for p in licences.PUBLISHED.glob("*.txt")}
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"} <= set(files)
    texts = [(n, f"{n} License\n\n{mine}" + "\n\n".join(parts)) for n, parts in PUBLISHED.items() if n != "0BSD"]
    for name, (titles, *parts) in files.items():
        for title in ("", titles.split("|\n")[0]):
            texts += [(name, title + "\n" + mine + "".join(parts)), (name, (title + "\n" + parts[0]).replace("\n", "\r\n"))]
        texts.append((None, "".join(parts).rsplit(None, 1)[0]))
    docs = documents(spark, [(i, t, None, None) for i, (_, t) in enumerate(texts)])
    got = {r.doc_id: r.license for r in licences.licences(docs, licences.known_digests(spark)).collect()}
    assert [got[i] for i in range(len(texts))] == [n for n, _ in texts]


@pytest.mark.parametrize("line,named", [
    ("Copyright (c) 2015 Some Body, Inc.", True), ("  * Copyright 2015-2020 holders of x", True), ("(C) 2015 me", True), ("© Ünal", True),
    ("COPYRIGHT Joyent, Inc. and other Node contributors", True), ("Copyright The Kubernetes Authors.", True), ("copyright: Noticeable Ltd", True),
    ("Copyright <YEAR> <OWNER>", True), ("Copyright © Évora", True), ("All rights reserved.", True), ("Copyright Act", False),
    ("COPYRIGHT HOLDERS BE LIABLE", False), ("copyright owner", False), ("Copyright notice, this list", False), ("copyright", False),
    ("(c) You must retain", False), ("copyrighted by 2 people", False), ("copyright “holder”", False), ("No copyright 2015", False),
])
def test_lines_that_name_a_holder(spark, line, named):
    got = spark.createDataFrame([(f"x\n{line}\ny",)], "t string").select(licences.canonical(F.col("t"))).first()[0]
    assert (got == "x y") == named
    assert duckdb.execute("SELECT regexp_replace(?, ?, ' ', 'g')", [f"x\n{line}\ny".lower(), licences.COPYRIGHT.replace("(?md)", "(?m)")]).fetchone()[0].split() == (
        ["x", "y"] if named else f"x {line} y".lower().split()
    )


def test_awkward_and_empty(spark):
    known = licences.known_digests(spark)
    rows = [*awkward(), (5, "Released under the MIT License.\n" * 3, None, None)] * 2
    got = licences.licences(documents(spark, rows, extra=True), known)
    assert got.count() == len(rows)
    assert [r.n_license_lines for r in got.where("n_license_lines > 0").collect()] == [3, 3]
    assert licences.licences(documents(spark, []), known).count() == 0


def test_equivalent_spellings(spark):
    df = spark.createDataFrame([("Organisation's LICENCE, https://x -- favour",)], "t string")
    assert df.select(licences.canonical(F.col("t"))).first()[0] == "organization s license http x favor"
