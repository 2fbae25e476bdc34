"""Licence scan: canonical texts looked up by digest.

A text is made canonical (case, copyright lines, punctuation, white space and spellings
that count as equal) and hashed whole. The digests meet those of known licences in a join.
The same is done for each line, where notices such as "Released under ..." stand.
"""

from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlog.llm.common import text_of
from shardlog.workdir import materialised

# fixed values: words that follow "copyright" or "(c)" in terms, where no holder is named
TERMS = (
    "a", "act", "all", "an", "and", "any", "applicable", "are", "as", "at", "belongs", "claim", "claims", "conveying",
    "disclaimer", "doctrine", "do", "does", "each", "except", "for", "from", "held", "holder", "holders", "however",
    "if", "in", "information", "infringement", "interest", "interests", "is", "it", "its", "law", "laws", "like", "licence",
    "licences", "license", "licenses", "line", "lines", "may", "means", "mentions", "no", "not", "notice", "notices", "of",
    "on", "or", "otherwise", "owner", "owners", "ownership", "patent", "patents", "permission", "permissions", "policy",
    "prohibit", "protection", "provided", "right", "rights", "shall", "similar", "statement", "statements", "status",
    "such", "that", "the", "these", "this", "those", "to", "trademark", "treaty", "under", "where", "which", "with", "work",
    "works", "you", "your",
)


def _other_than(words: tuple[str, ...]) -> str:
    """A pattern for the start of a word that is none of ``words``, without lookahead, which SQL's patterns lack."""
    beyond = "ß-ɏͰ-῿぀-퟿"  # letters that are not ASCII

    def rest(depth: int, of: list[str]) -> str:
        then = sorted({w[depth] for w in of if len(w) > depth})
        each = [c + rest(depth + 1, [w for w in of if w[depth : depth + 1] == c]) for c in then]
        letters = "".join(c for c in "0123456789abcdefghijklmnopqrstuvwxyz" if c not in then) + beyond
        ends = depth and all(len(w) > depth for w in of)  # no word of the list, should it end here
        return "(?:" + "|".join([*each, f"[{letters}]", *([r"[^\p{L}\p{N}]|$"] if ends else [])]) + ")"

    return rest(0, list(words))


_GAP, _NAME = r"[^\p{L}\p{N}\n]*", _other_than(TERMS)
_GROUP = r"the\b[^\n]*\b(?:authors|contributors|developers|foundation|maintainers|project|team)\b"
# fixed values: lines that name a holder, by a year, a sign or a name; not terms that were wrapped before "copyright"
COPYRIGHT = (
    rf"(?md)^{_GAP}(?:copyright\b{_GAP}(?:©|{_GROUP}|{_NAME})|(?:\(c\)|©){_GAP}(?:copyright\b|{_GROUP}|{_NAME}))[^\n]*$"
    rf"|^{_GAP}all rights reserved{_GAP}$"
)
# fixed values: spellings and words that count as equal, replaced in this order in lower-case words between blanks
EQUIVALENT = (
    ("https", "http"), ("licence", "license"), ("behaviour", "behavior"), ("colour", "color"), ("favour", "favor"),
    ("honour", "honor"), ("labour", "labor"), ("authoris", "authoriz"), ("initialis", "initializ"), ("organis", "organiz"),
    ("recognis", "recogniz"), ("utilis", "utiliz"), ("merchandis", "merchandiz"), (" sub licens", " sublicens"),
    (" non commercial", " noncommercial"), (" non infringement", " noninfringement"), (" non exclusive", " nonexclusive"),
    (" copyright holder", " copyright owner"), ("judgement", "judgment"), (" centre ", " center "), (" whilst ", " while "),
    (" fulfil ", " fulfill "),
)
VERSION = (r" version (\d)", " v$1")
# fixed values: titles that may stand before texts
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License", "License: MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "ISC License (ISCL)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)", "0BSD License"),
}
# fixed values: texts of short licences and the notices that grant them
_SHORT = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)
PUBLISHED = Path(__file__).with_name("published")


def published(folder: Path = PUBLISHED) -> Iterator[tuple[str, str]]:
    """``(license, text)`` of the full texts stored in a folder, one file a licence.

    Form feeds divide a file into titles (any of those between lines "|"), the terms and
    what may follow them, such as an appendix. Each text comes with each title and without,
    and up to each part that may follow.
    """
    for path in sorted(folder.glob("*.txt")):
        titles, *parts = path.read_text(encoding="utf-8").split("\f\n")
        for title in ("", *titles.split("|\n")):
            for n in range(1, len(parts) + 1):
                yield path.stem, title + "\n" + "".join(parts[:n])


# fixed values: all texts that are looked up
KNOWN = (
    *_SHORT,
    *((name, title + "\n" + text) for name, text in _SHORT if len(text) > 400 for title in TITLES[name]),
    *published(),
)


def canonicals(texts: Column) -> Column:
    """The words of each text of an array as they count: lower case, equivalent spellings, one blank between.

    Lines that name a copyright holder go first, then everything but letters and digits. A
    text without words is empty. Each step is a pass of its own over the array, so that none of them is
    computed more than once.
    """

    def without_holders(x: Column) -> Column:
        named = x.contains("copyright") | x.contains("(c)") | x.contains("©") | x.contains("all rights")
        return F.when(named, F.regexp_replace(x, COPYRIGHT, " ")).otherwise(x)

    def equal_spellings(x: Column) -> Column:
        made = F.concat(F.lit(" "), F.regexp_replace(x, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
        for variant, put in EQUIVALENT:
            made = F.replace(made, F.lit(variant), F.lit(put))
        return made

    def short_versions(x: Column) -> Column:
        return F.trim(F.when(x.contains(" version "), F.regexp_replace(x, *VERSION)).otherwise(x))

    for step in (F.lower, without_holders, equal_spellings, short_versions):
        texts = F.transform(texts, step)
    return texts


def canonical(text: Column) -> Column:
    return F.get(canonicals(F.array(text)), F.lit(0))


def digests(texts: Column) -> Column:
    """The name of each canonical text of an array; null for one without words, which is no licence."""
    return F.transform(canonicals(texts), lambda x: F.when(x != "", F.unhex(F.sha2(x.cast("binary"), 256))))


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``(digest, license)`` of the known texts; of names with one digest the first."""
    rows = spark.createDataFrame(list(known), "license string, text string")
    named = rows.select(F.get(digests(F.array("text")), F.lit(0)).alias("digest"), "license").where("digest is not null")
    return materialised(named.groupBy("digest").agg(F.min("license").alias("license")), "licences")


def licences(documents: DataFrame, known: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row a document: ``doc_id``, ``text_digest``, ``license``, ``line_licenses``, ``n_license_lines``.

    ``license`` is that of the whole text, null if it is none; ``line_licenses`` names those
    of its lines, once each, in order of name, comma-separated (empty: none). ``known``
    comes from ``known_digests``: a stored table, so that Spark broadcasts it only when its
    files are small. Null texts count as empty and have no digest. Repeated rows are
    scanned each.
    """
    rows = documents.select(documents[key].alias("doc_id"), text_of(documents[text]).alias("text"))
    # the whole text first, then its lines
    pieces = digests(F.concat(F.array("text"), F.split("text", "\n")))
    found = rows.select("doc_id", pieces.alias("digests")).select(
        F.monotonically_increasing_id().alias("n"),
        "doc_id",
        F.get("digests", F.lit(0)).alias("digest"),
        F.filter("digests", lambda x, i: (i > 0) & x.isNotNull()).alias("lines"),
    )
    found = materialised(found, "digests")  # the numbers have to stay as they are for the joins
    lines = (
        found.select("n", F.explode("lines").alias("digest"))
        .join(known, "digest")
        .groupBy("n")
        .agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("line_licenses"), F.count(F.lit(1)).alias("n_license_lines"))
    )
    return (
        found.select("n", "doc_id", "digest")
        .join(known, "digest", "left")
        .join(lines, "n", "left")
        .select(
            "doc_id", F.lower(F.hex("digest")).alias("text_digest"), "license",
            F.coalesce("line_licenses", F.lit("")).alias("line_licenses"),
            F.coalesce("n_license_lines", F.lit(0)).alias("n_license_lines"),
        )
    )
