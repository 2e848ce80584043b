"""Known licences by a digest of their canonical text.

Only built-in column functions. A text is brought to one form: A-Z lowered, copyright statements (not
lines of prose that begin with the word) taken out, punctuation and white space as one space, equivalent spellings as one. Its SHA-256 is joined to
those of known texts. The same is done for each line of a document and each paragraph, its lines up
to a blank one, so a notice within a document is found as well. A paragraph of a known text stands
for it there if it has ``LEAST_WORDS`` words and no other licence has it. The known texts are those of
``KNOWN`` and of the folder ``licenses`` (by SPDX name) with their usual variants, or a table of the
caller's; its digests are broadcast up to ``BROADCAST_BYTES``, a larger table is joined by shuffle.
Documents are read and brought to their form once.

Defined results: a null text is an empty one; an empty canonical text matches nothing; of known
texts with one canonical form, the smallest name counts.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, cut, text_key

_LEAD = r"^[\x20\x09\x0D*#/;-]*"
_SIGN = r"(?:\(c\)|©|&copy;)"
# What makes a line that begins with the word a statement: a sign, a year, 'by', a stand-in for the owner.
_OWNED = rf"[\x20\x09]*(?:{_SIGN}|[:,]?[\x20\x09]*(?:[0-9]{{4}}|by[\x20\x09]|[<\[{{]|year|yyyy|name of|holder name))"
COPYRIGHT = rf"{_LEAD}(?:copyright{_OWNED}|\(c\)[\x20\x09]*(?:copyright|[0-9]{{4}}|by[\x20\x09]|[<\[{{])|©|&copy;|all rights reserved)"
# A name after the word, in its own case: prose has a small letter there, headings have capitals or a noun of law.
NAMED = (
    rf"{_LEAD}(?:Copyright|\(C\))[\x20\x09]+(?!(?:Notices?|Licen[cs]es?|Holders?|Owners?|Laws?|Acts?|Statements?|Rights?|Treat(?:y|ies)|Interests?|"
    r"Protection|Infringement|Information|Permissions?|Status|Office|Conventions?|Grants?|Terms|And|Or|In|On|Of|To|Is)\b)[A-Z][^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[a-z]"
)
#: A paragraph of so many words that only one licence has stands for it.
LEAST_WORDS = 25
#: The most the known digests may take, in bytes, to be sent to all executors.
BROADCAST_BYTES = 32 << 20
# Lines with nothing but comment signs are blank.
BLANK = r"\n[\x20\x09\x0B-\x0D*#/;-]*(?=\n)"
MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F“”‘’–—•©]+"
# Spellings that count as equal, after lower case and punctuation.
EQUAL = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("merchantibility", "merchantability"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("initialisation", "initialization"),
    ("acknowledgement", "acknowledgment"),
    ("copyright owner", "copyright holder"),
    ("per cent", "percent"),
    ("wilful", "willful"),
    ("whilst", "while"),
]
# Public notices and short licences.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("ISC", "Released under the ISC License."),
    (
        "MIT",
        "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
        "to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "
        "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
        "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
        "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
]


def canonical_lines(text: Column) -> Column:
    """The lines of a text in canonical form, empty ones and copyright lines left out."""

    def one(line: Column) -> Column:
        form = F.trim(F.regexp_replace(line, MARKS, " "))
        for other, usual in EQUAL:
            form = F.replace(form, F.lit(other), F.lit(usual))
        return form

    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    stated = lambda x: ascii_lower(x).rlike(COPYRIGHT) | x.rlike(NAMED)
    return F.filter(F.transform(F.filter(lines, lambda x: ~stated(x)), lambda x: one(ascii_lower(x))), lambda x: x != "")


def _joined(lines: Column) -> Column:
    """Canonical lines as one text; spellings of two words may have stood on two lines."""
    form = F.array_join(lines, " ")
    for other, usual in EQUAL:
        if " " in other:
            form = F.replace(form, F.lit(other), F.lit(usual))
    return form


def _digest(form: Column) -> Column:
    return F.sha2(form, 256)


def _paragraphs(text: Column) -> Column:
    """The canonical lines of each paragraph."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), BLANK, -1), canonical_lines)


def known_digests(texts: DataFrame) -> DataFrame:
    """(digest, license) of a table with columns ``license`` and ``text``."""
    form = _joined(canonical_lines(F.col("text")))
    found = texts.select("license", form.alias("form")).filter("form <> ''")
    return found.groupBy(_digest(F.col("form")).alias("digest")).agg(F.min("license").alias("license"))


def paragraph_digests(texts: DataFrame) -> DataFrame:
    """(digest, license) of the paragraphs that tell one licence from all others."""
    parts = texts.select("license", F.explode(_paragraphs(F.col("text"))).alias("lines"))
    parts = parts.select("license", _joined(F.col("lines")).alias("form"))
    parts = parts.filter(F.size(F.split("form", " ")) >= LEAST_WORDS)
    found = parts.groupBy(_digest(F.col("form")).alias("digest"))
    found = found.agg(F.min("license").alias("license"), F.max("license").alias("last"))
    return found.filter("license = last").select("digest", "license")


def _lookup(known: DataFrame) -> DataFrame:
    """(digest, license, whole_license): what a line or paragraph says, and what a whole text does."""
    digests = known_digests(known).withColumn("whole", F.lit(True))
    parts = paragraph_digests(known).withColumn("whole", F.lit(False))
    table = digests.unionByName(parts).groupBy("digest").agg(
        F.min("license").alias("license"), F.min(F.when(F.col("whole"), F.col("license"))).alias("whole_license")
    )
    table = cut(table)
    names = F.octet_length("license") + F.coalesce(F.octet_length("whole_license"), F.lit(0))
    size = table.agg(F.sum(F.octet_length("digest") + names + 64)).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def _variants(text: str) -> set[str]:
    """A full text, without what follows its terms, each without its title, each without list numbers."""
    out = {text, re.split(r"END OF TERMS AND CONDITIONS", text)[0]}
    out |= {re.split(r"(?<=END OF TERMS AND CONDITIONS)", t)[0] for t in out}
    for t in list(out):
        first, _, rest = t.lstrip().partition("\n\n")
        if len(first.split()) < LEAST_WORDS:
            out.add(rest)
    short = {t for t in out if len(t) < 3000}
    out |= {re.sub(r"(?m)^[\x20\x09]*\(?[0-9][.)][\x20\x09]+", "", t) for t in short}
    return {t for t in out if len(t.split()) >= LEAST_WORDS}


def known_rows() -> list[tuple[str, str]]:
    """(licence, text) of every known text and its variants."""
    rows = set(KNOWN)
    for name, text in KNOWN:
        rows |= {(name, t) for t in _variants(text)}
    for file in sorted(resources.files(__package__).joinpath("licenses").iterdir(), key=lambda f: f.name):
        if file.name.endswith(".txt"):
            name = file.name.removesuffix(".txt").split("__")[0]
            rows |= {(name, t) for t in _variants(file.read_text(encoding="utf-8"))}
    return sorted(rows)


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_rows(), "license string, text string")


def find_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, digest, license, n_lines, line_licenses) for each row.

    ``digest`` and ``license`` are of the whole text, ``line_licenses`` the distinct licences of
    its lines and paragraphs, sorted, and ``n_lines`` the number of lines that are one or are part
    of a paragraph that is one.
    """
    rows = docs.select(docs[id_col].alias("id"), text_key(docs[text]).alias("key"), _paragraphs(docs[text]).alias("parts"))
    rows = rows.withColumn("lines", F.flatten("parts"))
    whole = _joined(F.col("lines"))
    rows = rows.withColumn("digest", F.when(whole != "", _digest(whole)))
    # A line is (place, 1, digest); a paragraph of several lines is (place of the first, lines, digest).
    lines = F.transform(
        "lines", lambda x, at: F.struct(at.alias("at"), F.lit(1).alias("size"), _digest(x).alias("digest"))
    )
    parts = F.aggregate(
        F.filter("parts", lambda p: F.size(p) > 0),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,size:int,digest:string>>").alias("all")),
        lambda acc, p: F.struct(
            (acc["at"] + F.size(p)).alias("at"),
            F.when(
                F.size(p) > 1,
                F.concat(acc["all"], F.array(F.struct(acc["at"].alias("at"), F.size(p).alias("size"), _digest(_joined(p)).alias("digest")))),
            ).otherwise(acc["all"]).alias("all"),
        ),
        lambda acc: acc["all"],
    )
    # The whole text is one more spot, of no lines; it stays without a match too, so no row is lost.
    own = F.array(F.struct(F.lit(-1).alias("at"), F.lit(0).alias("size"), F.col("digest")))
    spots = rows.select("id", "key", F.explode(F.concat(own, lines, parts)).alias("spot")).select("id", "key", "spot.*")
    met = spots.join(_lookup(known), "digest", "left")
    is_whole, is_unit = F.col("at") < 0, (F.col("at") >= 0) & F.col("license").isNotNull()
    found = (
        met.filter(is_whole | is_unit)
        .groupBy("id", "key")
        .agg(
            F.max(F.when(is_whole, F.col("digest"))).alias("digest"),
            F.max(F.when(is_whole, F.col("whole_license"))).alias("license"),
            F.count_if(is_whole).cast("int").alias("copies"),
            F.collect_set(F.when(is_unit, F.struct("at", "size"))).alias("spots"),
            F.array_sort(F.collect_set(F.when(is_unit, F.col("license")))).alias("line_licenses"),
        )
    )
    places = F.array_distinct(F.flatten(F.transform("spots", lambda s: F.sequence(s["at"], s["at"] + s["size"] - 1))))
    # Rows of equal id and text get equal results.
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return found.select("id", "digest", "license", F.size(places).cast("long").alias("n_lines"), "line_licenses")
