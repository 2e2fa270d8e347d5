"""Licence scans by digests of canonical texts.

A text is made canonical by DataFrame functions alone: lower case, lines that state a
copyright dropped, ASCII punctuation and white space as single spaces, equivalent
spellings unified. The SHA-256 of the whole canonical text is joined to the digests of
known licence texts, which are made canonical by the same functions; so is each canonical
line of it, to find one-line notices and licence tags. Every document gives a row for its
whole text and one for each line that can be as long as a known text; rows that join to
nothing go, and what is left of a document is grouped by its number, most of it before
the shuffle. Known texts are a table: whole licences from ``known_licenses`` and below,
notices and tags. It is broadcast while its counted size allows.

Defined cases. A null text counts as empty; an empty canonical text matches nothing.
Only letters A-Z change case; other scripts stay as they are. Texts of any length are
hashed whole. Repeated rows and rows without an id are answered one by one. A document
that holds several notices gets all of them, sorted. An empty table gives no rows.
Known texts that are null or canonically empty are ignored. Extra columns may have any
name.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.rows import col, text_of
from tidemark.workspace import may_broadcast, write_table

# Published equivalent spellings, as words of canonical texts; the first
# becomes the second. Phrases come first.
SPELLINGS = {
    "copyright owner": "copyright holder",
    "copyright owners": "copyright holders",
    "non commercial": "noncommercial",
    "per cent": "percent",
    "sub licence": "sublicense",
    "sub licences": "sublicenses",
    "sub license": "sublicense",
    "sub licenses": "sublicenses",
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "https": "http",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "licences": "licenses",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "sublicence": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}

# One-line notices of licences.
NOTICES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Licensed under the Apache License, Version 2.0 (the \"License\");": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
    "Licensed under the GNU General Public License, version 2.": "GPL-2.0-only",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
}

_MIT_GRANT = """\
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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""

_ISC_WARRANTY = """\
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""

# Whole licence texts, without and with their titles.
TEXTS = {
    "MIT": ["MIT License\n", _MIT_GRANT],
    "ISC": [
        "ISC License\n",
        "Permission to use, copy, modify, and/or distribute this software for any\n"
        "purpose with or without fee is hereby granted, provided that the above\n"
        "copyright notice and this permission notice appear in all copies.\n"
        + _ISC_WARRANTY,
    ],
    "0BSD": [
        "BSD Zero Clause License\n",
        "Permission to use, copy, modify, and/or distribute this software for any\n"
        "purpose with or without fee is hereby granted.\n" + _ISC_WARRANTY,
    ],
}

#: Whole texts that come as files, named by their licence.
FILES = Path(__file__).with_name("known_licenses")

#: A line that states a copyright: the word or sign, then a year or a sign.
CLAIM = r"^[^a-z0-9\n]*(copyright|\(c\)|©)[^\n]*([0-9]{4}|\(c\)|©)[^\n]*$"
#: ASCII that is no letter, digit or line end.
NO_WORDS = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical_lines(text: Column) -> Column:
    """The lines of a text in canonical form, without empty ones."""
    lowered = F.translate(text_of(text), UPPER, LOWER)
    claims = lowered.contains("copyright") | lowered.contains("(c)") | lowered.contains("©")
    unclaimed = F.when(claims, F.regexp_replace(lowered, f"(?dm){CLAIM}", "")).otherwise(lowered)
    plain = F.regexp_replace(unclaimed, NO_WORDS, " ")
    # Each word gets spaces of its own: neighbours can be replaced one after the other.
    words = F.concat(
        F.lit(" "), F.replace(F.replace(plain, F.lit(" "), F.lit("  ")), F.lit("\n"), F.lit(" \n ")), F.lit(" ")
    )
    for name, other in SPELLINGS.items():
        words = F.replace(words, F.lit(f" {name.replace(' ', '  ')} "), F.lit(f" {other.replace(' ', '  ')} "))
    lines = F.transform(F.split(F.replace(words, F.lit("  "), F.lit(" ")), "\n"), lambda x: F.trim(x))
    return F.filter(lines, lambda x: x != "")


def _table(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    entries = [F.struct(F.lit(n).alias("license"), F.lit(t).alias("text")) for n, t in rows]
    return spark.range(1).select(F.inline(F.array(*entries)))


def known_rows() -> list[tuple[str, str]]:
    """``(license, text)``: whole texts, without and with titles; notices; tags."""
    rows = [(path.stem, path.read_text("utf-8")) for path in sorted(FILES.glob("*.txt"))]
    rows += [(name, body) for name, (_, body) in TEXTS.items()]
    rows += [(name, title + body) for name, (title, body) in TEXTS.items()]
    rows += [(name, notice) for notice, name in NOTICES.items()]
    names = sorted({name for name, _ in rows})
    return rows + [(n, f"SPDX-License-Identifier: {n}") for n in names]


def known_texts(spark: SparkSession) -> DataFrame:
    return _table(spark, known_rows())


def _digests(known: DataFrame) -> DataFrame:
    """``digest, license, chars`` of the known texts, written."""
    table = (
        known.select("license", F.array_join(canonical_lines(F.col("text")), " ").alias("text"))
        .where("text <> ''")
        .groupBy(F.sha2("text", 256).alias("digest"))
        .agg(F.min("license").alias("license"), F.max(F.char_length("text")).alias("chars"))
    )
    return write_table(table, "licenses")[0]


def scanned(
    df: DataFrame, id_column: str, text_column: str, known: DataFrame | None = None
) -> DataFrame:
    """One row per document: ``doc_id, canonical_sha256, license, notices``.

    ``license`` is that of the whole text, the first by name if several share it;
    ``notices`` are the sorted licences of the document's lines. ``known`` has
    ``license, text``.
    """
    digests = _digests(known_texts(df.sparkSession) if known is None else known)
    n, least, most = digests.agg(
        F.count("*"), F.coalesce(F.min("chars"), F.lit(1)), F.coalesce(F.max("chars"), F.lit(0))
    ).first()
    known_rows = digests.select(F.col("digest").alias("known_digest"), "license")
    if may_broadcast(n, 200):
        known_rows = F.broadcast(known_rows)
    fitting = F.filter("lines", lambda x: F.char_length(x).between(least, most))
    rows = df.select(
        F.monotonically_increasing_id().alias("uid"),
        col(id_column).alias("doc_id"),
        canonical_lines(col(text_column)).alias("lines"),
    ).select("uid", "doc_id", F.array_join("lines", " ").alias("whole"), fitting.alias("lines"))
    looked_up = rows.select(
        "uid",
        "doc_id",
        F.inline(
            F.concat(
                F.array(F.struct(F.sha2("whole", 256).alias("digest"), F.lit(True).alias("is_whole"))),
                F.transform(
                    F.array_distinct("lines"),
                    lambda x: F.struct(F.sha2(x, 256).alias("digest"), F.lit(False).alias("is_whole")),
                ),
            )
        ),
    ).join(known_rows, F.col("digest") == F.col("known_digest"), "left")
    told = looked_up.where(F.col("is_whole") | F.col("license").isNotNull())
    return (
        told.groupBy("uid")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.max(F.when(F.col("is_whole"), F.col("digest"))).alias("canonical_sha256"),
            F.max(F.when(F.col("is_whole"), F.col("license"))).alias("license"),
            F.sort_array(
                F.collect_set(F.when(~F.col("is_whole"), F.col("license")))
            ).alias("notices"),
        )
        .drop("uid")
    )
