"""Licence scan: canonical digests of entire texts, joined to the digests of known licences.

A text is brought to one form (lower case, no copyright lines, no punctuation, one spelling of words that have several) and hashed. What is looked
up is the whole document and each of its lines, so that a licence kept as a document and a notice kept as a line are both found. A document is also
looked up as a licence file: without a title line and without the lines that name a copyright holder, so that published layouts are found.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.llm.shared import documents
from studyflow.session import staged

# Known licence texts and notices.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "WTFPL": """0. You just DO WHAT THE FUCK YOU WANT TO.""",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT-line": "Released under the MIT License.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "BSD-line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "SPDX-MIT": "SPDX-License-Identifier: MIT",
    "SPDX-Apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "SPDX-GPL-3.0-only": "SPDX-License-Identifier: GPL-3.0-only",
    "SPDX-BSD-3-Clause": "SPDX-License-Identifier: BSD-3-Clause",
}
# Spellings that count as the same, in the canonical form (words between single blanks).
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber",
    "cancelled": "canceled", "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center", "emphasised": "emphasized", "favour": "favor", "favourite": "favorite",
    "fulfil": "fulfill", "fulfilment": "fulfillment", "https": "http", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license", "licences": "licenses",
    "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "neighbouring": "neighboring", "offence": "offense", "optimise": "optimize", "organisation": "organization", "organise": "organize",
    "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}
COPYRIGHT_LINE = r"(?m)^[^\S\n]*[^a-z0-9\n]*(?:copyright|\(c\)|©)[^\n]*$"
# Of a licence file, in lower case: lines that name a holder or a year (not "copyright notice …", as wrapped texts begin lines with), and a title line with text below it.
HOLDER_LINE = (
    r"(?m)^[^a-z0-9\n]*(?:copyright(?!\s+(?:notice|holder|owner|licen[sc]e|law|statement|interest|disclaimer))(?:[^\n]*(?:\(c\)|©|[0-9]{4}|<year>|\[yyyy\])|[^\n]*\b(?:authors|contributors|foundation|university|inc|ltd|llc|gmbh)\b)[^\n]*"
    r"|\(c\)[^\S\n]*(?:copyright|[0-9]{4})[^\n]*|©[^\n]*)$"
)
TITLE = r"\A\s*[^\n]{0,60}?\blicen[sc]e\b[^\n]{0,30}(?<![.:;,\s])[^\S\n]*\n(?=\s*\S)"
# Words of which every licence file has one.
FILE_WORDS = "licen|permission|copyright"
PHRASES = (("and/or", "and or"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"), ("all rights reserved", " "))


def canonical(text: Column) -> Column:
    """One form of all texts that count as the same licence text; empty for null."""
    return normal(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, " "))


def file_form(text: Column) -> Column:
    """One form of all layouts of a licence file; empty for null."""
    return normal(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), HOLDER_LINE, " "), TITLE, ""))


def normal(out: Column) -> Column:
    """Words between single blanks, one spelling of each."""
    for a, b in PHRASES:
        out = F.replace(out, F.lit(a), F.lit(b))
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    for a, b in SPELLINGS.items():
        out = F.replace(out, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(out)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known: dict[str, str]) -> DataFrame:
    """(digest, licence), each digest once (the first name of equals)."""
    rows = spark.createDataFrame(sorted(known.items()), "licence string, text string")
    return rows.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("licence").alias("licence"))


def published() -> list[tuple[str, str]]:
    """(licence, text) of the licence files: the whole texts among KNOWN and the published ones of ``licence_texts`` (name, or name@variant)."""
    files = sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))
    return [(k, KNOWN[k]) for k in ("MIT", "ISC", "Apache-2.0-notice")] + [(f.stem.split("@")[0], f.read_text("utf-8")) for f in files]


def file_digests(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    """(digest, licence) of licence files, each digest once."""
    rows = spark.createDataFrame(files, "licence string, text string")
    return rows.groupBy(F.sha2(file_form(F.col("text")), 256).alias("digest")).agg(F.min("licence").alias("licence"))


def first_words(known: list[str]) -> list[str]:
    """Words of the raw text of which one must come first in a line whose canonical form is one of ``known``.

    The first word of a canonical text is the raw text's first one, in one of its spellings, unless a phrase was joined or left out there.
    """
    firsts = {k.split(" ")[0] for k in known}
    joined = {a.split("-")[0] for a, b in PHRASES if b in firsts}
    return sorted(firsts | {a for a, b in SPELLINGS.items() if b in firsts} | joined | {a.split(" ")[0] for a, b in PHRASES if not b.strip()})


def marks(files: list[str], least: int = 6) -> list[str]:
    """Words that all licence files hold, the longest first: a raw text without one of them is no such file."""
    changed = {*SPELLINGS.values(), *(w for _, b in PHRASES for w in b.split())}
    common = set.intersection(*(set(f.split(" ")) for f in files)) - changed if files else set()
    return sorted(common, key=lambda w: (-len(w), w))[:least]


def scan(docs: DataFrame, known: dict[str, str] = KNOWN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_sha256 of the canonical whole text, whole_licence (null if the text is none), n_lines that are licences and licences (sorted, comma-joined).

    A text that is empty in its canonical form is no licence. Rows that share an id share the findings of both. No rows give none.

    The texts are read once. The canonical form is made of every whole text, of the lines that begin as a known one does, and, as a licence file,
    of the texts that hold the words of all such files; their digests are written and meet the known ones in one join.
    """
    spark = docs.sparkSession
    texts = known_digests(spark, known).withColumn("form", F.lit("text"))
    files = file_digests(spark, published()).withColumn("form", F.lit("file"))
    canon = [r[0] for r in spark.createDataFrame([(v,) for v in known.values()], "text string").select(canonical(F.col("text"))).collect()]
    shapes = [r[0] for r in spark.createDataFrame([(v,) for _, v in published()], "text string").select(file_form(F.col("text"))).collect()]
    table = F.broadcast(texts.unionByName(files))
    low = F.lower("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    held = F.lit(True)
    for mark in marks(shapes):
        held = held & F.contains(low, F.lit(mark))
    lines = F.filter(F.split(low, "\n"), lambda line: F.regexp_extract(line, r"^[^\p{L}\p{N}]*([\p{L}\p{N}]+)", 1).isin(first_words(canon)))
    forms = rows.select("doc_id", digest(F.col("text")).alias("text_sha256"), lines.alias("lines"), F.when(held & low.rlike(FILE_WORDS), F.sha2(file_form(F.col("text")), 256)).alias("file"))
    forms = forms.withColumn("lines", F.transform("lines", digest))
    read = staged(forms, "licence-digests")
    asked = read.select("doc_id", F.inline(F.concat(
        F.array(F.struct(F.lit("text").alias("form"), F.col("text_sha256").alias("digest"), F.lit(0).alias("is_line")), F.struct(F.lit("file").alias("form"), F.col("file").alias("digest"), F.lit(0).alias("is_line"))),
        F.transform("lines", lambda d: F.struct(F.lit("text").alias("form"), d.alias("digest"), F.lit(1).alias("is_line"))),
    )))
    found = asked.join(table, ["form", "digest"]).groupBy(F.col("doc_id").alias("found_id")).agg(
        F.min(F.when(F.col("is_line") == 0, F.col("licence"))).alias("whole_licence"), F.sum("is_line").cast("long").alias("n_lines"), F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences")
    )
    whole = read.select("doc_id", "text_sha256")
    return whole.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")), "left").select("doc_id", "text_sha256", "whole_licence", F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"), F.coalesce("licences", F.lit("")).alias("licences"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _sql_canonical(text: str) -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    out = f"regexp_replace(lower(coalesce({text}, '')), {quoted(COPYRIGHT_LINE)}, ' ', 'g')"
    for a, b in PHRASES:
        out = f"replace({out}, {quoted(a)}, {quoted(b)})"
    out = rf"' ' || trim(regexp_replace({out}, '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' '"
    for a, b in SPELLINGS.items():
        out = f"replace({out}, ' {a} ', ' {b} ')"
    return f"trim({out})"


OP3_SQL = f"""
WITH named(licence, body) AS (VALUES {", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in KNOWN.items())}),
known AS (SELECT sha256({_sql_canonical("body")}) AS digest, min(licence) AS licence FROM named GROUP BY 1),
whole AS (SELECT doc_id, sha256({_sql_canonical("text")}) AS text_sha256 FROM documents),
lines AS (SELECT doc_id, sha256({_sql_canonical("line")}) AS digest FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)),
found AS (
    SELECT doc_id, min(CASE WHEN is_line = 0 THEN licence END) AS whole_licence, sum(is_line)::BIGINT AS n_lines, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences
    FROM (SELECT doc_id, licence, 1 AS is_line FROM lines JOIN known USING (digest) UNION ALL SELECT doc_id, licence, 0 FROM whole JOIN known ON text_sha256 = digest)
    GROUP BY doc_id)
SELECT doc_id, text_sha256, whole_licence, coalesce(n_lines, 0) AS n_lines, coalesce(licences, '') AS licences FROM whole LEFT JOIN found USING (doc_id)
"""
