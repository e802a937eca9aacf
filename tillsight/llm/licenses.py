"""Licence texts found by the digest of their canonical form.

A text is lower-cased (A-Z), its copyright notices go, everything but letters,
digits and characters beyond ASCII becomes one space, and equivalent spellings
become one. The SHA-256 of that form is looked up in a table of known licences by
a hash join: a document whose entire text is a licence gets its id. The same is
done for the lines of a document that can be licence notices, against one-line
notices. All of it is Spark's own functions.

A copyright notice is a line that begins with the word or sign and then gives a year,
a sign or "by", or with "all rights reserved". It ends with the line, or where the
licence begins on that line. Other lines that begin with "copyright" are text.

The known table is made from the constants below, a few dozen rows, which bounds
what is broadcast. More licences are more rows of ``known``. Long licences are known
by the digests of their published files, with and without what follows their terms.

The SQL of ``oracle`` states the same rule and knows the same licences. Its pattern cannot look
ahead, so it takes what ends a notice and puts it back, over lines that are doubled apart.

Defined results: a null or empty text, or one of copyright lines only, has the
digest of the empty form, which no licence has. Rows with equal ``doc_id`` are
looked up one by one. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_YEAR = r"[\[<{(]*(?:(?:19|20)\d\d|yyyy|year)"
#: Where the licence begins on the line of a notice.
_LICENCE = (r"(?:licen[cs]ed|released|distributed) under|this (?:work|software|program|file) is|"
            r"permission (?:is hereby|to use)|redistribution and use|spdx-license-identifier")
_HEAD = (r"(^|\n)[^0-9a-z\n\x80-\x{10ffff}]*"
         rf"(?:copyright[ \t:,-]*(?:\(c\)|©|by\b|{_YEAR})|\(c\)[ \t]*(?:copyright|{_YEAR})|©|all rights reserved)[^\n]*?")
_END = rf"\n|\b(?:{_LICENCE})\b|\z"
NOTICE, NOTICE_SQL = f"{_HEAD}(?={_END})", f"{_HEAD}({_END})"
NOT_WORDS = "[\\x00-/:-`{-\x7f]+"
#: Spellings that mean the same, after punctuation is gone.
SPELLINGS = [
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
    ("organisation", "organization"), ("authoris", "authoriz"), ("acknowledgement", "acknowledgment"),
    ("favour", "favor"), ("whilst", "while"), ("wilful", "willful"), ("per cent", "percent"),
    ("copyright owner", "copyright holder"), ("merchantibility", "merchantability"),
    ("https", "http"),
]
#: Every notice holds one of these, so other lines need no digest.
NOTICE_GUARD = "license|licence|spdx|public domain"

_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
    "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
    "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
    "OF THIS SOFTWARE.")
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the "
    "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
    "in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution. ")

# Public licence texts without title and copyright line.
TEXTS = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. " + _WARRANTY),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies. " + _ISC_WARRANTY),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted. " + _ISC_WARRANTY),
    "BSD-2-Clause": _BSD_TWO + _BSD_WARRANTY,
    "BSD-3-Clause": (
        _BSD_TWO + "3. Neither the name of the copyright holder nor the names of its contributors may "
        "be used to endorse or promote products derived from this software without specific prior "
        "written permission. " + _BSD_WARRANTY),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will "
        "the authors be held liable for any damages arising from the use of this software. Permission "
        "is granted to anyone to use this software for any purpose, including commercial applications, "
        "and to alter it and redistribute it freely, subject to the following restrictions: 1. The "
        "origin of this software must not be misrepresented; you must not claim that you wrote the "
        "original software. If you use this software in a product, an acknowledgment in the product "
        "documentation would be appreciated but is not required. 2. Altered source versions must be "
        "plainly marked as such, and must not be misrepresented as being the original software. 3. This "
        "notice may not be removed or altered from any source distribution."),
}
# Digests of long licences, as published and up to the end of their terms.
DIGESTS = {
    "Apache-2.0": [
        "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b",
        "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe",
        "6aa661403864282a4d084f1551e8149a5f1a7b5e8b05b6db8e1a8a28d0badc64",
    ],
    "Artistic-1.0-Perl": [
        "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2",
    ],
    "CC0-1.0": [
        "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
    ],
    "GFDL-1.2": [
        "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b",
    ],
    "GFDL-1.3": [
        "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d",
    ],
    "GPL-1.0": [
        "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224",
        "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc",
        "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70",
    ],
    "GPL-2.0": [
        "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821",
        "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34",
        "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808",
    ],
    "GPL-3.0": [
        "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a",
        "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636",
        "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191",
    ],
    "LGPL-2.0": [
        "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908",
        "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260",
        "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2",
    ],
    "LGPL-2.1": [
        "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891",
        "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4",
        "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df",
    ],
    "LGPL-3.0": [
        "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    ],
    "MPL-1.1": [
        "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6",
    ],
    "MPL-2.0": [
        "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d",
    ],
}
# Names that notices give to licences.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0"],
    "MIT": ["MIT License"],
    "GPL-2.0": ["GNU General Public License, version 2"],
    "GPL-3.0": ["GNU General Public License, version 3"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "CC0-1.0": ["CC0 1.0"],
    "CC-BY-4.0": ["CC BY 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
}
PHRASES = ["Licensed under the {}.", "Licensed under {}.", "Released under the {}.",
           "This work is licensed under the {}.", "This work is licensed under {}.",
           "This software is released under the {}.", "Distributed under the {}."]


def known_texts() -> list[tuple[str, str, str]]:
    """(license, kind, text): entire licences, with and without title, and notices."""
    entire = [(name, "text", text) for name, text in TEXTS.items()]
    entire += [(name, "text", f"{title}\n{text}") for name, text in TEXTS.items()
               for title in NAMES.get(name, [f"{name} License"])]
    notices = [(name, "notice", phrase.format(title)) for name, titles in NAMES.items()
               for title in titles for phrase in PHRASES]
    notices += [(name, "notice", f"SPDX-License-Identifier: {name}") for name in {**TEXTS, **NAMES}]
    return entire + notices


def canonical(text: Column) -> Column:
    """The form of a text that spelling and layout do not change."""
    kept = F.regexp_replace(F.translate(text, UPPER, LOWER), NOTICE, "$1")
    words = F.regexp_replace(kept, NOT_WORDS, " ")
    for spelling, one in SPELLINGS:
        words = F.replace(words, F.lit(spelling), F.lit(one))
    return F.trim(words)


def digest(text: Column) -> Column:
    return F.sha2(canonical(F.coalesce(text, F.lit(""))), 256)


def known(spark: SparkSession, texts: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(license, kind, digest), one row a canonical form."""
    rows = spark.createDataFrame(texts or known_texts(), "license string, kind string, text string").select(
        "license", "kind", digest(F.col("text")).alias("digest"))
    if not texts:
        long = [(name, "text", own) for name, digests in DIGESTS.items() for own in digests]
        rows = rows.unionByName(spark.createDataFrame(long, "license string, kind string, digest string"))
    return rows.groupBy("kind", "digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, licences: DataFrame | None = None) -> DataFrame:
    """(doc_id, digest, license, notices) of every document.

    ``license`` belongs to the entire text; ``notices`` are the licences that
    single lines name, sorted.
    """
    table = known(docs.sparkSession) if licences is None else licences
    texts = table.where("kind = 'text'").select("digest", "license")
    lines = F.filter(F.split(F.col("text"), "\n"),
                     lambda line: F.translate(line, UPPER, LOWER).rlike(NOTICE_GUARD))
    found = docs.select(F.col("doc_id").cast("long"), digest(F.col("text")).alias("digest"),
                        F.transform(lines, digest).alias("_lines"))
    # The notices of all licences are one bounded row, looked up by key in each document.
    notices = {r.digest: r.license for r in table.where("kind = 'notice'").collect()}
    names = F.lit(None).cast("map<string,string>") if not notices else F.create_map(
        *(F.lit(x) for pair in notices.items() for x in pair))
    named = F.filter(F.transform("_lines", lambda d: F.try_element_at(names, d)),
                     lambda n: n.isNotNull())
    return found.join(F.broadcast(texts), "digest", "left").select(
        "doc_id", "digest", "license",
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(named)), ","), F.lit("")).alias("notices"))


def oracle(texts: list[tuple[str, str, str]] | None = None) -> str:
    """The same in DuckDB's SQL."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def form(text: str) -> str:
        lines = f"replace(translate({text}, '{UPPER}', '{LOWER}'), chr(10), chr(10) || chr(10))"
        out = f"regexp_replace({lines}, {quoted(NOTICE_SQL)}, '\\1\\2', 'g')"
        out = f"regexp_replace({out}, {quoted(NOT_WORDS)}, ' ', 'g')"
        for spelling, one in SPELLINGS:
            out = f"replace({out}, {quoted(spelling)}, {quoted(one)})"
        return f"sha256(trim({out}))"

    rows = ", ".join(f"({quoted(n)}, {quoted(k)}, {quoted(t)})" for n, k, t in texts or known_texts())
    long = "" if texts else " UNION ALL SELECT 'text', digest, license FROM (VALUES " + ", ".join(
        f"({quoted(own)}, {quoted(name)})" for name, digests in DIGESTS.items() for own in digests) + ") l(digest, license)"
    return f"""
WITH given(license, kind, text) AS (VALUES {rows}),
known AS (SELECT kind, digest, min(license) AS license FROM
  (SELECT kind, {form('text')} AS digest, license FROM given{long}) GROUP BY 1, 2),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
notices AS (
  SELECT r, string_agg(DISTINCT k.license, ',' ORDER BY k.license) AS notices
  FROM (SELECT r, {form('line')} AS digest FROM lines
        WHERE regexp_matches(translate(line, '{UPPER}', '{LOWER}'), '{NOTICE_GUARD}')) l
  JOIN known k ON k.kind = 'notice' AND k.digest = l.digest GROUP BY r)
SELECT d.doc_id, d.digest, k.license, coalesce(n.notices, '') AS notices
FROM (SELECT r, doc_id, {form('text')} AS digest FROM docs) d
LEFT JOIN known k ON k.kind = 'text' AND k.digest = d.digest
LEFT JOIN notices n ON n.r = d.r"""
