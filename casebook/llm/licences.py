"""Licence scan by canonical digests (native).

A text is brought to a canonical form: lower case, marks and white space to single
spaces, copyright lines left out, equivalent spellings made one.  The digest of
the whole canonical text, and of each of its lines, is hash-joined to the digests
of known licence texts and notices, which are canonicalised by the same rules.
Known as whole texts: MIT, ISC, 0BSD, BSD-2-Clause, BSD-3-Clause, and those in
``licence_texts``; ``licences`` takes any other list of (SPDX id, text).

Defined results: null and empty texts, and texts without letters or digits, match
nothing; repeated rows and a document's repeated lines add to its counts; a null
id is a document of its own; a licence found both as whole text and as a line is
one row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Licence texts and notices, as published.
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:")
MIT_NOTICE = ("The above copyright notice and this permission notice shall be included in all copies or substantial "
              "portions of the Software.")
MIT_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE.")
ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.")
ZERO_BSD_GRANT = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                  "fee is hereby granted.")
ISC_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE.")
BSD_GRANT = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met:")
BSD_CONDITIONS = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.")
BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
TERMS_END = "END OF TERMS AND CONDITIONS"


def _bsd() -> list[tuple[str, str]]:
    """BSD texts of two and three clauses, with and without title, clauses numbered or not."""
    out = []
    for n in (2, 3):
        for numbered in (True, False):
            clauses = [f"{i}. {c}" if numbered else c for i, c in enumerate(BSD_CONDITIONS[:n], 1)]
            body = "\n".join((BSD_GRANT, *clauses, BSD_DISCLAIMER))
            titles = ("", f"BSD {n}-Clause License\n", "BSD License\n")
            out += [(f"BSD-{n}-Clause", title + body) for title in titles]
    return out


def _published() -> list[tuple[str, str]]:
    """The texts in ``licence_texts`` (file name: SPDX id), whole, and without what follows their terms."""
    out = []
    for file in sorted(files(__package__).joinpath("licence_texts").iterdir(), key=lambda f: f.name):
        if not file.name.endswith(".txt"):
            continue
        name, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
        out.append((name, text))
        terms, end, _ = text.partition(TERMS_END)
        if end:
            out += [(name, terms + end), (name, terms)]
    return out


LICENCES = (
    ("MIT", "\n".join(("MIT License", MIT_GRANT, MIT_NOTICE, MIT_DISCLAIMER))),
    ("MIT", "\n".join((MIT_GRANT, MIT_NOTICE, MIT_DISCLAIMER))),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "\n".join(("ISC License", ISC_GRANT, ISC_DISCLAIMER))),
    ("ISC", "\n".join((ISC_GRANT, ISC_DISCLAIMER))),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("0BSD", "\n".join((ZERO_BSD_GRANT, ISC_DISCLAIMER))),
    ("0BSD", "SPDX-License-Identifier: 0BSD"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    *_bsd(),
    *_published(),
)
#: Spellings taken as equal (after lower case and without marks).
EQUIVALENT = (
    ("licence", "license"), ("licencing", "licensing"), ("sub license", "sublicense"), ("non infringement",
    "noninfringement"), ("organisation", "organization"), ("authorise", "authorize"), ("recognise", "recognize"),
    ("acknowledgement", "acknowledgment"), ("judgement", "judgment"), ("favour", "favor"), ("whilst", "while"),
    ("wilful", "willful"), ("per cent", "percent"), ("non commercial", "noncommercial"), ("http ", "https "),
    ("version 2 0", "version 2"), ("version 3 0", "version 3"),
)
#: A line that says who holds the rights, after marks are gone.
COPYRIGHT = r"^(copyright|c [0-9]{4}|all rights reserved)( .*)?$"


def canonical_lines(text: Column) -> Column:
    """array<string>: the canonical lines of a text that say something."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "©", " copyright ")
    plain = F.regexp_replace(plain, r"[^\p{L}\p{N}\n]+", " ")
    for written, taken in EQUIVALENT:
        plain = F.replace(plain, F.lit(written), F.lit(taken))
    lines = F.transform(F.split(plain, "\n", -1), lambda line: F.btrim(line))
    return F.filter(lines, lambda line: (line != "") & ~line.rlike(COPYRIGHT))


def digests(lines: Column) -> Column:
    """array<struct<digest, whole>>: of the whole canonical text, and of its lines."""
    whole = F.array(F.struct(F.sha2(F.array_join(lines, " "), 256).alias("digest"), F.lit(True).alias("whole")))
    each = F.transform(lines, lambda x: F.struct(F.sha2(x, 256).alias("digest"), F.lit(False).alias("whole")))
    return F.when(F.size(lines) > 0, F.concat(whole, each)).otherwise(F.array().cast(
        "array<struct<digest:string,whole:boolean>>"))


def known_digests(spark: SparkSession, licences: tuple[tuple[str, str], ...] = LICENCES) -> DataFrame:
    """(digest, licence) of the known texts; one row per text, so as long as the declared list."""
    known = spark.createDataFrame(list(licences), "licence string, body string")
    lines = known.select("licence", canonical_lines(F.col("body")).alias("lines"))
    return lines.select(F.sha2(F.array_join("lines", " "), 256).alias("digest"), "licence").distinct()


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         licences: tuple[tuple[str, str], ...] = LICENCES) -> DataFrame:
    """(doc_id, licence, whole_text, n_lines): one row per document and licence found."""
    known = F.broadcast(known_digests(docs.sparkSession, licences))  # as many rows as declared
    lines = docs.select(F.col(doc_id).alias("doc_id"), canonical_lines(F.col(text)).alias("lines"))
    units = lines.select("doc_id", F.inline(digests(F.col("lines"))))
    return units.join(known, "digest").groupBy("doc_id", "licence").agg(
        F.max("whole").alias("whole_text"), F.sum((~F.col("whole")).cast("long")).alias("n_lines"))
