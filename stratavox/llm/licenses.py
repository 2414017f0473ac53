"""Licence scan by canonical digests; DataFrame functions only."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text

#: A table of known texts above this many rows is joined by shuffle instead of broadcast.
BROADCAST_ROWS = 50_000

#: Equivalent spellings, as (pattern, canonical form), on lower-cased text.
EQUIVALENT = (
    ("[‘’“”`\"']", ""),
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("organis", "organiz"),
    ("\\bfavour", "favor"),
    ("\\bversion (?=[0-9])", "v"),
    ("\\bv(?=[0-9]+(\\.0)?\\b)([0-9]+)\\.0\\b", "v$2"),
    ("https://", "http://"),
)

#: Texts of well-known licences and the notices that stand for them.
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is licensed under the GNU General Public License v3.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
        "to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND '
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        'in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT '
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
)


#: Titles that stand above some of the whole texts, or not.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License'),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License'),
    "Unlicense": ("The Unlicense", "Unlicense"),
    "Zlib": ("zlib License", "The zlib License"),
    "0BSD": ("Zero-Clause BSD", "BSD Zero Clause License"),
    "MIT-0": ("MIT No Attribution", "MIT-0 License"),
    "WTFPL": ("DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nVersion 2, December 2004",),
    "PostgreSQL": ("PostgreSQL License", "The PostgreSQL License"),
    "X11": ("X11 License",),
}
#: The end of the terms in texts that explain afterwards how to apply them; files have that part or not.
TERMS_END = "END OF TERMS AND CONDITIONS"


def whole_texts() -> tuple[tuple[str, str], ...]:
    """Whole licences (license_texts/ and those of KNOWN), with and without title and appendix."""
    bodies = [(path.stem, path.read_text()) for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
    bodies += [(name, text) for name, text in KNOWN if name in TITLES and len(text) > 500]
    out = list(bodies)
    out += [(name, f"{title}\n\n{text}") for name, text in bodies for title in TITLES.get(name, ())]
    for name, text in bodies:
        if TERMS_END in text:
            terms = text[: text.index(TERMS_END)]
            out += [(name, terms), (name, terms + TERMS_END)]
    return tuple(out)


def canonical(text: Column) -> Column:
    """Lower case, without copyright statements and punctuation, equivalent spellings made one; lines stay
    apart. A line that starts with 'copyright' or '(c)' is a statement if a sign or a year follows."""
    out = F.regexp_replace(F.lower(text), "(?m)^[^\\n\\p{L}]*(copyright\\b(?=[^\\n]*(\\(c\\)|©|\\b(19|20)[0-9]{2}\\b|yyyy|<year>))|\\(c\\)(?=[^\\n]*(copyright|\\b(19|20)[0-9]{2}\\b))|©|all rights reserved)[^\\n]*$", "")
    for pattern, form in EQUIVALENT:
        out = F.regexp_replace(out, pattern, form)
    out = F.regexp_replace(out, "[^\\p{L}\\p{N}\\n]+", " ")
    return F.regexp_replace(out, " *\\n[ \\n]*", "\n")


def one_line(canonical_text: Column) -> Column:
    return F.trim(F.translate(canonical_text, "\n", " "))


def known_licenses(spark: SparkSession, known: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """(digest, license) of known texts; without any given, of KNOWN and whole_texts()."""
    rows = spark.createDataFrame(list(KNOWN + whole_texts() if known is None else known), "license string, text string")
    return rows.select(F.sha2(one_line(canonical(F.col("text"))), 256).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, digest of the whole canonical text, text_license, line_licenses (sorted) and n_license_lines.

    The whole text, and each of its canonical lines as a text of its own, is looked up by digest in
    the known texts; a licence is named only where the entire text or line is equal to a known one.
    A known text that is given twice counts once, under the first of its names. Whole texts of any length
    are read; a null, empty or purely typographical text has the digest of the empty text and no licence; null
    doc_ids and repeated rows are scanned each; an empty table gives no rows.
    """
    known = known_licenses(docs.sparkSession) if known is None else known
    known = known.groupBy(known["digest"].alias("k")).agg(F.min(known["license"]).alias("l"))
    known = F.broadcast(known) if known.limit(broadcast_rows + 1).count() <= broadcast_rows else known
    at = id_text(docs).select("doc_id", F.monotonically_increasing_id().alias("row"), canonical(F.col("text")).alias("c"))
    whole = F.array(F.struct(F.sha2(one_line(F.col("c")), 256).alias("digest"), F.lit(True).alias("whole")))
    lines = F.transform(F.filter(F.split("c", "\n"), lambda x: F.trim(x) != ""), lambda x: F.struct(F.sha2(F.trim(x), 256).alias("digest"), F.lit(False).alias("whole")))
    keys = at.select("doc_id", "row", F.explode(F.concat(whole, lines)).alias("x")).select("doc_id", "row", "x.*")
    found = keys.join(known, keys["digest"] == known["k"], "left").filter(F.col("whole") | F.col("l").isNotNull())
    out = found.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"),
        F.max(F.when(F.col("whole"), F.col("l"))).alias("text_license"),
        F.sort_array(F.collect_set(F.when(~F.col("whole"), F.col("l")))).alias("line_licenses"),
        F.sum(F.when(F.col("whole"), 0).otherwise(1)).alias("n_license_lines"),
    )
    return out.select("doc_id", "digest", "text_license", F.array_join("line_licenses", ",").alias("line_licenses"), "n_license_lines")
