"""Licence scans by canonical digest lookup.

A text's lines are canonicalised (lower case, equivalent spellings, punctuation and white space
to single spaces; copyright lines left out); the digest of the whole canonical text, and the
digest of each of its lines, are hash-joined to the digests of known licence texts and
notices. The known list is fixed and small, so its side of the join is broadcast. It holds
whole licences with and without their usual title and 'All rights reserved' lines.

Not found: a licence wrapped over several lines inside a longer text, other titles and
wordings, and notices that share a line with other words. The SQL oracle knows only copyright
lines that start with the word; where a text has others, the scan can find more than it.

Null and empty texts have no licence; texts of any length are scanned whole; repeated rows give
equal rows; an empty table gives no rows; other columns are not read, so their names can't clash. Several licences of one text are listed in the order of their names.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Public licence texts and notices, by SPDX identifier.
_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission."""
_BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
KNOWN = (
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                   "License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAMES + _BSD_WARRANTY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n"
             + _ISC_WARRANTY),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
            "so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software.\n" + _WARRANTY),
    ("MIT-0", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
              "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
              "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
              "furnished to do so.\n" + _WARRANTY),
)
# Title lines that standard files put before the body.
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License",
                     "FreeBSD License", "BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License",
                     "Modified BSD License", "Revised BSD License", "BSD License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"),
    "MIT-0": ("MIT No Attribution", "MIT No Attribution License", "MIT-0"),
}
# Digests of whole public licence files, with either kind of copyright line left out (see ``scan``).
TEXT_DIGESTS = (
    ("Apache-2.0", "b41b69f0dea0598ca720f95f7c676dc79782779377951993e5bdd566fec422f3"),
    ("Apache-2.0", "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("Artistic-1.0-Perl", "f273930184a9b8de03336e9ae5d74bef291165524044f55455ee5117f494811a"),
    ("CC0-1.0", "0c3e4ca5ed7ced6289d3f5d9a83e4100f9f34d87983b17dc5865376a8a0a98f3"),
    ("GFDL-1.2-only", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.2-only", "f06741c6c5feec30d99f80228f0d9ea6b884eae0e790ab18a0f4257184befa86"),
    ("GFDL-1.3-only", "80229e90e6f40a551a447f33ef48bd361a8e3166d53f29a2d1537245e2064feb"),
    ("GFDL-1.3-only", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GPL-1.0-only", "9caf042595280548f0149ac88169a7f2e04f35b2a642cf00b991f00d48bfa4ce"),
    ("GPL-1.0-only", "ec8a6b7d70e9f225b63d3962ed5b4721373f5535d7b967a06722b0d621f6892a"),
    ("GPL-2.0-only", "331b500eb3c5ee796906547305df82fff4a35b3aa03c1d3ea84d32078292b2e6"),
    ("GPL-2.0-only", "c230c00f329737cb7ce3d97a266318b4c9d4c1fd321335e592b2ce1112179b88"),
    ("GPL-3.0-only", "5272fb2d9117cba4ebb1b4a6612e61ab05ddddeff56bd30c3ac3798e23821b30"),
    ("GPL-3.0-only", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("LGPL-2.0-only", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0-only", "96685b4d8003c3671feddcde58622afa814a3ac15dcc419f38b388aff5e16d1d"),
    ("LGPL-2.1-only", "22bd2802b7b313faf9750f494c8f07c9eaa0e00ba5b9f7a300e8fa36cfd1319e"),
    ("LGPL-2.1-only", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),
    ("MPL-2.0", "9672a697b80e59f5b1b0201e64d65dee8762b193cdd934dc5bcf2b57350a2ead"),
)
# Equivalent spellings, as whole canonical words.
SPELLINGS = (("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("favour", "favor"),
             ("modelled", "modeled"), ("organisation", "organization"), ("recognise", "recognize"), ("acknowledgement", "acknowledgment"),
             ("noncommercial", "non commercial"), ("v", "version"))
_OTHER = r"[^\p{L}\p{N}]+"
# A copyright notice: a sign or the word, with a year or a place for one.
_YEAR = r"[<\[{]?\s*(?:\d{4}|y{4}|year)"
_NOTICE = rf"(?i)^[^\p{{L}}\p{{N}}©(]*(?:©|\(c\)\s*(?:copyright\s*)?{_YEAR}|copyright\s*(?:\(c\)|©|{_YEAR}))"


def canonical_line(line: str) -> str:
    """The canonical form of one line of a known (ASCII) text; see ``canonical``."""
    s = f" {re.sub(r'[^a-z0-9]+', ' ', line.lower()).strip()} "
    for old, new in SPELLINGS:
        s = s.replace(f" {old} ", f" {new} ")
    return s.strip()


def canonical(line: Column) -> Column:
    """The canonical form of one line: words in lower case, one space apart, spellings made equal."""
    s = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(line), _OTHER, " ")), F.lit(" "))
    for old, new in SPELLINGS:
        s = F.replace(s, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(s)


def _variants(name: str, text: str):
    """The canonical forms of a known text: as one text without and with the lines that start with
    'copyright'; of whole licences also with plain bullets, a title and 'All rights reserved'."""
    bodies = [text] if "\n" not in text else [text, re.sub(r"(?m)^\d\. ", "", text)]
    heads = [""] if "\n" not in text else [f"{t} {r}" for t in ("", *TITLES[name]) for r in ("", "All rights reserved.")]
    for body in bodies:
        lines = [x for x in map(canonical_line, body.split("\n")) if x]
        for kept in (lines, [x for x in lines if not x.startswith("copyright ")]):
            for head in heads:
                yield " ".join(x for x in (canonical_line(head), *kept) if x)


def known_digests() -> list[tuple[str, str]]:
    """(digest, identifier) of the known texts, each read as one text, sorted and distinct."""
    out = {(d, name) for name, d in TEXT_DIGESTS}
    for name, text in KNOWN:
        out |= {(hashlib.sha256(x.encode()).hexdigest(), name) for x in _variants(name, text)}
    return sorted(out)


def _known(spark: SparkSession, names: list[str]) -> DataFrame:
    rows = [(d, 1 << names.index(n)) for d, n in known_digests()]
    return spark.createDataFrame(rows, "digest string, bit long")


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_license (of the whole text, or null),
    line_licenses (of its lines, comma-joined, or null), n_lines."""
    names = sorted({n for _, n in known_digests()})
    known = _known(docs.sparkSession, names)
    raw = F.split(F.coalesce("text", F.lit("")), "\n")
    lines = F.filter(F.transform(raw, canonical), lambda x: x != "")
    unsigned = F.filter(F.transform(F.filter(raw, lambda x: ~x.rlike(_NOTICE)), canonical), lambda x: x != "")
    rows = docs.select("doc_id", lines.alias("lines"), F.concat_ws(" ", unsigned).alias("unsigned")).withColumn(
        "row", F.monotonically_increasing_id())
    whole = F.concat_ws(" ", F.filter("lines", lambda x: ~x.startswith("copyright ")))
    # entries 0 and 1 are the whole text without lines that start with 'copyright' and without copyright
    # notices (wrapped bodies have lines of the first kind that are none of the second), the rest are its lines
    parts = rows.select("row", "doc_id", F.posexplode(F.concat(F.array(whole, "unsigned"), "lines")).alias("place", "part"))
    hits = (parts.withColumn("digest", F.sha2("part", 256)).join(F.broadcast(known), "digest", "left")
            .groupBy("row").agg(F.first("doc_id").alias("doc_id"), (F.count("*") - 2).alias("n_lines"),
                                F.coalesce(F.bit_or(F.when(F.col("place") < 2, F.col("bit"))), F.lit(0)).alias("text_bits"),
                                F.coalesce(F.bit_or(F.when(F.col("place") > 1, F.col("bit"))), F.lit(0)).alias("line_bits")))

    def listed(bits: str) -> Column:
        found = F.array_compact(F.array(*(F.when(F.col(bits).bitwiseAND(1 << i) != 0, n) for i, n in enumerate(names))))
        return F.when(F.size(found) > 0, F.array_join(found, ","))

    return hits.select("doc_id", listed("text_bits").alias("text_license"), listed("line_bits").alias("line_licenses"), "n_lines")


def scan_sql() -> str:
    """The scan of ``documents`` as DuckDB SQL."""
    line = "lower(x)"
    line = rf"' ' || trim(regexp_replace({line}, '{_OTHER}', ' ', 'g')) || ' '"
    for old, new in SPELLINGS:
        line = f"replace({line}, ' {old} ', ' {new} ')"
    values = ", ".join(f"('{d}', '{n}')" for d, n in known_digests())
    return f"""
WITH known(digest, name) AS (VALUES {values}),
l AS (SELECT row_number() OVER () AS r, doc_id,
             list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim({line})), lambda x: x <> '') AS lines
      FROM documents),
w AS (SELECT r, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM l JOIN known
      ON digest = sha256(array_to_string(list_filter(lines, lambda x: NOT starts_with(x, 'copyright ')), ' ')) GROUP BY r),
p AS (SELECT r, unnest(lines) AS part FROM l),
m AS (SELECT r, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM p JOIN known ON digest = sha256(part) GROUP BY r)
SELECT doc_id, w.names AS text_license, m.names AS line_licenses, CAST(len(lines) AS BIGINT) AS n_lines
FROM l LEFT JOIN w USING (r) LEFT JOIN m USING (r)"""
