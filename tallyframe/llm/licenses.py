"""Operator 7: licence scans by canonical digests.

A text is made canonical (lower case, copyright lines and "all rights
reserved" lines dropped, equivalent
spellings made one, punctuation and white space reduced to single blanks) and
its SHA-256 is looked up among the digests of known licence texts by an
equi-join.  Units are whole documents and, since notices stand alone in their
lines, each line of them; a unit matches as a whole or not at all.

Known texts are templates, not rows of the corpus: whole texts (some in files
of ``license_texts``), and one-line notices made of every lead-in with every
name.  Their digests number a few thousand, whatever the input.

Edge cases: null and empty texts have the digest of the empty text, which is
no licence; a line that repeats counts each time; repeated rows get equal
results; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import pick, prepare, shared

#: Spellings that count as one (public guidelines for matching licence texts).
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sub-license": "sublicense",
    "sublicence": "sublicense", "non-commercial": "noncommercial", "acknowledgement": "acknowledgment",
    "authorise": "authorize", "authorised": "authorized", "organisation": "organization", "favour": "favor",
    "judgement": "judgment", "labour": "labor", "percent": "per cent",
    "whilst": "while", "wilful": "willful", "ver": "version", "v": "version", "gnu gpl": "gnu general public license",
}

#: Public licence texts and notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
{0} Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
{1} Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""

BSD_3 = BSD_2 + """{2} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""

BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {0} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

#: Names of licences in notices, ``the`` apart.
NAMES = {
    "MIT": ["MIT License", "MIT"], "ISC": ["ISC License", "ISC"],
    "BSD-2-Clause": ["BSD 2-Clause License", "BSD-2-Clause", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD-3-Clause", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0"],
    **{f"{s}GPL-{n}": [f"GNU {k} General Public License, version {m}", f"GNU {k} General Public License {m}", f"GNU {s}GPL, version {m}",
                      f"GNU {s}GPL {m}", f"{s}GPL {m}", f"{s}GPLv{m}", f"GNU {s}GPLv{m}", f"{k} General Public License, version {m}"]
       for s, k, n, m in (("", "", "2.0", "2"), ("", "", "3.0", "3"), ("L", "Lesser", "2.1", "2.1"), ("L", "Lesser", "3.0", "3"), ("A", "Affero", "3.0", "3"))},
    "MPL-1.1": ["Mozilla Public License, version 1.1", "Mozilla Public License 1.1", "MPL 1.1"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero 1.0"],
    **{f"CC-{k}-{v}": [f"CC {k} {v}", f"CC {k} {v} License", f"Creative Commons {w} {v} International License", f"Creative Commons {w} {v}",
                      f"Creative Commons {k} {v}"]
       for v in ("4.0",) for k, w in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                                      ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                                      ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))},
}

#: What comes before the name.
LEADS = [f"{a}{b} under" for a in ("", "This work is ", "This project is ", "This software is ", "This program is ", "This file is ", "This code is ",
                                   "This document is ")
         for b in ("licensed", "released", "distributed", "published", "available", "made available")]


def whole_texts() -> list[tuple[str, str]]:
    """The texts beside this module, with and without what follows their terms."""
    out = []
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        out += [(path.stem, t) for t in dict.fromkeys((text, terms, terms + end))]
    return out


def bsd_texts() -> list[tuple[str, str]]:
    """Both BSD licences with numbered and plain conditions, with and without their names."""
    return [(name, title + body.format(*marks) + BSD_END.format(holder))
            for name, body in (("BSD-2-Clause", BSD_2), ("BSD-3-Clause", BSD_3))
            for title in ("", *(f"{n}\n" for n in NAMES[name]), *(f"The {n}\n" for n in NAMES[name]))
            for marks in (("1.", "2.", "3."), ("*", "*", "*")) for holder in ("HOLDER", "HOLDERS", "OWNER")]


KNOWN = [
    ("MIT", MIT), ("ISC", ISC),
    *((name, f"{the}{title}\n{text}") for name, text in (("MIT", MIT), ("ISC", ISC)) for the in ("", "The ")
      for title in (name, f"{name} License", f"{name} License ({name})")),
    *(("MIT", f"{title}\n{MIT}") for title in ("Expat License", "The Expat License", "MIT License (Expat)", "The MIT License (Expat)")),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", APACHE_NOTICE), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    *whole_texts(), *bsd_texts(),
    *((name, f"SPDX-License-Identifier: {name}") for name in NAMES),
    *((name + later, f"SPDX-License-Identifier: {name}{form}") for name in NAMES if "GPL" in name
      for form, later in (("-only", ""), ("-or-later", "-or-later"))),
    *((name, f"{lead} {the}{n}.") for name, names in NAMES.items() for n in names for lead in LEADS for the in ("", "the ")),
]

_COPYRIGHT = r"(?m)^[ \t]*(?:(?:copyright\b|\(c\)|©)[^\n]*|all rights reserved[.!]?[ \t]*)$"
_OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The canonical form.

    Digits and letters stay; every run of anything else becomes one blank, so
    wrapped lines, quotes and bullets don't matter.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    words = F.concat(F.lit(" "), F.regexp_replace(F.regexp_replace(low, _COPYRIGHT, " "), _OTHER, " "), F.lit(" "))
    for other, one in SPELLINGS.items():
        words = F.replace(words, F.lit(f" {other.replace('-', ' ')} "), F.lit(f" {one} "))
    return F.trim(words)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_digests(spark, known=None) -> DataFrame:
    """(digest, license): one row for each distinct canonical template."""
    table = spark.createDataFrame(list(known or KNOWN), "license string, template string")
    return table.groupBy(digest(F.col("template")).alias("digest")).agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame, known=None) -> DataFrame:
    """Per document: the licence of the whole text, the licences of its lines.

    ``whole_license``: null where the whole text is no known licence;
    ``notice_licenses``: the licences named by lines, sorted, comma-joined;
    ``n_notices``: lines that are licence notices; ``canonical_sha256``.
    """
    prepare(docs.sparkSession)
    # a few thousand digests (the list above or the caller's): bounded, so they may be broadcast
    digests = F.broadcast(shared(known_digests(docs.sparkSession, known)))
    source = pick(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("row"), "text")
    whole = (source.select("doc_id", "row", digest(F.col("text")).alias("digest")).join(digests, "digest", "left")
             .select("doc_id", "row", F.col("license").alias("whole_license"), F.col("digest").alias("canonical_sha256")))
    lines = source.where(F.col("text").isNotNull()).select(
        "doc_id", "row", F.explode(F.split(F.col("text"), "\n", -1)).alias("line"))
    each = lines.select("doc_id", "row", digest(F.col("line")).alias("digest")).join(digests, "digest")
    copies = source.groupBy("doc_id", "row").agg(F.count("*").alias("copies"))
    named = (each.groupBy("doc_id", "row", "license").agg(F.count("*").alias("n"))
             .groupBy("doc_id", "row").agg(F.array_join(F.sort_array(F.collect_list("license")), ",").alias("notice_licenses"),
                                           F.sum("n").alias("n")))
    named = (named.join(copies, (named["doc_id"].eqNullSafe(copies["doc_id"])) & (named["row"] == copies["row"]))
             .select(named["doc_id"].alias("d"), named["row"].alias("r"), "notice_licenses",
                     (F.col("n") / F.col("copies")).cast("bigint").alias("n_notices")))
    out = whole.join(named, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")), "left")
    return out.select("doc_id", "whole_license", "notice_licenses",
                      F.coalesce("n_notices", F.lit(0).cast("bigint")).alias("n_notices"), "canonical_sha256")


def _sql_canonical(text: str) -> str:
    low = f"lower(coalesce({text}, ''))"
    words = f"' ' || regexp_replace(regexp_replace({low}, '{_COPYRIGHT}', ' ', 'g'), '{_OTHER}', ' ', 'g') || ' '"
    for other, one in SPELLINGS.items():
        words = f"replace({words}, ' {other.replace('-', ' ')} ', ' {one} ')"
    return f"sha256(trim({words}))"


def oracle() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ",\n".join(f"({quote(name)}, {quote(template)})" for name, template in KNOWN)
    return f"""
WITH templates(license, template) AS (VALUES {rows}),
known AS (SELECT {_sql_canonical('template')} AS digest, min(license) AS license FROM templates GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
hits AS (SELECT doc_id, license FROM (SELECT doc_id, {_sql_canonical('line')} AS digest FROM lines) JOIN known USING (digest)),
named AS (SELECT doc_id, count(*) AS n_notices, string_agg(DISTINCT license, ',' ORDER BY license) AS notice_licenses FROM hits GROUP BY doc_id),
whole AS (SELECT doc_id, {_sql_canonical('text')} AS canonical_sha256 FROM documents)
SELECT doc_id, k.license AS whole_license, notice_licenses, coalesce(n_notices, 0) AS n_notices, canonical_sha256
FROM whole LEFT JOIN known k ON canonical_sha256 = k.digest LEFT JOIN named USING (doc_id)
"""
