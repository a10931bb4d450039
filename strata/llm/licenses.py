"""Licence scan by canonical digests.

A text is brought to a canonical form (case, copyright lines, punctuation and
equivalent spellings) and the digest of the whole is looked up among those of
known licences by a hash join. Single lines are looked up the same way among
known one-line notices.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A line is a copyright line if it starts with such a mark and has a year, a placeholder or the
#: reservation, or if it starts with the sign (after the word, if that is "(c)").
COPYRIGHT_LINE = (r"(?:^|\n)[^a-z0-9\n]*(?:(?:copyright|\(c\)|©)[^\n]*(?:(?:19|20)[0-9][0-9]|all rights reserved"
                  r"|[<\[{](?:year|yyyy|date|name|fullname|owner|holder|copyright))|copyright[ \t]*:?[ \t]*(?:\(c\)|©)|©)[^\n]*")
RESERVED_LINE = r"(?:^|\n)[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*(?:\n|$)"
#: Equivalent spellings, applied in this order after punctuation is gone.
SPELLINGS = [
    ("licenc", "licens"), ("isation", "ization"), ("favour", "favor"), ("wilful", "willful"),
    ("acknowledgement", "acknowledgment"), ("judgement", "judgment"), ("sub licens", "sublicens"),
    ("non commercial", "noncommercial"), ("non infringement", "noninfringement"), ("per cent", "percent"),
    ("copyright holder", "copyright owner"), ("merchantibility", "merchantability"),
]
#: Whole texts of short licences.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity
of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <http://unlicense.org/>""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
}
#: Licences whose whole text, with its title, is a file of ``license_texts``.
FILES = ["Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0"]
#: Title lines that stand before the texts of ``TEXTS``.
TITLES = {
    "MIT": ["MIT", "MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"],
    "ISC": ["ISC", "ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["0BSD", "BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"],
    "Unlicense": ["Unlicense", "The Unlicense"],
    "BSD-2-Clause": ["BSD License", "BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License",
                     'BSD 2-Clause "Simplified" License', "FreeBSD License"],
    "BSD-3-Clause": ["BSD License", "BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License",
                     "Modified BSD License", 'BSD 3-Clause "New" or "Revised" License'],
}
#: Names in one-line notices.
NAMES = {
    "MIT": ["MIT License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2", "GPL-2.0", "GPL-2.0-only",
                "GPL-2.0-or-later"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3", "GPL-3.0", "GPL-3.0-only",
                "GPL-3.0-or-later"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPL-2.1",
                 "LGPL-2.1-only", "LGPL-2.1-or-later"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3", "LGPL-3.0",
                 "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD-3-Clause"],
    "ISC": ["ISC License"],
    "0BSD": ["BSD Zero Clause License", "0BSD"],
    "Zlib": ["zlib License"],
    "Unlicense": ["Unlicense"],
    "CC-BY-4.0": ["CC BY 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC0-1.0": ["CC0 1.0"],
}
#: Where the terms end and the advice how to apply them begins.
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
MAX_KNOWN = 10_000


def known_licenses() -> list[tuple[str, str]]:
    """(licence, text): whole texts (bare and titled, numbered or not, with and without the advice how to apply them,
    with either scheme in links), and the notices that name a licence, bare names of licences and the ids among them."""
    starts = ["Licensed under", "Released under", "This work is licensed under", "This software is released under",
              "SPDX-License-Identifier:"]
    notices = {(k, f"{s} {article}{n}.") for k, names in NAMES.items() for n in names for s in starts for article in ("", "the ")}
    notices |= {(k, n) for k, names in NAMES.items() for n in names}
    notices |= {(k, f"SPDX-License-Identifier: {k}") for k in ("MIT", "ISC", "Zlib")}
    whole = {(k, t) for k, t in TEXTS.items()}
    whole |= {(k, re.sub(r"(?m)^[1-3]\. ", "* ", t)) for k, t in whole if k.startswith("BSD")}
    whole |= {(k, f"{title}\n\n{t}") for k, t in whole for title in TITLES[k]}
    for k in FILES:
        text = (Path(__file__).parent / "license_texts" / f"{k}.txt").read_text(encoding="utf-8")
        whole |= {(k, text), (k, text.split(END_OF_TERMS)[0]), (k, "".join(text.partition(END_OF_TERMS)[:2]))}
    whole |= {(k, t.replace(a, b)) for k, t in whole for a, b in (("http://", "https://"), ("https://", "http://"))}
    return sorted(whole) + sorted(notices)


def canonical(text: Column) -> Column:
    """Lower case, no copyright line, runs of other characters than letters, digits and line
    feeds as one blank, one spelling. Null stays null."""
    c = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "\n")
    c = F.regexp_replace(c, RESERVED_LINE, "\n")
    c = F.regexp_replace(c, r"[^\p{L}\p{N}\n]+", " ")
    for a, b in SPELLINGS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _whole(canon: Column) -> Column:
    return F.trim(F.regexp_replace(canon, r"[ \n]+", " "))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``(doc_id, digest, license_id, notice_ids)`` for every row of ``docs(doc_id, text)``.

    ``digest`` is the MD5 of the canonical whole text (null for a null text),
    ``license_id`` the licence in ``known(license_id, text)`` with that digest
    (the first by name if several have it), ``notice_ids`` the distinct licences, sorted and
    joined by commas, whose whole text is a line of the document (empty if
    none). A text without a letter or digit matches nothing. Repeated rows and a null ``doc_id`` are
    kept, other columns ignored; an empty table gives no rows. ``known`` may
    have at most ``MAX_KNOWN`` different digests: it is a list of licences, not a corpus.
    """
    digests = known.where("text is not null").select(
        _whole(canonical(F.col("text"))).alias("c"), "license_id").where("c <> ''").select(
        F.md5("c").alias("digest"), "license_id").groupBy("digest").agg(F.min("license_id").alias("license_id"))
    rows = digests.limit(MAX_KNOWN + 1).collect()
    if len(rows) > MAX_KNOWN:
        raise ValueError(f"more than {MAX_KNOWN} known licence digests")
    spark = docs.sparkSession
    table = spark.createDataFrame([(r["digest"], r["license_id"]) for r in rows], "digest string, license_id string")
    # known lines: literal digests, each with its licence behind it
    lines = F.transform(F.split("canon", "\n"), lambda x: F.md5(F.trim(x)))
    hits = F.array_intersect(lines, F.array(*[F.lit(r["digest"]) for r in rows]).cast("array<string>"))
    texts = docs.select("doc_id", canonical(F.col("text")).alias("canon")).select(
        "doc_id", F.md5(_whole(F.col("canon"))).alias("digest"), hits.alias("hits"))
    names = F.create_map(*[F.lit(x) for r in rows for x in (r["digest"], r["license_id"])]) if rows \
        else F.lit(None).cast("map<string,string>")
    found = F.array_join(F.sort_array(F.array_distinct(F.transform("hits", lambda h: names[h]))), ",")
    return texts.join(F.broadcast(table), "digest", "left").select(
        "doc_id", "digest", "license_id", F.coalesce(found, F.lit("")).alias("notice_ids"))


def known_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_licenses(), "license_id string, text string")


def oracle() -> str:
    """The same scan of ``documents`` in DuckDB SQL."""
    def quote(s):
        return "'" + s.replace("'", "''") + "'"

    canon = f"regexp_replace(lower(text), {quote(COPYRIGHT_LINE)}, chr(10), 'g')"
    canon = f"regexp_replace({canon}, {quote(RESERVED_LINE)}, chr(10), 'g')"
    canon = f"regexp_replace({canon}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    for a, b in SPELLINGS:
        canon = f"replace({canon}, {quote(a)}, {quote(b)})"
    values = ",\n".join(f"({quote(k)}, {quote(t)})" for k, t in known_licenses())
    return f"""
WITH known(license_id, text) AS (VALUES {values}),
known_canon AS (SELECT license_id, trim(regexp_replace({canon}, '[ \\n]+', ' ', 'g')) AS c FROM known),
digests AS (SELECT md5(c) AS digest, min(license_id) AS license_id FROM known_canon WHERE c <> '' GROUP BY 1),
canon AS (SELECT doc_id, {canon} AS c FROM documents),
lines AS (SELECT doc_id, md5(trim(unnest(string_split(c, chr(10))))) AS digest FROM canon),
notices AS (
  SELECT l.doc_id, string_agg(DISTINCT d.license_id, ',' ORDER BY d.license_id) AS notice_ids
  FROM lines l JOIN digests d USING (digest) GROUP BY l.doc_id),
texts AS (SELECT doc_id, md5(trim(regexp_replace(c, '[ \\n]+', ' ', 'g'))) AS digest FROM canon)
SELECT t.doc_id, t.digest, d.license_id, coalesce(n.notice_ids, '') AS notice_ids
FROM texts t LEFT JOIN digests d USING (digest) LEFT JOIN notices n USING (doc_id)
"""
