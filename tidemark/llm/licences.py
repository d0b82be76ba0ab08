"""Licence texts found by the digest of their canonical form.

A text is brought to its canonical form: lower case, without copyright lines, equivalent spellings
made one, every run of other characters than letters and digits a single space. Whole texts, and
each line of a document as a text of its own, are hash-joined by SHA-256 to the known digests.

The known texts are the short licences, bare and under their usual titles, the usual one-line
notices, built by rule from phrases and names, and whatever table of texts the caller gives.

Defined cases: null and empty texts match nothing. Repeated rows of one id and text give equal
results. Extra columns are ignored; with an empty table the result is empty.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Licence names as notices spell them, by SPDX identifier.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "MIT": ("MIT License", "MIT"),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD-2-Clause", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "BSD-3-Clause", "New BSD License", "Modified BSD License"),
    "ISC": ("ISC License", "ISC"),
    "Zlib": ("zlib License", "Zlib"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL-2.0"),
    "GPL-2.0-only": ("GNU General Public License, version 2", "GPL-2.0", "GPL-2.0-only", "GPLv2"),
    "GPL-3.0-only": ("GNU General Public License, version 3", "GPL-3.0", "GPL-3.0-only", "GPLv3"),
    "LGPL-2.1-only": ("GNU Lesser General Public License, version 2.1", "LGPL-2.1", "LGPLv2.1"),
    "LGPL-3.0-only": ("GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv3"),
    "AGPL-3.0-only": ("GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, version 2.0", "EPL-2.0"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0", "BSL-1.0"),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0 1.0", "Creative Commons Zero 1.0", "CC0-1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC-BY-4.0"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0",),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0",),
}

# Phrases around a name in one-line notices.
PHRASES = (
    "{}", "The {}", "License: {}", "SPDX-License-Identifier: {}", "Licensed under {}",
    "Licensed under the {}", "Released under {}", "Released under the {}", "Distributed under {}",
    "Distributed under the {}", "Available under the {}", "This work is licensed under {}",
    "This work is licensed under the {}", "This work is licensed under a {}",
    "This project is licensed under the {}", "This software is released under the {}",
    "This file is licensed under the {}",
)

# Whole licences.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no
event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
the original software.

3. This notice may not be removed or altered from any source distribution.""",
}

# Whole licences that ``licenses_sql`` does not list.
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the
distribution.

"""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission.

"""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR
A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT
NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
MORE_TEXTS = {
    "BSD-2-Clause": _BSD + _BSD_DISCLAIMER,
    "BSD-3-Clause": _BSD + _BSD_THIRD + _BSD_DISCLAIMER,
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy
of the software and accompanying documentation covered by this license (the "Software") to use,
reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of
the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to
the following:

The copyright notices in the Software and this entire statement, including the above license grant,
this restriction and the following disclaimer, must be included in all copies of the Software, in
whole or in part, and all derivative works of the Software, unless such copies or derivative works are
solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND
NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE
LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in
source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any
and all copyright interest in the software to the public domain. We make this dedication for the
benefit of the public at large and to the detriment of our heirs and successors. We intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this
software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org/>""",
}

# Titles besides the names.
TITLES = {
    "MIT": ("MIT License (MIT)", "MIT Licence", "MIT/X11 License", "Expat License"),
    "ISC": ("ISC License (ISC)",),
    "Zlib": ("zlib License (Zlib)", "zlib/libpng License"),
    "BSD-2-Clause": ('BSD 2-Clause "Simplified" License', "FreeBSD License"),
    "BSD-3-Clause": ('BSD 3-Clause "New" or "Revised" License', "Revised BSD License"),
    "BSL-1.0": ("Boost Software License - Version 1.0 - August 17th, 2003",),
}

# Fixed values: (pattern, replacement) for spellings that mean the same, after lower-casing.
SPELLINGS = (
    ("licen[cs]e", "license"),
    ("licen[cs]ed", "licensed"),
    ("sub[- ]license", "sublicense"),
    ("non[- ]?infringement", "noninfringement"),
    ("non[- ]?commercial", "noncommercial"),
    ("share[- ]?alike", "sharealike"),
    ("no[- ]?derivatives", "noderivatives"),
    ("acknowledgement", "acknowledgment"),
    ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"),
    ("&", " and "),
)
_COPYRIGHT = r"(?m)^[ \t#*/;-]*(copyright\b[ \t]*(\(c\)|©|[0-9]|by\b)|\(c\)[ \t]*[0-9]|©)[^\n]*$"
_OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(text), _COPYRIGHT, " ")
    for pattern, same in SPELLINGS:
        out = F.regexp_replace(out, pattern, same)
    return F.trim(F.regexp_replace(out, _OTHER, " "))


def known_texts() -> list[tuple[str, str]]:
    """(identifier, text): whole licences, bare and under their title, and the notices."""
    found = [(spdx, text) for spdx, text in TEXTS.items()]
    found += [(spdx, f"{NAMES[spdx][0]}\n\n{text}") for spdx, text in TEXTS.items()]
    found += [
        (spdx, phrase.format(name)) for spdx, names in NAMES.items() for name in names for phrase in PHRASES
    ]
    return found


def whole_texts() -> list[tuple[str, str]]:
    """(identifier, text): whole licences, bare and under each title, in their usual spellings."""
    found = []
    for spdx, text in {**TEXTS, **MORE_TEXTS}.items():
        names = (*NAMES[spdx], *TITLES.get(spdx, ()))
        heads = ["", *names, *(f"The {n}" for n in names)]
        bodies = {text, re.sub(r"(?m)^\d\. ", "", text), text.replace("https", "http")}
        found += [
            (spdx, f"{head}\n\n{rights}\n\n{body}")
            for head in heads
            for rights in ("", "All rights reserved.")
            for body in sorted(bodies)
        ]
    return found


def known_digests(spark: SparkSession, more: DataFrame | None = None) -> DataFrame:
    """(digest, license): one row for each canonical text.

    ``more`` has the columns ``license`` and ``text``: further whole texts, as of the long licences.
    """
    schema = T.StructType([T.StructField("license", T.StringType()), T.StructField("text", T.StringType())])
    texts = spark.createDataFrame(known_texts() + whole_texts(), schema)
    if more is not None:
        texts = texts.unionByName(more.select("license", "text").where("text is not null"))
    digest = F.sha2(canonical(F.col("text")).cast("binary"), 256)
    return texts.groupBy(digest.alias("digest")).agg(F.min("license").alias("license"))


def scan_licenses(
    docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, digest, license, notices, n_notices), a row for each row of ``docs``.

    ``license`` is that of the entire text, else null; ``notices`` are the licences that single
    lines are the entire text of, sorted, and ``n_notices`` counts those lines.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key")
    )
    digest = F.sha2(canonical(F.col("text")).cast("binary"), 256)
    lines = rows.select("doc_id", "key", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    notices = (
        lines.select("doc_id", "key", "line", digest.alias("digest"))
        .join(known, "digest")
        .groupBy("doc_id", "key")
        .agg(
            F.array_sort(F.collect_set("license")).alias("notices"),
            F.count_distinct("line").alias("n_notices"),
        )
        .withColumnsRenamed({"doc_id": "n_id", "key": "n_key"})
    )
    whole = rows.select("doc_id", "key", digest.alias("digest")).join(known, "digest", "left")
    same = F.col("doc_id").eqNullSafe(F.col("n_id")) & (F.col("key") == F.col("n_key"))
    return whole.join(notices, same, "left").select(
        "doc_id", "digest", "license",
        F.coalesce(F.concat_ws(",", "notices"), F.lit("")).alias("notices"),
        F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
    )


def licenses_sql() -> str:
    """The result of ``scan_licenses`` over ``documents`` as plain SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    out = f"regexp_replace(lower(text), {quote(_COPYRIGHT)}, ' ', 'g')"
    for pattern, same in SPELLINGS:
        out = f"regexp_replace({out}, {quote(pattern)}, {quote(same)}, 'g')"
    digest = f"sha256(trim(regexp_replace({out}, {quote(_OTHER)}, ' ', 'g'), ' '))"
    values = ", ".join(f"({quote(s)}, {quote(t)})" for s, t in known_texts() + whole_texts())
    return f"""
        WITH known AS (
            SELECT {digest} AS digest, min(license) AS license
            FROM (VALUES {values}) v(license, text) GROUP BY 1),
        docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
        lines AS (SELECT r, unnest(string_split(text, chr(10))) AS text FROM docs),
        notices AS (
            SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n
            FROM (SELECT r, {digest} AS digest FROM lines) JOIN known USING (digest) GROUP BY r)
        SELECT doc_id, d.digest, license, coalesce(notices, '') AS notices,
               coalesce(n, 0) AS n_notices
        FROM (SELECT r, doc_id, {digest} AS digest FROM docs) d
        LEFT JOIN known k ON k.digest = d.digest LEFT JOIN notices USING (r)"""
