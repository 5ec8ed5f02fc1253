"""License scans by canonical digest lookup.

A text is brought to canonical form: copyright lines go, A-Z becomes lower case, equivalent
spellings become one, punctuation and white space become single spaces. The digest of the whole
canonical text is looked up among those of known licences in a hash join with the (fixed, small)
table of digests. The same digests are taken of every line, to report licence notices inside
other texts. All of it is DataFrame functions inside the scan.
"""

from __future__ import annotations

from functools import cache
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import fresh

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Pattern and replacement, applied in this order to text in lower case.
RULES = [
    (r"(^|\n)[ \t*#/;-]*copyright[ \t]*(\(c\)|©)?[ \t]*[0-9<\[{y][^\n]*", "\n"),
    (r"(^|\n)[ \t*#/;-]*copyright[ \t]*(\(c\)|©)[^\n]*", "\n"),
    (r"(^|\n)[ \t*#/;-]*copyright[ \t][^\n]*\b(19|20)[0-9][0-9]\b[^\n]*", "\n"),
    (r"(^|\n)[ \t*#/;-]*(\(c\)|©)[ \t]*[0-9][^\n]*", "\n"),
    (r"all rights reserved\.?", " "),
    (r"[!-/:-@\[-`{-~“”‘’«»…–—©\s]+", " "),
    (r"\b(licence)\b", "license"),
    (r"\b(licences)\b", "licenses"),
    (r"\b(licenced)\b", "licensed"),
    (r"\b(sub license|sub licence|sublicence)\b", "sublicense"),
    (r"\b(copyright owner)\b", "copyright holder"),
    (r"\b(copyright owners)\b", "copyright holders"),
    (r"\b(organisation)\b", "organization"),
    (r"\b(non commercial)\b", "noncommercial"),
    (r"\b(per cent)\b", "percent"),
]

_WARRANTY_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
    "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_WARRANTY_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_GRANT_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal '
    "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_WARRANTY_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n"
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
    "non-commercial, and by any means.\n"
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make "
    "this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
    "perpetuity of all present and future rights to this software under copyright law.\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR '
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING "
    "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n"
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n"
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in "
    "the product documentation would be appreciated but is not required.\n"
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n"
    "3. This notice may not be removed or altered from any source distribution."
)
_BOOST = (
    "Boost Software License - Version 1.0 - August 17th, 2003\n"
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "
    '"Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the '
    "Software is furnished to do so, all subject to the following:\n"
    "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies "
    "of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code "
    "generated by a source language processor.\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR '
    "PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
_BSD_1 = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
_BSD_2 = (
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution.\n"
)
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"

#: Fixed values: (licence, text) of whole short licences and of usual one-line notices. The texts
#: of long ones are the files of the folder ``licenses``, named by licence.
KNOWN = [
    ("MIT", f"{_GRANT_MIT}, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n{_WARRANTY_MIT}"),
    ("MIT", f"MIT License\n{_GRANT_MIT}, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n{_WARRANTY_MIT}"),
    ("MIT", f"The MIT License (MIT)\n{_GRANT_MIT}, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n{_WARRANTY_MIT}"),
    ("MIT-0", f"{_GRANT_MIT}.\n{_WARRANTY_MIT}"),
    ("MIT-0", f"MIT No Attribution\n{_GRANT_MIT}.\n{_WARRANTY_MIT}"),
    ("BSD-2-Clause", _BSD_START + _BSD_1 + _BSD_2 + _WARRANTY_BSD),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_START + _BSD_1 + _BSD_2 + _WARRANTY_BSD),
    ("BSD-3-Clause", _BSD_START + _BSD_1 + _BSD_2 + _BSD_3 + _WARRANTY_BSD),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_START + _BSD_1 + _BSD_2 + _BSD_3 + _WARRANTY_BSD),
    ("ISC", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n{_WARRANTY_ISC}"),
    ("ISC", f"ISC License\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n{_WARRANTY_ISC}"),
    ("0BSD", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n{_WARRANTY_ISC}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0-only", "Licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("Unlicense", _UNLICENSE),
    ("Zlib", _ZLIB),
    ("BSL-1.0", _BOOST),
]


@cache
def known_texts() -> tuple[tuple[str, str], ...]:
    """(licence, text): ``KNOWN`` and the texts of the folder ``licenses``."""
    files = sorted((f for f in resources.files("cardlens.llm").joinpath("licenses").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    return (*KNOWN, *((f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in files))


#: Texts without one of these have nothing that the rules about copyright change.
_CLAIMS = ("copyright", "(c)", "©", "all rights reserved")
_PLAIN = next(i for i, (pattern, _) in enumerate(RULES) if pattern.startswith("[!"))


def canonical(text: Column) -> Column:
    """The canonical form; null counts as the empty text.

    ``RULES`` in their order. Those on copyright and those on spellings are asked one by one only
    if a text has anything for them.
    """

    def replaced(x: Column, rules: list[tuple[str, str]]) -> Column:
        for pattern, with_ in rules:
            x = F.regexp_replace(x, pattern, with_)
        return x

    def then(x: Column, f) -> Column:
        """``f`` of ``x``, which is computed once."""
        return F.get(F.transform(F.array(x), f), F.lit(0))

    claims = F.lit(False)
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    spellings = "|".join(pattern for pattern, _ in RULES[_PLAIN + 1 :])

    def without_claims(x: Column) -> Column:
        some = claims
        for word in _CLAIMS:
            some = some | x.contains(word)
        return F.regexp_replace(F.when(some, replaced(x, RULES[:_PLAIN])).otherwise(x), *RULES[_PLAIN])

    out = then(then(lower, without_claims), lambda x: F.when(x.rlike(spellings), replaced(x, RULES[_PLAIN + 1 :])).otherwise(x))
    return F.trim(out)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_licenses(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """(license, digest): one row for each digest of ``known`` (license, text), or of the built-in
    texts. Of licences with the same canonical text the first by name counts."""
    if known is None:
        rows = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in known_texts()])
        known = spark.range(1).select(F.inline(rows))
    return known.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license").alias("license"))


#: Most digests of a caller's table: every line is looked up in a map of them, one value of about 100 bytes each.
MOST_KNOWN = 1_000


def scan_licenses(docs: DataFrame, text_col: str = "text", known: DataFrame | None = None) -> DataFrame:
    """``docs`` with canonical_sha256, license and notices added or replaced.

    ``license``: of which known licence the whole text is a copy; null if of none. ``notices``:
    the licences whose whole text a single line of it is, sorted, each once; every line is looked
    up. A null or empty text has no licence. ``known`` (license, text) replaces the built-in texts;
    more than ``MOST_KNOWN`` different ones raise an error. Rows stay as they are otherwise, repeated rows, columns with clashing names and
    empty tables included. A text of any length is one value and is read whole.
    """
    digests = known_licenses(docs.sparkSession, known)
    if known is not None and digests.limit(MOST_KNOWN + 1).count() > MOST_KNOWN:
        raise ValueError(f"more than {MOST_KNOWN} known licence texts")
    by_digest = digests.agg(F.map_from_entries(F.collect_list(F.struct("digest", "license"))).alias("m")).select("m").scalar()
    m, text = fresh(docs, "_known"), F.coalesce(F.col(text_col), F.lit(""))
    named = F.transform(F.split(text, "\n"), lambda x: F.element_at(F.col(m), digest(x)))
    out = docs.withColumns({m: by_digest, "canonical_sha256": digest(F.col(text_col))})
    out = out.withColumn("notices", F.array_sort(F.array_distinct(F.filter(named, lambda x: x.isNotNull())))).drop(m)
    key, name = fresh(out, "_digest"), fresh(out, "_license")
    digests = digests.select(F.col("digest").alias(key), F.col("license").alias(name))
    digests = F.broadcast(digests) if known is None else digests  # the built-in texts are few
    joined = out.join(digests, F.col("canonical_sha256") == F.col(key), "left")
    return joined.withColumn("license", F.col(name)).drop(key, name)


def oracle() -> str:
    """DuckDB SQL for doc_id, canonical_sha256, license, notices."""

    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def canon(x: str) -> str:
        out = f"translate(coalesce({x}, ''), '{_UPPER}', '{_LOWER}')"
        for pattern, with_ in RULES:
            with_ = "chr(10)" if with_ == "\n" else quoted(with_)
            out = f"regexp_replace({out}, {quoted(pattern)}, {with_}, 'g')"
        return f"trim({out})"

    values = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in known_texts())
    return f"""
WITH known AS (SELECT sha256({canon('text')}) AS digest, min(license) AS license FROM (VALUES {values}) t(license, text) GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
named AS (SELECT doc_id, list_sort(list(DISTINCT license)) AS notices
          FROM (SELECT doc_id, sha256({canon('line')}) AS digest FROM lines)
          JOIN known USING (digest) GROUP BY 1),
docs AS (SELECT doc_id, sha256({canon('text')}) AS canonical_sha256 FROM documents)
SELECT docs.doc_id, canonical_sha256, license, coalesce(array_to_string(notices, ','), '') AS notices
FROM docs LEFT JOIN known ON digest = canonical_sha256 LEFT JOIN named ON named.doc_id = docs.doc_id
"""
