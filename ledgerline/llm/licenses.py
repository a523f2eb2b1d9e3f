"""Licence scan: canonical digests of whole texts looked up among known licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Steps, let

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
    "SOFTWARE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted{}. "
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. "
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
    "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all "
    "copyright interest in the software to the public domain. We make this dedication for the benefit of the public at "
    "large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
    "relinquishment in perpetuity of all present and future rights to this software under copyright law. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. "
    "For more information, please refer to {}"
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
    "liable for any damages arising from the use of this software. "
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
    "alter it and redistribute it freely, subject to the following restrictions: "
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
    "software. If you use this software in a product, an acknowledgment in the product documentation would be "
    "appreciated but is not required. "
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
    "software. "
    "3. This notice may not be removed or altered from any source distribution."
)
_BOOST = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
    "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
    "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties "
    "to whom the Software is furnished to do so, all subject to the following: "
    "The copyright notices in the Software and this entire statement, including the above license grant, this "
    "restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and "
    "all derivative works of the Software, unless such copies or derivative works are solely in the form of "
    "machine-executable object code generated by a source language processor. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL "
    "THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_APACHE_HEADER = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
    "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
    "the specific language governing permissions and limitations under the License."
)
_GNU_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
    "later version. "
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more "
    "details. "
    "You should have received a copy of the GNU {0}General Public License along with this program. If not, see "
    "<{1}://www.gnu.org/licenses/>."
)
_MPL_HEADER = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
)
# Public licence texts, the headers that files under a long licence carry, and the one-line notices that
# stand for a licence.
KNOWN = (
    ("ISC", _ISC_GRANT.format(", provided that the above copyright notice and this permission notice appear in all copies")),
    ("0BSD", _ISC_GRANT.format("")),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_DISCLAIMER),
    ("BSD-2-Clause", "BSD 2-Clause License " + _BSD_GRANT + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_NAMES + _BSD_DISCLAIMER),
    ("BSD-3-Clause", "BSD 3-Clause License " + _BSD_GRANT + _BSD_NAMES + _BSD_DISCLAIMER),
    ("Unlicense", _UNLICENSE.format("<https://unlicense.org/>")),
    ("Unlicense", _UNLICENSE.format("<https://unlicense.org>")),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License " + _ZLIB),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003 " + _BOOST),
    ("BSL-1.0", _BOOST),
    ("Apache-2.0", _APACHE_HEADER),
    ("GPL-3.0-or-later", _GNU_HEADER.format("", "https")),
    ("AGPL-3.0-or-later", _GNU_HEADER.format("Affero ", "https")),
    ("LGPL-3.0-or-later", _GNU_HEADER.format("Lesser ", "https")),
    ("MPL-2.0", _MPL_HEADER),
    ("MIT", "MIT License " + _MIT_GRANT),
    ("MIT", "The MIT License (MIT) " + _MIT_GRANT),
    ("MIT", _MIT_GRANT),
    ("ISC", "ISC License " + _ISC_GRANT.format(
        ", provided that the above copyright notice and this permission notice appear in all copies")),
    ("0BSD", "BSD Zero Clause License " + _ISC_GRANT.format("")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
)
# Spellings that count as the same word.
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"),
    ("centre", "center"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("honour", "honor"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("noncommercial", "non commercial"),
    ("organisation", "organization"),
    ("percent", "per cent"),
    ("recognise", "recognize"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("http", "https"),
)
# A line that names a holder or a year; not one of a wrapped text that goes on with "copyright notice" or "copyright holders".
_HOLDER = r"copyright[\x20\x09]*(?:\(c\)|\x{A9}|:?[\x20\x09]*[0-9<\[])|\(c\)[\x20\x09]|\x{A9}|all rights reserved"
_COPYRIGHT = rf"^[\x20\x09]*(?:{_HOLDER})"
_OTHER = r"[^\p{L}\p{N}]+"


def _canonical_line(line: Column) -> Column:
    plain = F.lower(line)
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(plain, _OTHER, " ")), F.lit(" "))
    for old, new in SPELLINGS:
        spaced = F.replace(spaced, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.when(plain.rlike(_COPYRIGHT), F.lit("")).otherwise(F.trim(spaced))


def canonical_lines(text: Column) -> Column:
    """The canonical forms of a text's lines, without empty ones: lower case, no copyright lines, only letters
    and digits between single spaces, one spelling per word. Null counts as empty."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(F.transform(lines, _canonical_line), lambda form: form != "")


def canonical(text: Column) -> Column:
    """A whole text in canonical form: its canonical lines one after the other."""
    return F.array_join(canonical_lines(text), " ")


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form; null if that is empty."""
    form = canonical(text)
    return F.when(form != "", F.sha2(form, 256))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """One row ``digest, license`` per known canonical text."""
    frame = spark.createDataFrame(list(known), "license string, text string")
    return frame.select(digest(F.col("text")).alias("digest"), "license").where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("license").alias("license")
    )


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Licences of documents: that of the whole text, and of its lines.

    Returns ``doc_id, digest, license, notices, n_notices``, one row per input row: the digest of the whole
    canonical text (null if it has no letter or digit), the known licence with that digest or null, and the
    known licences whose whole text is one of the document's lines, sorted and joined by commas (null if
    there is none), with the number of such lines. ``known`` holds one row per digest and is broadcast: it
    grows with the number of known licences, not with the documents. Every row is a document of its own,
    whether its ``doc_id`` is null or repeats another's. An empty table gives an empty result.
    """
    forms = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        let(canonical_lines(F.col("text")), lambda x: F.concat(F.array(F.array_join(x, " ")), x)).alias("forms"),
    )
    # The text itself stands first; of the lines only those that are a licence go on. Once written, rows keep their numbers.
    found = Steps(docs.sparkSession).table(
        forms.select("doc_id", "row", F.posexplode("forms").alias("place", "form"))
        .select("doc_id", "row", "place", F.when(F.col("form") != "", F.sha2("form", 256)).alias("digest"))
        .join(F.broadcast(known), "digest", "left")
        .where("place = 0 OR license IS NOT NULL")
    )
    line = F.col("place") > 0
    told = found.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max(F.when(~line, F.col("digest"))).alias("digest"),
        F.max(F.when(~line, F.col("license"))).alias("license"),
        F.array_join(F.array_sort(F.collect_set(F.when(line, F.col("license")))), ",").alias("notices"),
        F.count_if(line).alias("n_notices"),
    )
    return told.select("doc_id", "digest", "license", F.nullif("notices", F.lit("")).alias("notices"), "n_notices")


def _canonical_sql(text: str) -> str:
    form = rf"regexp_replace(lower(coalesce({text}, '')), '(?m)^[\x20\x09]*(?:{_HOLDER})[^\n]*$', '', 'g')"
    form = rf"' ' || trim(regexp_replace({form}, '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' '"
    for old, new in SPELLINGS:
        form = f"replace({form}, ' {old} ', ' {new} ')"
    return f"trim({form})"


def _check() -> str:
    rows = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN)
    return f"""
WITH known AS (
  SELECT sha256({_canonical_sql("t")}) AS digest, min(l) AS license FROM (VALUES {rows}) AS v(l, t) GROUP BY 1),
whole AS (
  SELECT doc_id, CASE WHEN form <> '' THEN sha256(form) END AS digest
  FROM (SELECT doc_id, {_canonical_sql("text")} AS form FROM documents)),
lines AS (
  SELECT doc_id, sha256({_canonical_sql("line")}) AS digest
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)),
notices AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n_notices
  FROM lines JOIN known USING (digest) GROUP BY doc_id)
SELECT doc_id, digest, license, notices, coalesce(n_notices, 0)::BIGINT AS n_notices
FROM whole LEFT JOIN known USING (digest) LEFT JOIN notices USING (doc_id)
"""


CHECK = _check()
