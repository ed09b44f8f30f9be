"""Texts that are, as a whole, a known licence notice."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices by licence, one spelling each; any other that normalises alike is found.
KNOWN_LICENSES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this"
        " file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed"
        " to in writing, software distributed under the License is distributed on an \"AS IS\""
        " BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See"
        " the License for the specific language governing permissions and limitations under"
        " the License.",
    ],
    "AGPL-3.0-or-later": [
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU Affero General Public License as published by the Free Software Foundation,"
        " either version 3 of the License, or (at your option) any later version. This program is"
        " distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even"
        " the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU"
        " Affero General Public License for more details. You should have received a copy of the"
        " GNU Affero General Public License along with this program. If not, see"
        " <https://www.gnu.org/licenses/>.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: 1. Redistributions of source"
        " code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT"
        " HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT"
        " NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR"
        " PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE"
        " FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"
        " (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF"
        " USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF"
        " LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR"
        " OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE"
        " POSSIBILITY OF SUCH DAMAGE.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: 1. Redistributions of source"
        " code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution. 3. Neither the name of the copyright holder"
        " nor the names of its contributors may be used to endorse or promote products derived"
        " from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED"
        " BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED"
        " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND"
        " FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER"
        " OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR"
        " CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
        " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON"
        " ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING"
        " NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF"
        " ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or"
        " neighboring rights to this work.",
    ],
    "GPL-2.0-or-later": [
        "This program is free software; you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation; either"
        " version 2 of the License, or (at your option) any later version. This program is"
        " distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even"
        " the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU"
        " General Public License for more details.",
    ],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "GPL-3.0-or-later": [
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version. This program is"
        " distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even"
        " the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU"
        " General Public License for more details. You should have received a copy of the GNU"
        " General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with"
        " or without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE"
        " AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED"
        " WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR"
        " ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER"
        " RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,"
        " NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
        " PERFORMANCE OF THIS SOFTWARE.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify,"
        " merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in"
        " all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\","
        " WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE"
        " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
        " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR"
        " OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,"
        " OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
        " copy of the MPL was not distributed with this file, You can obtain one at"
        " https://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to"
        " copy, modify, publish, use, compile, sell, or distribute this software, either in source"
        " code form or as a compiled binary, for any purpose, commercial or non-commercial, and by"
        " any means. In jurisdictions that recognize copyright laws, the author or authors of this"
        " software dedicate any and all copyright interest in the software to the public domain. We"
        " make this dedication for the benefit of the public at large and to the detriment of our"
        " heirs and successors. We intend this dedication to be an overt act of relinquishment in"
        " perpetuity of all present and future rights to this software under copyright law. THE"
        " SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,"
        " INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
        " PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM,"
        " DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING"
        " FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE"
        " SOFTWARE. For more information, please refer to <https://unlicense.org>",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event"
        " will the authors be held liable for any damages arising from the use of this software."
        " Permission is granted to anyone to use this software for any purpose, including"
        " commercial applications, and to alter it and redistribute it freely, subject to the"
        " following restrictions: 1. The origin of this software must not be misrepresented; you"
        " must not claim that you wrote the original software. If you use this software in a"
        " product, an acknowledgment in the product documentation would be appreciated but is not"
        " required. 2. Altered source versions must be plainly marked as such, and must not be"
        " misrepresented as being the original software. 3. This notice may not be removed or"
        " altered from any source distribution.",
    ],
    "proprietary": ["All rights reserved."],
}

# Equivalent spellings in normalised text, and the one that is kept.
SPELLINGS = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "non commercial": "noncommercial",
    "sub license": "sublicense",
    "merchantibility": "merchantability",
    "copyright holder": "copyright owner",
    "copyright holders": "copyright owners",
    "version": "v",
    "https": "http",
    "per cent": "percent",
}

# Fixed value: a line that states a copyright and nothing else, in lower case.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}©(\n]*(copyright[ \t]*(\(c\)|©|[0-9])|\(c\)[ \t]*[0-9]|©)[^\n]*$"


def canonical_license(text: Column) -> Column:
    """One spelling for notices that differ in form only; NULL stays NULL.

    In this order: lower case; lines that state a copyright go (``copyright (c) 2020 ...``,
    ``© ...``), as do their marks within the text; each run of other characters than letters
    and digits becomes a space; equivalent spellings become one.
    """
    t = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    t = F.regexp_replace(t, r"\(c\)|©", " ")
    t = F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))
    # With two spaces between words, whole words next to each other can all be replaced.
    t = F.concat(F.lit(" "), F.replace(t, F.lit(" "), F.lit("  ")), F.lit(" "))
    for other, kept in SPELLINGS.items():
        apart = other.replace(" ", "  ")
        t = F.replace(t, F.lit(f" {apart} "), F.lit(f" {kept.replace(' ', '  ')} "))
    return F.trim(F.replace(t, F.lit("  "), F.lit(" ")))


def license_digest(text: Column) -> Column:
    """SHA-256 of the canonical text; empty for NULL.

    It is never NULL, so that no join has to compute it twice to filter on it.
    """
    return F.coalesce(F.sha2(canonical_license(text), 256), F.lit(""))


Known = Mapping[str, list[str]] | DataFrame


def known_digests(docs: DataFrame, known: Known | None = None) -> DataFrame:
    """``license`` and ``known_digest`` of each known notice, of which the digests are distinct.

    ``known`` is a list of notices by licence, or a table with the columns ``license`` and ``notice``,
    or ``license`` and ``known_digest`` if the digests of the notices are all that is kept.
    """
    listed = KNOWN_LICENSES if known is None else known
    if not isinstance(listed, DataFrame):
        rows = [(name, text) for name, texts in listed.items() for text in texts]
        listed = docs.sparkSession.createDataFrame(rows, "license STRING, notice STRING")
    if "known_digest" not in listed.columns:
        listed = listed.filter(canonical_license(F.col("notice")) != "")
        listed = listed.select("license", license_digest(F.col("notice")).alias("known_digest"))
    return listed.groupBy("known_digest").agg(F.min("license").alias("license"))


def license_scan(
    units: DataFrame, known: Known | None = None, text: str = "text", most_bytes: int = 32_000_000
) -> DataFrame:
    """``units`` with ``digest`` and ``license``: the notice that a unit's entire text is, or NULL.

    The known notices are a parameter (``known_digests``); a table of them is broadcast where its
    digests measure at most ``most_bytes``, so that no unit is shuffled, and joined beyond.  A NULL text has an
    empty digest, texts without letters or digits share one, and none of them has a licence.  Repeated
    units come out repeated.  A column of ``units`` named ``digest`` or ``license`` is replaced.
    """
    digests = known_digests(units, known)
    if not isinstance(known, DataFrame) or known.count() * 200 <= most_bytes:
        digests = F.broadcast(digests)
    kept = [F.col(f"`{c}`") for c in units.columns if c not in ("digest", "license")]
    digested = units.select(*kept, license_digest(F.col(f"`{text}`")).alias("digest"))
    joined = digested.join(digests, digested["digest"] == digests["known_digest"], "left")
    return joined.drop("known_digest")


def document_licenses(docs: DataFrame, known: Known | None = None) -> DataFrame:
    """Per document row: the digest and licence of its entire text, and those of its lines.

    Returns ``doc_id``, ``digest``, ``license`` (of the whole text), ``n_license_lines`` and
    ``line_licenses`` (distinct, sorted, comma-joined; NULL if none).  A line is a unit like
    a document: its entire text must be a notice.  Lines are matched where
    they are; only those found are gathered, per document id and text, in which repeated
    rows agree.
    """
    found = license_scan(docs.select("doc_id", "text"), known).select(
        "doc_id", "digest", "license", F.xxhash64("text").alias("hash")
    )
    lines = docs.select(
        "doc_id",
        F.xxhash64("text").alias("hash"),
        F.explode(F.array_distinct(F.split("text", "\n"))).alias("line"),
    )
    hits = license_scan(lines.filter(F.trim("line") != ""), known, "line")
    hits = hits.filter("license IS NOT NULL").groupBy("doc_id", "hash").agg(
        F.countDistinct("line").alias("n"),
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("names"),
    )
    hits = hits.select(
        F.col("doc_id").alias("hit_id"), F.col("hash").alias("hit_hash"), "n", "names"
    )
    on = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("hash") == F.col("hit_hash"))
    return found.join(hits, on, "left").select(
        "doc_id",
        "digest",
        "license",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_license_lines"),
        F.col("names").alias("line_licenses"),
    )
