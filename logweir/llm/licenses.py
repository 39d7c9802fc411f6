"""License scan by canonical digests.

A text is brought to a canonical form: lower case, copyright notices dropped, spellings that licences use alike made one,
everything but letters and digits one space, and a licence's usual title dropped in front of its text. A notice is known by its form
(the word or sign of copyright with a sign or a year) and ends with its line, or where a licence's opening words begin: so it does
not matter where a text is wrapped, or whether it is one line. The SHA-256 of the form is joined to the digests of
known licences, so a scan costs one hash per text whatever the number of licences. The digest of the entire text decides what the text
*is*; the digests of its single lines, which come from the same pass, name the notices it *carries*.

Defined results: a NULL text counts as empty and has the digest of an empty string, which no licence has; every row gives a row,
repeated ones and those with a NULL id too; texts of any length are read whole; a text that two known names share gives the first in
order; known texts that are empty in canonical form are ignored; an empty table gives no rows; other columns are not read, so their
names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, text_or_empty

# Spellings that count as the same.
SPELLINGS = {
    "licence": "license",
    "organisation": "organization",
    "authoris": "authoriz",
    "merchantib": "merchantab",
    "acknowledgement": "acknowledgment",
    "favour": "favor",
    "honour": "honor",
    "initialis": "initializ",
    "recognis": "recogniz",
    "sub-license": "sublicense",
    "non-infringement": "noninfringement",
    "https://": "http://",
}
# Words that known licences begin with, where a notice that stands before them on one line ends.
OPENINGS = (
    "permission is hereby granted",
    "permission to use",
    "redistribution and use",
    "licensed under the",
    "this software is provided",
    "this is free and unencumbered",
    "this program is free software",
    "this library is free software",
    "this source code form",
    "everyone is permitted to copy",
    "boost software license",
)
#: A copyright notice by its form, up to its line's end or to opening words, which are kept.
SIGN, YEAR = r"(\(c\)|\(r\)|©)", r"[12][0-9]{3}"
NOTICE = (
    rf"(copyright[ \t:]*({SIGN}|{YEAR})|{SIGN}[ \t]*(copyright[ \t,]*)?{YEAR})[^\n]*?"
    rf"(\n|$|{'|'.join(OPENINGS)})"
)
KEPT_GROUP = 6
RESERVED = r"all rights reserved\.?"
BETWEEN = r"[^\p{L}\p{N}]+"
#: Titles, in canonical form, that stand in front of a licence's text.
TITLE = (
    r"^(the )?(mit license( mit)?|isc license( isc)?|bsd [0-4] clause license|bsd [0-4] clause (new|simplified|original)( or (revised|old))? license|"
    r"(new|simplified|modified) bsd license|zero clause bsd|bsd zero clause license|zlib license|mit no attribution|"
    r"unlicense|apache license( version)? 2 0) "
)

# Texts of licences, and short notices that stand for one.
PERMISSIVE_WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
ISC_WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""
BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
BSD_HEAD = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
# The notice that GNU licences ask for, with the names it is given.
GNU = """
This {kind} is free software; you can redistribute it and/or modify it under the terms of the {name} as published by the
Free Software Foundation; either version {version} of the License, or (at your option) any later version.
This {kind} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty
of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.
"""
# Identifiers and names of licences.
IDENTIFIERS = (
    "MIT", "MIT-0", "ISC", "0BSD", "BSD-1-Clause", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "Apache-1.1", "Apache-2.0",
    "MPL-1.1", "MPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "EPL-1.0", "EPL-2.0",
    "CDDL-1.0", "Zlib", "Unlicense", "BSL-1.0", "WTFPL", "PostgreSQL", "NCSA", "Artistic-2.0", "EUPL-1.2", "OFL-1.1",
    "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0",
)
NAMED = (
    ("MIT", "MIT License"),
    ("ISC", "ISC License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("MPL-2.0", "Mozilla Public License, Version 2.0"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("EPL-2.0", "Eclipse Public License, Version 2.0"),
)
KNOWN = (
    (
        "MIT",
        """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
"""
        + PERMISSIVE_WARRANTY,
    ),
    ("MIT", "MIT License"),
    ("MIT", "Released under the MIT License."),
    (
        "ISC",
        """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
"""
        + ISC_WARRANTY,
    ),
    (
        "0BSD",
        """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
"""
        + ISC_WARRANTY,
    ),
    ("BSD-2-Clause", BSD_HEAD + BSD_WARRANTY),
    (
        "BSD-3-Clause",
        BSD_HEAD
        + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""
        + BSD_WARRANTY,
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.
""",
    ),
    (
        "MIT-0",
        """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so.
"""
        + PERMISSIVE_WARRANTY,
    ),
    (
        "Zlib",
        """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
""",
    ),
    (
        "Unlicense",
        """
This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>
""",
    ),
    (
        "BSL-1.0",
        """
Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at
https://www.boost.org/LICENSE_1_0.txt)
""",
    ),
    (
        "MPL-2.0",
        """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
    ),
    ("GPL-2.0-or-later", GNU.format(kind="program", name="GNU General Public License", version="2")),
    ("GPL-3.0-or-later", GNU.format(kind="program", name="GNU General Public License", version="3")),
    ("LGPL-2.1-or-later", GNU.format(kind="library", name="GNU Lesser General Public License", version="2.1")),
    ("LGPL-3.0-or-later", GNU.format(kind="library", name="GNU Lesser General Public License", version="3")),
    ("AGPL-3.0-or-later", GNU.format(kind="program", name="GNU Affero General Public License", version="3")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    *((name, f"SPDX-License-Identifier: {name}") for name in IDENTIFIERS),
    *((name, f"Licensed under the {title}.") for name, title in NAMED),
)


def known_licenses(spark: SparkSession, texts: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    return spark.createDataFrame(list(texts), "license string, text string")


def canonical_lines(text: Column) -> Column:
    """The text's lines in canonical form, without the empty ones."""
    out = F.regexp_replace(F.lower(text), NOTICE, f"${KEPT_GROUP}")
    out = F.regexp_replace(out, RESERVED, "")
    for spelling, same in SPELLINGS.items():
        out = F.replace(out, F.lit(spelling), F.lit(same))
    return F.filter(F.transform(F.split(out, "\n"), lambda x: F.trim(F.regexp_replace(x, BETWEEN, " "))), lambda x: x != "")


def canonical(lines: Column) -> Column:
    """The whole text out of its lines: without a title in front, unless that is all."""
    whole = F.array_join(lines, " ")
    return F.regexp_replace(whole, TITLE, "")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digests(texts: DataFrame) -> DataFrame:
    """``license, digest`` of known texts, each digest once."""
    return (
        texts.select("license", canonical(canonical_lines(text_or_empty())).alias("canonical"))
        .where("canonical != '' and license is not null")
        .groupBy(digest(F.col("canonical")).alias("digest"))
        .agg(F.min("license").alias("license"))
    )


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id, digest, license, notices``: the digest of the whole canonical
    text, the licence whose text it is (or NULL), and the licences named by single lines, in order.

    Texts are brought to their form once; what is written and joined are digests."""
    lines = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", canonical_lines(text_or_empty()).alias("lines"))
    found = lines.select(
        "row", "doc_id", digest(canonical(F.col("lines"))).alias("digest"),
        F.array_distinct(F.transform("lines", lambda x: F.unhex(digest(x)))).alias("marks"),
    )
    found = staged(found, "licenses")
    table = digests(known)
    each = found.select("row", F.explode("marks").alias("mark"))
    # Lines that are not known drop out before anything is shuffled by document.
    each = each.join(table.select(F.unhex("digest").alias("mark"), F.col("license").alias("named")), "mark")
    notices = each.groupBy("row").agg(F.array_join(F.array_sort(F.collect_set("named")), ",").alias("notices"))
    whole = found.select("row", "doc_id", "digest").join(table, "digest", "left")
    return whole.join(notices, "row", "left").select("doc_id", "digest", "license", F.coalesce("notices", F.lit("")).alias("notices"))


def oracle_sql(texts: tuple[tuple[str, str], ...] = KNOWN) -> str:
    """The scan of ``documents`` in DuckDB SQL."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    form = f"regexp_replace(lower(coalesce(text, '')), {quoted(NOTICE)}, '\\{KEPT_GROUP}', 'g')"
    form = f"regexp_replace({form}, {quoted(RESERVED)}, '', 'g')"
    for spelling, same in SPELLINGS.items():
        form = f"replace({form}, {quoted(spelling)}, {quoted(same)})"
    clean = f"trim(regexp_replace(x, {quoted(BETWEEN)}, ' ', 'g'))"
    lines = f"list_filter(list_transform(string_split({form}, chr(10)), lambda x: {clean}), lambda x: x <> '')"
    whole = lambda x: f"regexp_replace(array_to_string({x}, ' '), {quoted(TITLE)}, '')"
    values = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in texts)
    return f"""
with known as (
    select sha256(canonical) as digest, min(license) as license
    from (select license, {whole(lines)} as canonical from (values {values}) as t(license, text))
    where canonical <> '' group by 1
),
forms as (select row_number() over () as n, doc_id, {lines} as lines from documents),
notices as (
    select n, string_agg(distinct license, ',' order by license) as notices
    from (select n, unnest(lines) as line from forms) as l join known on sha256(l.line) = known.digest
    group by n
)
select doc_id, sha256({whole("lines")}) as digest, license, coalesce(notices, '') as notices
from forms left join known on sha256({whole("lines")}) = known.digest left join notices using (n)
"""
