"""License scan by canonical digests, with DataFrame and SQL functions only.

A text is brought to a canonical form: lower case; lines that are a copyright notice (the sign, or the word with a sign, a year or a
placeholder after it) dropped, so that a sentence about copyright stays wherever its line breaks; equivalent spellings made one; every run of other characters than letters and digits made one space. The digest
of the whole canonical text is then hash-joined with the digests of known licence texts. The lines of a text
are looked up alike among known one-line notices, since a page may carry a notice inside other text.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Patterns that both Spark and DuckDB read alike.
COPYRIGHT = r"^[^a-z0-9©(]*((copyright|\(c\))[ \t]*(\(c\)|©|19[0-9][0-9]|20[0-9][0-9]|[\[<{]|yyyy|year).*|©.*|all rights reserved[^a-z0-9]*)$"
SPELLINGS = ((r"licence", "license"), (r"(author|organ|recogn|util|ab)is(e|ing|ation)", r"\1iz\2"), (r"fulfil([^l])", r"fulfill\1"), (r"favour", "favor"), (r"https", "http"))
OTHER = r"[^\p{L}\p{N}]+"

# Texts of public licences and of their usual notices, as published.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ZERO_BSD = ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_3 = BSD_2.replace("\nTHIS SOFTWARE", "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\nTHIS SOFTWARE")
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
GPL_3_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
MIT_0 = MIT.replace(", subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", ".")
UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""
BSL_1 = """Boost Software License - Version 1.0 - August 17th, 2003
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
MPL_2_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
GPL_2_NOTICE = GPL_3_NOTICE.replace("either version 3 of", "either version 2 of").replace(": you can redistribute", "; you can redistribute")
LGPL_3_NOTICE = GPL_3_NOTICE.replace("GNU General Public License", "GNU Lesser General Public License")
AGPL_3_NOTICE = GPL_3_NOTICE.replace("GNU General Public License", "GNU Affero General Public License")
KNOWN = (
    ("MIT", MIT), ("MIT", "MIT License\n" + MIT), ("MIT", "The MIT License (MIT)\n" + MIT), ("ISC", ISC), ("ISC", "ISC License\n" + ISC), ("0BSD", ZERO_BSD),
    ("BSD-2-Clause", BSD_2), ("BSD-2-Clause", "BSD 2-Clause License\n" + BSD_2), ("BSD-3-Clause", BSD_3), ("BSD-3-Clause", "BSD 3-Clause License\n" + BSD_3),
    ("Zlib", ZLIB), ("Zlib", "zlib License\n" + ZLIB), ("Apache-2.0", APACHE_NOTICE), ("GPL-3.0-or-later", GPL_3_NOTICE),
    ("MIT-0", MIT_0), ("MIT-0", "MIT No Attribution\n" + MIT_0), ("Unlicense", UNLICENSE), ("BSL-1.0", BSL_1), ("MPL-2.0", MPL_2_NOTICE), ("GPL-2.0-or-later", GPL_2_NOTICE), ("LGPL-3.0-or-later", LGPL_3_NOTICE), ("AGPL-3.0-or-later", AGPL_3_NOTICE),
)
# SHA-256 of the canonical forms of whole licence texts as published, which are too long to be kept here.
FULL_TEXTS = (
    ("Apache-2.0", "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
)
#: Rows of a known table up to which it is broadcast; a larger one is joined by a shuffle of the digests.
BROADCAST_ROWS = 100_000
NOTICES = (
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "This project is licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."), ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "Released under CC0 1.0."),
)


def canonical_text(text: str) -> str:
    """The canonical form of one text on the driver, for the known table."""
    lines = []
    for line in text.split("\n"):
        line = re.sub(COPYRIGHT, "", line.lower())
        for pattern, to in SPELLINGS:
            line = re.sub(pattern, to, line)
        if line := re.sub(r"[\W_]+", " ", line).strip():
            lines.append(line)
    return " ".join(lines)


def canonical_lines(text: Column) -> Column:
    """Canonical lines of a text, those without a letter or digit left out."""

    def canon(line: Column) -> Column:
        line = F.regexp_replace(F.lower(line), COPYRIGHT, "")
        for pattern, to in SPELLINGS:
            line = F.regexp_replace(line, pattern, to.replace("\\", "$"))
        return F.trim(F.regexp_replace(line, OTHER, " "))

    return F.filter(F.transform(F.split(text, "\n"), canon), lambda x: x != "")


def known_digests(spark: SparkSession, known: tuple = KNOWN) -> DataFrame:
    """(digest, license) of the known texts and of FULL_TEXTS: as many rows as the tables above have, whatever the input."""
    rows = {digest: name for name, digest in FULL_TEXTS} | {hashlib.sha256(canonical_text(t).encode()).hexdigest(): name for name, t in known}
    return spark.createDataFrame(sorted(rows.items()), "digest string, license string")


def digest_table(texts: DataFrame, license_col: str = "license", text_col: str = "text") -> DataFrame:
    """(digest, license) of a table of licence texts of any size; of names for one text the least stands. Texts without a letter or digit give none."""
    lines = canonical_lines(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = texts.select(F.array_join(lines, " ").alias("__c"), F.col(license_col).alias("__l")).where("__c <> ''")
    return rows.groupBy(F.sha2("__c", 256).alias("digest")).agg(F.min("__l").alias("license"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: DataFrame | None = None, notices: tuple = NOTICES) -> DataFrame:
    """(id, digest, license, notices, matched) of each row: license where the whole text is a known one, notices the sorted
    licences of its notice lines, matched "text" for a known text, else "notice" where a line is a notice, else null.

    known is a table (digest, license), by default that of KNOWN; up to BROADCAST_ROWS rows of it are broadcast and nothing is
    shuffled; of names for one digest the least stands. A null text is empty; an empty canonical text has the digest of '' and no licence. Repeated rows and null ids are
    kept; other columns are ignored, whatever their names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    table = known_digests(spark) if known is None else known.groupBy("digest").agg(F.min("license").alias("license"))
    digests = {hashlib.sha256(canonical_text(t).encode()).hexdigest(): name for name, t in notices}
    longest = max([0, *(len(canonical_text(t)) for _, t in notices)])
    by_line = F.create_map(*[F.lit(x) for kv in sorted(digests.items()) for x in kv])
    rows = docs.select(F.col(id_col).alias("id"), canonical_lines(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("lines"))
    short = F.filter("lines", lambda x: F.length(x) <= longest)
    found = F.array_sort(F.array_distinct(F.array_compact(F.transform(short, lambda x: F.try_element_at(by_line, F.sha2(x, 256))))))
    made = rows.select("id", F.sha2(F.array_join("lines", " "), 256).alias("digest"), found.alias("notices"))
    small = known is None or table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return made.join(F.broadcast(table) if small else table, "digest", "left").select(F.col("id").alias(id_col), "digest", "license", F.array_join("notices", ",").alias("notices"), F.when(F.col("license").isNotNull(), "text").when(F.size("notices") > 0, "notice").alias("matched"))


def oracle_sql(known: tuple = KNOWN, notices: tuple = NOTICES) -> str:
    """The same over documents, for DuckDB."""
    line = f"regexp_replace(lower(x), '{COPYRIGHT}', '')"
    for pattern, to in SPELLINGS:
        line = f"regexp_replace({line}, '{pattern}', '{to}', 'g')"
    line = f"trim(regexp_replace({line}, '{OTHER}', ' ', 'g'))"
    values = lambda rows: ", ".join(f"('{d}', '{n}')" for d, n in sorted({hashlib.sha256(canonical_text(t).encode()).hexdigest(): n for n, t in rows}.items()))
    return f"""
with known(digest, license) as (values {values(known)}, {", ".join(f"('{d}', '{n}')" for n, d in FULL_TEXTS)}), notice(digest, license) as (values {values(notices)}),
canon as (select doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {line}), lambda x: x <> '') as lines from documents),
hits as (select doc_id, string_agg(distinct license, ',' order by license) as notices
  from (select doc_id, unnest(lines) as x from canon) l join notice on sha256(x) = notice.digest group by doc_id)
select c.doc_id, c.digest, k.license, coalesce(h.notices, '') as notices, case when k.license is not null then 'text' when h.notices is not null then 'notice' end as matched
from (select doc_id, sha256(array_to_string(lines, ' ')) as digest from canon) c
left join known k on k.digest = c.digest left join hits h on h.doc_id = c.doc_id"""
