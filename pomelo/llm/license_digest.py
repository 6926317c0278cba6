"""License scans by canonical digest lookup (operator 5); DataFrame functions only.

A text's canonical form has lower case, no copyright notices, one spelling for
equivalent words, and single spaces for punctuation and white space.  The
SHA-256 of the entire canonical text, without title lines, is hash-joined to
the digests of known licenses.  The same lookup is made for every entire line, since documents
carry license notices as lines of their own; a line is digested only if its
canonical length is that of some known text, which loses nothing.

Scale: texts stay where they are; only digests move.  Line digests are joined
once per distinct set of them, so a notice in a third of all documents is
looked up once.  The known licenses and the distinct sets are broadcast up to
``BROADCAST_ROWS`` rows (counted) and joined by shuffle beyond.

Cases: a null text counts as empty; an empty canonical text matches nothing;
equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pomelo.llm.common import checkpointed

BROADCAST_ROWS = 100_000

# Words that license comparison treats as equal, the second form standing for both.
SAME_WORDS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "copyright owner": "copyright holder", "emphasised": "emphasized", "favour": "favor", "favourite": "favorite",
    "fulfil": "fulfill", "fulfilment": "fulfillment", "https": "http", "initialise": "initialize",
    "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license", "maximise": "maximize",
    "modelled": "modeled", "modelling": "modeling", "non commercial": "noncommercial", "offence": "offense",
    "optimise": "optimize", "organisation": "organization", "organise": "organize", "per cent": "percent",
    "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize",
    "signalling": "signaling", "sub license": "sublicense", "utilisation": "utilization", "whilst": "while",
    "wilful": "willful",
}

_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n")
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n")
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _unnumbered(text: str) -> str:
    """The same with bullets, which no canonical text has, for the numbers of its clauses."""
    return re.sub(r"(?m)^[0-9]\. ", "* ", text)


# Texts of short licenses, and the notices by which documents name a license.
KNOWN = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
        "Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.",
        "The MIT License"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE.",
        "Licensed under the ISC License."),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE.",),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.\n"
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions:\n"
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required.\n"
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
        "software.\n"
        "3. This notice may not be removed or altered from any source distribution.",),
    "BSD-3-Clause": (_BSD_TERMS + _BSD_NAMES + _BSD_WARRANTY, _unnumbered(_BSD_TERMS + _BSD_NAMES + _BSD_WARRANTY),
                     "Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License."),
    "BSD-2-Clause": (_BSD_TERMS + _BSD_WARRANTY, _unnumbered(_BSD_TERMS + _BSD_WARRANTY), "Licensed under the BSD 2-Clause License.", "Released under the BSD 2-Clause License."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0\n"
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
        "the specific language governing permissions and limitations under the License.",
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.",
        "This work is licensed under the Apache License, Version 2.0."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",
                "Licensed under the GNU General Public License, version 2."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "Licensed under the GNU General Public License, version 3."),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",
                 "Licensed under the GNU Lesser General Public License, version 3."),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",
                 "Licensed under the GNU Affero General Public License, version 3."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License, version 2.0."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC0-1.0": ("Licensed under CC0 1.0.", "Released under CC0 1.0 Universal."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain.\n"
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
        "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n"
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
        "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to "
        "the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
        "perpetuity of all present and future rights to this software under copyright law.\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n"
        "For more information, please refer to <https://unlicense.org>"),
}

# Digests of the entire canonical texts of longer licenses.
KNOWN_DIGESTS = {
    "Apache-2.0": ("036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b", 9887),
    "Artistic-1.0-Perl": ("08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702", 5833),
    "CC0-1.0": ("96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f", 6692),
    "GFDL-1.2": ("94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60", 19583),
    "GFDL-1.3": ("a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826", 22018),
    "GPL-1.0": ("8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224", 11765),
    "GPL-2.0": ("464b45d65c9fb612f6ba2e2d21a6aacd7b621de2ef4db62d3a6c599c228fd982", 17061),
    "GPL-3.0": ("eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a", 33406),
    "LGPL-2.0": ("61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908", 24130),
    "LGPL-2.1": ("4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891", 25217),
    "LGPL-3.0": ("aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be", 7104),
    "MPL-1.1": ("cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6", 22447),
    "MPL-2.0": ("f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a", 14341),
}

# Whose the rights are, in lower case: a line of its own, with the lines it runs on to after a comma or "and".
COPYRIGHT_LINE = (r"(?m)^[^\p{L}\p{N}\n©(]*(?:copyright[ \t]*(?:\(c\)|©|[0-9]{4}|[<\[{])|\(c\)[ \t]*[0-9]{4}|©"
                  r"|all rights reserved)(?:[^\n]*(?:,|[ \t]and|&)[ \t]*\n)*[^\n]*$")
# A line of a canonical text that only gives a license's title.
TITLE_LINE = (r"(?m)^ *(?:the )?(?:(?:mit|x11|expat|isc|zlib|zlib libpng|new bsd|modified bsd|revised bsd|simplified bsd"
              r"|bsd [0-3] clause|bsd zero clause|zero clause bsd|bsd 3 clause new or revised|bsd 2 clause simplified)"
              r"(?: license)?(?: mit| x11| expat| isc| zlib| 0bsd| bsd [23] clause)?|unlicense) *$")
_ANY_WORD = r"(?:^|[ \n])(?:" + "|".join(w.replace(" ", "[ \\n]") for w in SAME_WORDS) + r")(?:[ \n]|$)"


def canonical(text: Column) -> Column:
    """Canonical text with its line breaks kept: lines of lower-case words with single spaces between."""
    x = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    x = F.regexp_replace(x, r"[^\p{L}\p{N}\n]+", " ")
    same = x
    for word, standing in SAME_WORDS.items():
        first = word.replace(" ", "[ \\n]")
        same = F.regexp_replace(same, rf"(^|[ \n]){first}(?=[ \n]|$)", "$1" + standing)
    return F.when(x.rlike(_ANY_WORD), same).otherwise(x)


def whole(canonical_text: Column) -> Column:
    """The entire canonical text on one line, without title lines unless it has nothing else."""
    one_line = lambda x: F.btrim(F.regexp_replace(x, r"[ \n]+", " "))
    body = one_line(F.regexp_replace(canonical_text, TITLE_LINE, ""))
    return F.when(~canonical_text.rlike(TITLE_LINE) | (body == ""), one_line(canonical_text)).otherwise(body)


def known_licenses(spark: SparkSession, texts: DataFrame | None = None) -> DataFrame:
    """``(digest, license_id, size)`` of ``texts (license_id, text)``, by default of ``KNOWN``, SPDX tags and ``KNOWN_DIGESTS``."""
    more = spark.createDataFrame([], "digest string, license_id string, size int")
    if texts is None:
        more = spark.createDataFrame([(d, i, n) for i, (d, n) in KNOWN_DIGESTS.items()], more.schema)
        rows = [(i, t) for i, ts in KNOWN.items() for t in (*ts, f"SPDX-License-Identifier: {i}")]
        texts = spark.createDataFrame(rows, "license_id string, text string")
    form = texts.select("license_id", whole(canonical(F.col("text"))).alias("form")).where("form <> ''")
    rows = form.select(F.sha2("form", 256).alias("digest"), "license_id", F.length("form").alias("size")).unionByName(more)
    return checkpointed(rows.groupBy("digest").agg(F.min("license_id").alias("license_id"), F.max("size").alias("size")))


def _placed(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def report(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per document: digest of its entire canonical text, the license it is (or null), and the licenses
    that entire lines of it are (sorted ids, comma-joined)."""
    known = known if known is not None else known_licenses(docs.sparkSession)
    sizes = [r.size for r in known.select("size").distinct().limit(10_000).collect()]   # lengths, to skip other lines
    few = known.select("size").distinct().count() <= 10_000
    form = docs.select("doc_id", canonical(F.col("text")).alias("form"))
    lines = F.transform(F.split("form", "\n"), lambda line: F.btrim(line))
    if few:
        lines = F.filter(lines, lambda line: F.length(line).isin(sizes))
    found = checkpointed(form.select(
        "doc_id", F.sha2(whole(F.col("form")), 256).alias("digest"),
        F.array_sort(F.array_distinct(F.transform(lines, lambda line: F.sha2(line, 256)))).alias("lines")))
    ids = _placed(known.select("digest", "license_id"))
    sets = found.select("lines").where(F.size("lines") > 0).distinct()
    named = checkpointed(
        sets.select("lines", F.explode("lines").alias("digest")).join(ids, "digest")
        .groupBy("lines").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("line_licenses")))
    return (found.join(ids, "digest", "left").join(_placed(named), "lines", "left")
            .select("doc_id", F.col("digest").alias("canonical_sha256"), "license_id",
                    F.coalesce("line_licenses", F.lit("")).alias("line_licenses")))


def oracle() -> str:
    """DuckDB SQL for the rows of ``report`` with the default licenses."""
    quote = lambda t: "'" + t.replace("'", "''") + "'"

    def form(text: str) -> str:
        x = f"regexp_replace(lower(coalesce({text}, '')), {quote(COPYRIGHT_LINE)}, '', 'g')"
        x = f"regexp_replace({x}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
        for word, standing in SAME_WORDS.items():
            # no look-ahead here: twice, for neighbours that share a space
            one = word.replace(" ", "[ \\n]")
            for _ in range(2):
                x = f"regexp_replace({x}, '(^|[ \\n]){one}([ \\n]|$)', '\\1{standing}\\2', 'g')"
        return x

    def one_line(x: str) -> str:
        line = "trim(regexp_replace({}, '[ \\n]+', ' ', 'g'))"
        body = line.format(f"regexp_replace({x}, {quote(TITLE_LINE)}, '', 'g')")
        return f"coalesce(nullif({body}, ''), {line.format(x)})"

    values = ", ".join(f"({quote(i)}, {quote(t)})" for i, ts in KNOWN.items() for t in (*ts, f"SPDX-License-Identifier: {i}"))
    return f"""
        WITH known AS (
            SELECT min(license_id) AS license_id, sha256({one_line(form('t'))}) AS digest
            FROM (VALUES {values}) AS v(license_id, t) GROUP BY 2
            UNION ALL VALUES {", ".join(f"({quote(i)}, {quote(d)})" for i, (d, _) in KNOWN_DIGESTS.items())}),
        d AS (SELECT row_number() OVER () AS n, doc_id, {form('text')} AS form FROM documents),
        l AS (SELECT DISTINCT n, k.license_id
              FROM (SELECT n, sha256(trim(unnest(string_split(form, chr(10))))) AS digest FROM d) x JOIN known k USING (digest)),
        s AS (SELECT n, string_agg(license_id, ',' ORDER BY license_id) AS line_licenses FROM l GROUP BY n)
        SELECT doc_id, sha256({one_line('form')}) AS canonical_sha256, k.license_id,
               coalesce(s.line_licenses, '') AS line_licenses
        FROM d LEFT JOIN known k ON sha256({one_line('form')}) = k.digest LEFT JOIN s USING (n)
    """
