"""License scan by canonical digests.

Column expressions only. A text is brought to a canonical form: lower case,
equivalent spellings made one, copyright statements left out, everything but
letters and digits turned into single spaces, so line breaks do not count. A
statement is the word copyright with a sign, a year or a holder, or a sign or "all
rights reserved" at the start of a line or sentence; "copyright holders" and the like are
text. It ends with its sentence, a separator, the words that open a notice or its
line, and what follows on the line is a line of its own. A long text is also looked up
as it reads if a holder goes on over line ends. The digest of the whole form is
joined with the digests of known licence texts; since notices of one line often
stand alone inside another text, each line of a text is a text of its own for the
same lookup.

Null, empty and copyright-only texts have no digest and match nothing. A licence
given twice, or two with one canonical form, count as the one whose name sorts
first. Repeated rows each get their result, an empty table gives none, and columns
of the input other than the id and the text are not read.
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.common import table

#: Licence texts are a configuration: more than this is an error, not a cut.
MAX_LICENSES = 100_000

# Spellings that mean the same.
SPELLINGS = [
    ("licences", "licenses"), ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("noninfringement", "non infringement"), ("organisation", "organization"),
    ("authorised", "authorized"), ("recognise", "recognize"), ("acknowledgement", "acknowledgment"), ("favour", "favor"),
    ("honour", "honor"), ("judgement", "judgment"), ("whilst", "while"), ("fulfil", "fulfill"), ("utilise", "utilize"),
    ("https", "http"), ("gplv2", "gpl version 2"), ("gplv3", "gpl version 3"), ("ver", "version"),
]

# Notices and licence texts.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
]

_TEXTS = Path(__file__).parent / "license_texts"

# Whole texts as published: file, words the body starts with after its title, words the terms end with.
WHOLE = [
    ("Apache-2.0", "TERMS AND CONDITIONS FOR USE", "END OF TERMS AND CONDITIONS"),
    ("CC0-1.0", "Statement of Purpose", None),
    ("GPL-2.0", "Preamble", "END OF TERMS AND CONDITIONS"),
    ("GPL-3.0", "Preamble", "END OF TERMS AND CONDITIONS"),
    ("LGPL-2.1", "Preamble", "END OF TERMS AND CONDITIONS"),
    ("LGPL-3.0", "This version of the GNU Lesser", None),
    ("MPL-2.0", "1. Definitions", None),
]

_MIT = next(t for n, t in KNOWN if n == "MIT" and t.startswith("Permission"))
_ISC = next(t for n, t in KNOWN if n == "ISC")
_WARRANTY = _MIT[_MIT.index("THE SOFTWARE IS PROVIDED") :]

_BSD_OPENING = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:"""
_BSD_TERMS = [
    """Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.""",
    """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.""",
]
_BSD_NAMES = [
    f"Neither the name of {x} nor the names of {y} contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission."
    for x, y in (
        ("the copyright holder", "its"), ("the copyright holder", "their"), ("the copyright holders", "its"), ("the copyright holders", "their"),
        ("the copyright owner", "its"), ("the <organization>", "its"), ("the author", "its"), ("the author", "any"), ("the University", "its"),
    )
]
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY {by} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
{who} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_PARTIES = [
    ("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT HOLDER OR CONTRIBUTORS"),
    ("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT HOLDERS OR CONTRIBUTORS"),
    ("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT OWNER OR CONTRIBUTORS"),
    ("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "<COPYRIGHT HOLDER>"),
    ("THE AUTHOR AND CONTRIBUTORS", "THE AUTHOR OR CONTRIBUTORS"),
    ("THE AUTHOR", "THE AUTHOR"),
    ("THE REGENTS AND CONTRIBUTORS", "THE REGENTS OR CONTRIBUTORS"),
]


def _bsd(names: list[str | None]) -> list[str]:
    """The text with numbered and plain items, for each clause about names and each pair of parties."""
    out = []
    for name in names:
        terms = _BSD_TERMS + [name] * (name is not None)
        for marked in ([f"{k}. {x}" for k, x in enumerate(terms, 1)], terms):
            out += ["\n".join([_BSD_OPENING, *marked, _BSD_DISCLAIMER.format(by=by, who=who)]) for by, who in _BSD_PARTIES]
    return out


_UNLICENSE = f"""This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this
software under copyright law.

{_WARRANTY.replace("AUTHORS OR\nCOPYRIGHT HOLDERS", "AUTHORS")}"""

_ZERO_BSD = f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

{_ISC[_ISC.index("THE SOFTWARE IS PROVIDED") :]}"""

_APACHE = """you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License."""
_APACHE_HEADERS = [
    opening + 'the Apache License, Version 2.0 (the "License"); ' + _APACHE
    for opening in (
        "Licensed under ",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed "
        "with this work for additional information regarding copyright ownership. The ASF licenses this file to You under ",
    )
]

_MPL_HEADERS = [
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
    f"file, You can obtain one at http://mozilla.org/MPL/2.0/.{x}"
    for x in ("", '\nThis Source Code Form is "Incompatible With Secondary Licenses", as defined by the Mozilla Public License, v. 2.0.')
]


def _gnu_headers() -> list[tuple[str, str]]:
    """The notices that the GNU licences tell authors to attach."""
    out = []
    for kind, short, versions in (
        ("General Public License", "GPL", ("2", "3")), ("Lesser General Public License", "LGPL", ("2.1", "3")), ("Affero General Public License", "AGPL", ("3",)),
    ):
        for version in versions:
            name = f"{short}-{version}" + ".0" * ("." not in version)
            for it in ("program", "library", "software", "file"):
                for later, which in (
                    ("-or-later", f"either version {version} of the License, or (at your option) any later version."),
                    ("", f"version {version} of the License."),
                    ("", f"version {version}."),
                ):
                    opening = f"This {it} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation, {which}"
                    middle = f"""This {it} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details."""
                    copy = f"You should have received a copy of the GNU {kind} along with this {it}"
                    by_post = f"{copy}; if not, write to the Free Software Foundation, Inc., "
                    for end in (
                        f"{copy}. If not, see <http://www.gnu.org/licenses/>.", f"{copy}; if not, see <http://www.gnu.org/licenses/>.",
                        f"{by_post}51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.", f"{by_post}51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
                        f"{by_post}59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
                    ):
                        out.append((name + later, "\n\n".join([opening, middle, end])))
    return out


_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}


def _cc_headers() -> list[tuple[str, str]]:
    out = []
    for code, title in _CC.items():
        opening = f"This work is licensed under the Creative Commons {title} 4.0 International License."
        view = f" To view a copy of this license, visit http://creativecommons.org/licenses/{code.lower()}/4.0/"
        letter = " or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."
        out += [(f"CC-{code}-4.0", x) for x in (opening, f"{opening}{view}.", opening + view + letter)]
    return out


TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "ISC"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "2-Clause BSD License", "The 2-Clause BSD License", "Simplified BSD License", "BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "3-Clause BSD License", "The 3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License", "Zero Clause BSD License", "0BSD"],
}


def full_texts() -> list[tuple[str, str]]:
    """Whole licence texts, with and without title, and the standard headers of files: a bounded table."""
    plain = [("MIT", _MIT), ("ISC", _ISC), ("ISC", _ISC.replace("and/or distribute", "and distribute")), ("Unlicense", _UNLICENSE), ("0BSD", _ZERO_BSD)]
    plain.append(("Unlicense", f"{_UNLICENSE}\n\nFor more information, please refer to <http://unlicense.org/>"))
    plain += [("BSD-2-Clause", x) for x in _bsd([None])] + [("BSD-3-Clause", x) for x in _bsd(_BSD_NAMES)]
    rows = plain + [(name, f"{title}\n\n{text}") for name, text in plain for title in TITLES[name]]
    rows += [("Apache-2.0", x) for x in _APACHE_HEADERS] + [("MPL-2.0", x) for x in _MPL_HEADERS] + _gnu_headers() + _cc_headers()
    for name, first, last in WHOLE:
        text = (_TEXTS / f"{name}.txt").read_text(encoding="utf-8")
        body = text[text.index(first) :]
        rows += [(name, x) for x in (text, body)]
        if last:
            rows += [(name, x[: x.index(last) + n]) for x in (text, body) for n in (0, len(last))]
    return rows


# Of the check SQL only, which takes whole lines.
COPYRIGHT = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright\b|\(c\)|©|all rights reserved)[^\n]*$"


# What stands after the word copyright in running text; anything else is a holder.
_NO_HOLDER = (
    r"(?!(?:holders?|owners?|ownership|notices?|laws?|licen[sc]\w*|statements?|acts?|permission\w*|interests?|claims?|infring\w*|protect\w*"
    r"|disclaim\w*|treat\w*|and|or|in|on|of|is|are|as|to|for|with|that|which|resulting|patents?|subsists|status|terms?|information|assign\w*"
    r"|transfer\w*|materials?|works?|line|the\s+(?:software|library|program|work|file)s?)\b)"
)
_SIGN, _YEAR, _GAP = r"(?:\(c\)|©|&copy;)", r"(?:(?:19|20)\d\d|<year>|\[yyyy\])", r"[\s#*/:,-]{0,9}"
#: Starts of a statement: the word with a sign or a year; at the start of a line or sentence also a sign, or the word with a name.
_MARKED = rf"(?:\bcopyright{_GAP}(?:{_SIGN}|{_YEAR})|{_SIGN}{_GAP}(?:copyright\b|{_YEAR}))"
_FIRST = rf"(?:©|all\s+rights\s+reserved\b|copyright\s+by\b|copyright[^\S\n]+{_NO_HOLDER}(?:(?-i:[\p{{Lu}}\p{{Lo}}<\[\"“'{{])|(?:[^\s]+[^\S\n]*){{1,5}}$))"
_RIGHTS = r"all[^\p{L}\p{N}]{1,9}rights[^\p{L}\p{N}]{1,9}reserved\b"
# What ends a statement: a separator, the end of a sentence (not an initial's dot), or words that open a notice.
_STOP = (
    r"(?:[;|•·—]|\s[-–]\s|(?<!\b\p{L})(?<!\b(?:dr|mr|st|jr|sr))\.(?=\s|$)(?!\s+(?:and|or|&)\s)"
    r"|(?<=\s)(?:licen[sc]ed|released|distributed|published\s+under|provided|available|permission\s+(?:is|to)|redistributions?|everyone|this|these"
    r"|you|see|use\s+of|subject\s+to|under|spdx|unless|the\s+(?:software|library|program|above|following)"
    r"|(?:the\s+)?(?:mit|isc|bsd|apache|gnu|mozilla)\b(?:\s+(?!foundation)[^\s.;]+){0,3}?\s+licen[sc]e)\b)"
)


def _statement(char: str) -> str:
    """A statement whose holder is made of ``char``, with an "all rights reserved" that follows it."""
    tail = rf"(?:(?!{_STOP}|{_RIGHTS}){char})"
    start = rf"(?:{_MARKED}|(?:^[^\p{{L}}\p{{N}}\n©(&]*+|(?<=[.;|]\s{{1,3}}))(?:{_FIRST}))"
    years = rf"(?:[^\S\n]*+[,–-]?[^\S\n]*+(?:{_YEAR}|present\b|{_SIGN}))*+[^\S\n]*+[,:–-]?[^\S\n]*+"
    return rf"(?imd){start}{years}{tail}*+(?:[^\p{{L}}\p{{N}}]*+{_RIGHTS}{tail}*+)?"


STATEMENT = _statement(r"[^\n]")
#: Where a holder goes on over line ends, but not over an empty line: for whole texts of LONG characters only.
WRAPPED = _statement(r"(?:[^\n]|\n(?![^\p{L}\p{N}\n]*(?:\n|\z)))").replace("*+(?:[^", "{0,300}+(?:[^")
LONG = 400


def stated(text: Column) -> Column:
    """Whether a text may hold a copyright statement."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(x)) for x in ("copyright", "reserved", "©", "(c)", "&copy;")])


def without_statements(text: Column, statement: str = STATEMENT) -> Column:
    """The text without its copyright statements, each of which ends a line."""
    return F.when(stated(text), F.regexp_replace(text, statement, "\n")).otherwise(F.coalesce(text, F.lit("")))


def line_forms(text: Column) -> Column:
    """The canonical form of each line, of a text without statements, that has one."""
    spaced = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")
    spaced = F.concat(F.lit(" "), F.replace(spaced, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    for a, b in SPELLINGS + SPELLINGS:  # twice: neighbours share the space between them
        spaced = F.replace(spaced, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.array_remove(F.transform(F.split(spaced, "\n"), lambda x: F.trim(x)), "")


def canonical(lines: Column) -> Column:
    """The canonical form of a whole text from those of its lines; empty where nothing is left."""
    return F.array_join(lines, " ")


def digest(form: Column) -> Column:
    return F.when(form != "", F.sha2(form.cast("binary"), 256))


def readings(text: Column) -> Column:
    """(text, wrapped): the text without its statements and, where it has some, without statements that go on over line ends."""
    plain = F.struct(without_statements(text).alias("text"), F.lit(False).alias("wrapped"))
    wrapped = F.struct(without_statements(text, WRAPPED).alias("text"), F.lit(True).alias("wrapped"))
    return F.when(stated(text), F.array(plain, wrapped)).otherwise(F.array(plain))


def known_digests(licenses: DataFrame, name: str = "license", text: str = "text") -> DataFrame:
    """known_digest and license of each known canonical form."""
    rows = licenses.select(F.col(name).alias("license"), F.explode(readings(F.col(text))).alias("r"))
    rows = rows.select("license", "r.wrapped", canonical(line_forms(F.col("r.text"))).alias("form"))
    rows = rows.where(~F.col("wrapped") | (F.length("form") >= LONG)).select(digest(F.col("form")).alias("known_digest"), "license")
    found = rows.where("known_digest is not null").groupBy("known_digest").agg(F.min("license").alias("license"))
    if found.limit(MAX_LICENSES + 1).count() > MAX_LICENSES:
        raise ValueError(f"more than {MAX_LICENSES} licence texts")
    return found


def scan(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """doc_id, text_digest, license (of the whole text), n_license_lines and line_licenses (sorted names) of every row."""
    known = known_digests(licenses)
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("_row"), "text")
    rows = rows.select("doc_id", "_row", F.explode(readings(F.col("text"))).alias("r")).select("doc_id", "_row", "r.wrapped", line_forms(F.col("r.text")).alias("_lines"))
    form = canonical(F.col("_lines"))
    whole = F.struct(F.when(~F.col("wrapped") | (F.length(form) >= LONG), form).otherwise("").alias("form"), F.lit(True).alias("whole"))
    lines = F.transform("_lines", lambda x: F.struct(x.alias("form"), F.lit(False).alias("whole")))
    units = rows.select("doc_id", "_row", "wrapped", F.explode(F.when(F.col("wrapped"), F.array(whole)).otherwise(F.concat(F.array(whole), lines))).alias("u"))
    units = units.select("doc_id", "_row", "wrapped", "u.whole", digest(F.col("u.form")).alias("digest"))
    hits = units.join(F.broadcast(known), F.col("digest") == F.col("known_digest"), "left")  # MAX_LICENSES short rows at most
    plain, wrapped = F.col("whole") & ~F.col("wrapped"), F.col("whole") & F.col("wrapped")
    line = ~F.col("whole") & F.col("license").isNotNull()
    # a text's units come from one task, so the sums below meet before the shuffle
    return hits.groupBy("doc_id", "_row").agg(
        F.max(F.when(plain, F.col("digest"))).alias("text_digest"),
        F.coalesce(F.max(F.when(plain, F.col("license"))), F.max(F.when(wrapped, F.col("license")))).alias("license"),
        F.count_if(line).alias("n_license_lines"), F.array_sort(F.collect_set(F.when(line, F.col("license")))).alias("line_licenses"),
    ).drop("_row")


def known_licenses(spark: SparkSession) -> DataFrame:
    """The notices, and the whole texts and headers; the check SQL knows the notices only."""
    return spark.createDataFrame(KNOWN + full_texts(), "license string, text string")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), known_licenses(spark))
    return found.withColumn("line_licenses", F.array_join("line_licenses", ","))


def _sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({quote(name)}, {quote(text)})" for name, text in KNOWN)
    form = f"regexp_replace(lower(coalesce(text, '')), {quote(COPYRIGHT)}, '', 'g')"
    form = f"' ' || replace(regexp_replace({form}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), chr(10), ' ' || chr(10) || ' ') || ' '"
    for a, b in SPELLINGS + SPELLINGS:
        form = f"replace({form}, ' {a} ', ' {b} ')"
    lines = f"list_filter(list_transform(string_split({form}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"
    return f"""
WITH raw_known(license, text) AS (VALUES {known}),
known AS (
  SELECT form, min(license) AS license
  FROM (SELECT array_to_string({lines}, ' ') AS form, license FROM raw_known) WHERE form <> '' GROUP BY form),
docs AS (SELECT row_number() OVER () AS r, doc_id, {lines} AS lines FROM documents),
whole AS (SELECT r, doc_id, coalesce(array_to_string(lines, ' '), '') AS form FROM docs),
hits AS (
  SELECT r, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
  FROM (SELECT r, unnest(lines) AS form FROM docs) JOIN known USING (form) GROUP BY r)
SELECT w.doc_id, CASE WHEN w.form <> '' THEN sha256(w.form) END AS text_digest, k.license,
  coalesce(h.n, 0) AS n_license_lines, coalesce(h.names, '') AS line_licenses
FROM whole w LEFT JOIN known k ON w.form = k.form LEFT JOIN hits h ON w.r = h.r"""


SQL = _sql()
