"""Licence scan by canonical digests.

A text is brought to a canonical form: lower case; copyright notices and lines with a licence's title only out; every run of
punctuation and white space one blank; equivalent spellings one.  A notice is a line that starts with "copyright" or (c) followed by a year,
a (c) or a placeholder in brackets, or with the copyright sign, and "all rights reserved" at the start of a line or in the line after a notice; other
lines that start with "copyright" are sentences and stay, so the form does not depend on where a text is wrapped.  The SHA-256 of the whole canonical text is looked up among the digests of known licences
in a hash join.  All of it is built-in column functions.

A null text counts as empty and matches nothing; texts without a letter or digit match nothing either.  Null identifiers are kept, repeated rows
are answered each, two known licences with one canonical text go by the smaller name, an empty table gives an empty result and
further columns are ignored.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings (fixed values of the public licence-matching guidelines, the first one canonical).
SPELLINGS = (
    ("license", "licence"),
    ("acknowledgment", "acknowledgement"),
    ("analog", "analogue"),
    ("analyze", "analyse"),
    ("artifact", "artefact"),
    ("authorization", "authorisation"),
    ("authorized", "authorised"),
    ("caliber", "calibre"),
    ("canceled", "cancelled"),
    ("catalog", "catalogue"),
    ("center", "centre"),
    ("favor", "favour"),
    ("favorite", "favourite"),
    ("fulfill", "fulfil"),
    ("fulfillment", "fulfilment"),
    ("initialize", "initialise"),
    ("judgment", "judgement"),
    ("labeling", "labelling"),
    ("labor", "labour"),
    ("maximize", "maximise"),
    ("modeled", "modelled"),
    ("modeling", "modelling"),
    ("noncommercial", "non commercial"),
    ("offense", "offence"),
    ("optimize", "optimise"),
    ("organization", "organisation"),
    ("organize", "organise"),
    ("percent", "per cent"),
    ("practice", "practise"),
    ("program", "programme"),
    ("realize", "realise"),
    ("recognize", "recognise"),
    ("signaling", "signalling"),
    ("sublicense", "sub license"),
    ("utilization", "utilisation"),
    ("while", "whilst"),
    ("willful", "wilful"),
)
_YEAR_OR_MARK = r"((19|20)[0-9][0-9]|[\[<{])"
_RIGHTS = r"all[ \t]+rights[ \t]+reserved[.!]*"
_GAP = r"[ \t]+"
_TITLE = (
    rf"(the{_GAP})?(mit|isc|zlib(/libpng)?|((new|modified|revised|simplified|zero[ -]clause){_GAP})?bsd([ -][0-9][ -]clause|{_GAP}zero[ -]clause)?"
    rf"({_GAP}\"[^\n\"]*\"({_GAP}or{_GAP}\"[^\n\"]*\")?)?){_GAP}licen[sc]e({_GAP}\([a-z0-9 -]*\))?[ \t\r:.*/#-]*$"
)
NOTICE = (
    r"(?m)^[ \t>*/#;-]*("
    rf"(copyright[ \t:,]*(\(c\)|©|{_YEAR_OR_MARK})|\(c\)[ \t]*(copyright[ \t]*)?{_YEAR_OR_MARK}|©)[^\n]*(\n[^\n]*{_RIGHTS})?"
    rf"|{_RIGHTS}|{_TITLE})"
)
NOT_WORD = r"[^\p{L}\p{N}]+"

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL \
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR \
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, \
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the \
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer \
in the documentation and/or other materials provided with the distribution."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, \
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO \
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL \
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS \
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR \
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"

# Long texts as published, one file each; read where the plan is built.
_FILES = sorted((Path(__file__).parent / "licenses").glob("*.txt"))

# Public licence texts (fixed values); a parameter like any other table of (license_id, text).
KNOWN = {
    "MIT": """MIT License
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files \
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, \
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, \
subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF \
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR \
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH \
THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": f"""ISC License
{_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.
{_AS_IS}""",
    "0BSD": f"""BSD Zero Clause License
{_GRANT}.
{_AS_IS}""",
    "BSD-2-Clause": f"{_BSD_HEAD}\n{_BSD_TAIL}",
    "BSD-3-Clause": f"""{_BSD_HEAD}
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from \
this software without specific prior written permission.
{_BSD_TAIL}""",
    "Zlib": """zlib License
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages \
arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and \
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this \
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    **{f.stem: f.read_text(encoding="utf-8") for f in _FILES},
}


def canonical(text: Column) -> Column:
    out = F.lower(F.coalesce(text, F.lit("")))
    # lines end at \n only, as in SQL
    out = F.regexp_replace(out, f"(?d){NOTICE}", "\n")
    # blanks around, so that a spelling is replaced as a whole word only
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(out, NOT_WORD, " ")), F.lit(" "))
    for first, other in SPELLINGS:
        out = F.replace(out, F.lit(f" {other} "), F.lit(f" {first} "))
    return F.trim(out)


def digest(text: Column) -> Column:
    return F.sha2(F.encode(canonical(text), "UTF-8"), 256)


def known_licenses(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(k).alias("license_id"), F.lit(v).alias("text")) for k, v in KNOWN.items()])
    return spark.range(1).select(F.inline(rows))


def scan(docs: DataFrame, known: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, text_digest, license_id (null if the text is no known licence)."""
    empty = F.sha2(F.encode(F.lit(""), "UTF-8"), 256)
    table = (
        known.select("license_id", digest(F.col("text")).alias("known_digest"))
        .filter(F.col("known_digest") != empty)
        .groupBy("known_digest")
        .agg(F.min("license_id").alias("license_id"))
    )
    read = docs.select(F.col(id), digest(F.col(text)).alias("text_digest"))
    return read.join(table, F.col("text_digest") == F.col("known_digest"), "left").select(id, "text_digest", "license_id")


def canonical_sql(text: str) -> str:
    """The same in ANSI SQL (with two regular expressions)."""
    out = f"regexp_replace(lower(coalesce({text}, '')), '{NOTICE}', chr(10), 'g')"
    out = f"(' ' || trim(regexp_replace({out}, '{NOT_WORD}', ' ', 'g')) || ' ')"
    for first, other in SPELLINGS:
        out = f"replace({out}, ' {other} ', ' {first} ')"
    return f"trim({out})"
