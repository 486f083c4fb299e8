"""Licence texts by canonical digests.

A text is brought to a canonical form, without case, punctuation, copyright lines and differences of spelling, and joined
by digest with the known licences as a whole.  A document that only carries a notice is found by the same lookup on its
lines, each again as a whole.  ``licence_texts`` holds whole texts by identifier.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Equivalent spellings, as words after punctuation is gone, and the one that stands for them.
SPELLINGS = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "sub license": "sublicense",
    "sub licence": "sublicense",
    "non infringement": "noninfringement",
    "organisation": "organization",
    "organisations": "organizations",
    "authorised": "authorized",
    "authorisation": "authorization",
    "favour": "favor",
    "honour": "honor",
    "per cent": "percent",
    "copyright owner": "copyright holder",
    "copyright owners": "copyright holders",
    "merchantibility": "merchantability",
    "https": "http",
    "59 temple place suite 330 boston ma 02111 1307": "51 franklin street fifth floor boston ma 02110 1301",
}

_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_ISC_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. {}"
_BSD_WARRANTY = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
#: Known licences and notices, as (identifier, text).
KNOWN = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC_WARRANTY),
    ("BSD-2-Clause", _BSD.format("") + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD.format("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. ") + _BSD_WARRANTY),
    ("MIT", "MIT License"),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
]


#: What follows a copyright statement on its line, so that the statement ends there.
_STARTS = r"permission is hereby|permission to use|redistribution and use|(?:licensed|released|distributed) under|everyone is permitted|this (?:program|work|software|file|library) is|spdx[- ]license[- ]identifier"
_STATEMENT = (
    r"(?m)^[^\p{L}\p{N}\n]*(?:(?i:copyright)\b(?!\s+(?i:holder|owner|notice|law|act|interest|license|licence|statement))[ \t:,]*(?:(?i:\(c\)|by\b)|©|\d{4}|[\[<{]|\p{Lu})|(?i:\(c\)|©)[ \t]*\d{4})"
    rf"[^\n]*?(?=\b(?i:{_STARTS})|$)|(?i:all rights reserved)"
)
#: Titles in canonical form, which may stand before a licence or be left out.
_TITLES = r"(?:the )?(?:mit|expat|x11|isc|zero clause bsd|bsd zero clause|0bsd|(?:simplified |new |revised |modified )?bsd(?: [23] clause)?(?: new or revised| simplified)?|[23] clause bsd) license(?: mit| isc| 0bsd)?|apache license version 2 0(?: january 2004)?(?: http www apache org licenses)?|gnu (?:lesser |library )?general public license version \d(?: \d)?(?: \d+)? [a-z]+ \d{4}|mozilla public license version \d \d|creative commons legal code|cc0 1 0 universal"
_HEAD = rf"^(?:(?:{_TITLES}) )*(?:copyright (?!holder|notice).{{1,400}}? (?={_STARTS}))?(?:51 franklin street fifth floor boston ma 02110 1301 (?:usa )?)?"


def canonical(text: Column, keep_lines: bool = False) -> Column:
    """Canonical form of a text; with ``keep_lines``, line by line."""
    text = F.lower(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _STATEMENT, " "))
    # every word between two blanks of its own, so that neighbours are replaced alike
    text = F.concat(F.lit(" "), F.regexp_replace(text, r"[^\p{L}\p{N}\n]+" if keep_lines else r"[^\p{L}\p{N}]+", "  "), F.lit(" "))
    if keep_lines:
        text = F.replace(text, F.lit("\n"), F.lit(" \n "))
    return F.trim(F.regexp_replace(_spelt(text, SPELLINGS), " {2,}", " "))


def _spelt(text: Column, spellings: dict[str, str]) -> Column:
    for old, new in sorted(spellings.items(), key=lambda x: -len(x[0])):
        text = F.replace(text, F.lit(f" {old.replace(' ', '  ')} "), F.lit(f" {new.replace(' ', '  ')} "))
    return text


def whole(lines: Column) -> Column:
    """A text in canonical lines as one, without titles and copyright statement before the licence."""
    # spellings of several words may have stood on two lines
    text = _spelt(F.concat(F.lit(" "), F.regexp_replace(lines, r"\s+", "  "), F.lit(" ")), {k: v for k, v in SPELLINGS.items() if " " in k})
    return F.regexp_replace(F.trim(F.regexp_replace(text, " {2,}", " ")), _HEAD, "")


def full_texts() -> list[tuple[str, str]]:
    """(identifier, text) of ``licence_texts``, each also without what follows its terms."""
    out = []
    for path in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")):
        body = path.read_text("utf-8")
        end = re.search(r"END OF TERMS AND CONDITIONS", body)
        out += [(path.stem, b) for b in ([body, body[: end.end()], body[: end.start()]] if end else [body])]
    return out


def known_licences(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, licence) of known texts, as they are and in one line; the first of equal ones counts."""
    known = [*KNOWN, *full_texts()] if known is None else known
    known = [(name, b) for name, body in known for b in dict.fromkeys([body, " ".join(body.split()), *([re.sub(r"(?<= )[1-3]\. ", "", body)] if name.startswith("BSD") else [])])]
    rows = spark.createDataFrame([(i, name, body) for i, (name, body) in enumerate(known)], "i int, licence string, body string")
    rows = rows.select("i", "licence", F.sha2(whole(canonical(F.col("body"), True)), 256).alias("digest"))
    return rows.groupBy("digest").agg(F.min_by("licence", "i").alias("licence"))


def scan(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, licence, notices): the canonical digest of each whole text, the known licence with that digest, and
    the licences of which the text has a whole line, sorted.

    A null or empty text has the digest of an empty one, which matches nothing, and no notices; repeated rows come once
    each.  Rows with a null doc_id are scanned like others.  An empty table gives an empty result.
    """
    empty = F.sha2(F.lit(""), 256)
    known = known.where(F.col("digest") != empty)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("row"), canonical(F.col(text), True).alias("body"))
    rows = rows.select("doc_id", "row", "body", F.sha2(whole(F.col("body")), 256).alias("digest"))
    lines = rows.select("row", F.explode(F.array_distinct(F.transform(F.split("body", "\n"), lambda line: F.trim(line)))).alias("line"))
    notices = lines.select("row", F.sha2("line", 256).alias("digest")).join(known, "digest").groupBy("row").agg(F.sort_array(F.collect_set("licence")).alias("notices"))
    out = rows.drop("body").join(known, "digest", "left").join(notices, "row", "left")
    return out.select("doc_id", "digest", "licence", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))
