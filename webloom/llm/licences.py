"""Licence scan by canonical digest lookup, JVM-side throughout.

Texts are brought to a canonical form - lower case, equivalent spellings, lines of copyright notices and all
punctuation removed - and their digests joined to those of known licence texts. A document matches when its
entire text is a known licence; besides, every line that is, entire, a known licence notice is reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import materialize

# Spellings that count as the same word.
SPELLINGS = [
    ("licence", "license"), ("organisation", "organization"), ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("favour", "favor"), ("fulfil ", "fulfill "),
    ("initialise", "initialize"), ("judgement", "judgment"), ("merchantibility", "merchantability"),
    ("modernis", "moderniz"), ("non-commercial", "noncommercial"), ("sub-license", "sublicense"),
    ("copyright owner", "copyright holder"), ("per cent", "percent"), ("wilful", "willful"), ("&", " and "),
    ("https:", "http:"),
]
#: Lines that name a copyright holder, or reserve rights: not part of the licence itself (fixed value).
COPYRIGHT_LINE = r"^[^a-z]*(copyright|\(c\)|©)[^a-z]*(\(c\)|©|[0-9]{4}).*$|^[^a-z]*all rights reserved[^a-z]*$"
#: Lines that begin, after comment marks and "portions", with a holder's name behind copyright or its sign, or with
#: (c) and have a year, and that name no term of a licence (fixed value).
_TERMS = (r"\b(notices?|holders?|owners?|owned|licen[cs]\w*|laws?|disclaimers?|conditions?|permissions?|permit\w*|warrant\w*|liab\w*"
          r"|statements?|shall|must|is|are|any|this|these|interests?|infring\w*|patents?|trademarks?|treat\w*|grant\w*|works?|protect\w*)\b"
          r"|(?<!all )\brights?\b")
HOLDER_LINE = rf"^[^\p{{L}}\p{{N}}(©]*(portions\s+)?(copyright\b|©|\(c\)(?=.*\b[0-9]{{4}}\b))(?=.*[\p{{L}}\p{{N}}])(?!.*({_TERMS})).*$"
#: Spellings of several words, as they are once punctuation and line ends have become single spaces.
JOINED_SPELLINGS = [
    ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("copyright owner", "copyright holder"),
    ("per cent", "percent"), ("fulfil ", "fulfill "),
]
NOT_WORDS = r"[^\p{L}\p{N}]+"

# Published licence texts and notices.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_3 = _BSD_2 + """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
LICENCES = [
    ("MIT", "MIT License\n" + _MIT), ("MIT", _MIT), ("ISC", "ISC License\n" + _ISC), ("ISC", _ISC),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_2 + _BSD_END), ("BSD-2-Clause", _BSD_2 + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_3 + _BSD_END), ("BSD-3-Clause", _BSD_3 + _BSD_END),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
]


def _respelled(line: Column) -> Column:
    """A line with equivalent spellings made one; most lines have none and are looked through only once."""
    out = line
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.when(line.rlike("|".join(old for old, _ in SPELLINGS)), out).otherwise(line)


def canonical_lines(text: Column) -> Column:
    """Canonical forms of the lines of a text that have any; a copyright notice has none."""
    lines = F.transform(F.split(F.lower(text), "\n"), lambda x: F.regexp_replace(F.regexp_replace(x, COPYRIGHT_LINE, ""), HOLDER_LINE, ""))
    words = F.transform(F.transform(lines, _respelled), lambda x: F.trim(F.regexp_replace(x, NOT_WORDS, " ")))
    return F.filter(words, lambda x: x != "")


def _digest(text: Column) -> Column:
    """Digest of canonical lines joined by spaces, with spellings that were broken over lines or spaces made one."""
    out = text
    for old, new in JOINED_SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.unhex(F.sha2(F.when(text.rlike("|".join(old for old, _ in JOINED_SPELLINGS)), out).otherwise(text), 256))


def known_licences(spark: SparkSession, licences: list[tuple[str, str]] | None = None) -> DataFrame:
    """``(license_id, text)`` of the licences known here (a short fixed list), or of those given."""
    return spark.createDataFrame(LICENCES if licences is None else licences, "license_id string, text string")


def scan(docs: DataFrame, licences: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, text_digest, license_id, notices``.

    ``text_digest`` is the SHA-256 of the canonical whole text, ``license_id`` the licence that the entire text
    is (of several the first by name; null if none), ``notices`` the sorted licences that entire lines are.
    Null text counts as empty; an empty canonical text matches nothing. Rows that repeat an id with different
    texts are told apart. Other columns are ignored; an empty table gives an empty result.
    """
    known = known_licences(docs.sparkSession) if licences is None else licences
    known = known.select("license_id", F.array_join(canonical_lines(F.col("text")), " ").alias("c")).where("c != ''")
    known = known.groupBy(_digest(F.col("c")).alias("digest")).agg(F.min("license_id").alias("license_id"))
    lines = F.coalesce(canonical_lines(F.col(text_col)), F.array().cast("array<string>"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), lines.alias("lines")).select(
        "doc_id", _digest(F.array_join("lines", " ")).alias("digest"),
        (F.size("lines") > 0).alias("any"), F.array_distinct(F.transform("lines", _digest)).alias("units"))
    # Notices are looked up once for each digest of a line; a row's key is its id and whole-text digest, and
    # rows that share both have the same lines up to how they are broken, so the set of lines is in the key too.
    # Written, digests only: filters that joins infer would work out the canonical texts again each.
    keyed = materialize(rows.withColumn("units_digest", F.sha2(F.array_join(F.transform("units", F.hex), " "), 256)))
    hits = (
        keyed.select("doc_id", "units_digest", F.explode("units").alias("digest")).join(known, "digest")
        .groupBy("doc_id", "units_digest").agg(F.array_sort(F.collect_set("license_id")).alias("notices"))
    )
    whole = known.select("digest", F.col("license_id").alias("whole_id"))
    return (
        keyed.drop("units").join(whole, "digest", "left")
        .join(hits.withColumnRenamed("doc_id", "hit_id").withColumnRenamed("units_digest", "hit_units"),
              F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("units_digest") == F.col("hit_units")), "left")
        .select("doc_id", F.lower(F.hex("digest")).alias("text_digest"),
                F.when(F.col("any"), F.col("whole_id")).alias("license_id"),
                F.array_join(F.coalesce("notices", F.array().cast("array<string>")), ",").alias("notices"))
    )
