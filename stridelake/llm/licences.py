"""Licence scan: whole texts, canonically spelt, looked up among the digests of known licences.

The canonical form follows the published matching guidelines for licence texts: case, white space, punctuation,
copyright lines and list marks do not count, equivalent spellings are one. A text is that licence if the whole of it
is; a licence that is only quoted has another digest. The known digests are made by the same expressions from a table of
texts, which is a parameter, and meet the documents in a hash join on the digest.

NULL or empty texts, and texts without a letter or digit, have no digest and no licence. Very long texts are read whole.
Repeated rows are rows; licences with equal canonical texts are listed by their smallest name, so nothing multiplies;
columns that clash with the result are replaced; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that count as one, the first for the second.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("copyright holder", "copyright owner"), ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"),
    ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("https", "http"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"),
    ("maximise", "maximize"), ("modelled", "modeled"), ("modelling", "modeling"), ("non commercial", "noncommercial"),
    ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"),
    ("per cent", "percent"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("signalling", "signaling"), ("sub license", "sublicense"), ("utilisation", "utilization"),
    ("while", "whilst"), ("wilful", "willful"),
)

_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
          "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
          "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
          "permit persons to whom the Software is furnished to do so, subject to the following conditions:")
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
          "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
          "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
          "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted")
_ISC_END = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
            "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
            "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
            "PERFORMANCE OF THIS SOFTWARE.")
#: Texts of short licences and whole notices that stand for one.
KNOWN = (
    ("MIT", f"{_GRANT}\nThe above copyright notice and this permission notice shall be included in all copies or substantial "
            f"portions of the Software.\n{_AS_IS}"),
    ("MIT-0", f"{_GRANT.removesuffix(', subject to the following conditions:')}.\n{_AS_IS}"),
    ("ISC", f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies.\n{_ISC_END}"),
    ("0BSD", f"{_ISC}.\n{_ISC_END}"),
    ("FSFAP", "Copying and distribution of this file, with or without modification, are permitted in any medium without royalty "
              "provided the copyright notice and this notice are preserved. This file is offered as-is, without any warranty."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)


TITLE = r"\A[ \t\r\n]*+[^\n]{0,50}(?<=licen[cs]e|licen[cs]e \([a-z0-9 -]{1,20}\))[ \t]*+\r?\n(?=[ \t]*+\r?\n)"
COPYRIGHT = (r"(?m)^[^\p{L}\p{N}\n]*+(?:copyright\b(?![ \t]+(?:notice|holder|owner|law|licen[cs]e|statement|and|or)s?\b)|\(c\)[ \t]*(?:copyright|\d{4})|©|"
             r"all rights reserved\b)[^\n]*+$")
MARKS = r"(?m)^[ \t]*+(?:[*•\-#/]++|\(?(?:\d{1,2}|[a-z])[.)])[ \t]++"


def canonical(text: Column) -> Column:
    """Lower-case words without punctuation, list marks, copyright lines and a title line, in one spelling.

    Lines that begin with the word copyright are copyright lines unless they go on as a licence's own sentences do; a
    title is a first line of a few words that names a licence and is followed by an empty line. No expression looks
    beyond a line end more than once, so the time is linear in the text.
    """
    lines = F.regexp_replace(F.lower(text), TITLE, "")
    lines = F.regexp_replace(lines, COPYRIGHT, "")
    lines = F.regexp_replace(lines, MARKS, "")
    words = F.regexp_replace(lines, r"[^\p{L}\p{N}]+", " ")
    spelt = {a: b for a, b in SPELLINGS}
    pattern = r"(?<![\p{L}\p{N}])(?:" + "|".join(sorted(spelt, key=len, reverse=True)) + r")(?![\p{L}\p{N}])"
    out = words
    for a, b in SPELLINGS:
        out = F.regexp_replace(out, rf"(?<![\p{{L}}\p{{N}}]){a}(?![\p{{L}}\p{{N}}])", b)
    return F.trim(F.when(words.rlike(pattern), out).otherwise(words))


def digest(text: Column) -> Column:
    plain = canonical(text)
    return F.when(plain != "", F.sha2(plain, 256))


def known_digests(spark: SparkSession, texts=KNOWN) -> DataFrame:
    """``digest, licence`` of a table of (licence, text), one row for each digest."""
    table = texts if isinstance(texts, DataFrame) else spark.createDataFrame(list(texts), "licence string, text string")
    rows = table.select("licence", digest(F.col("text")).alias("digest")).where("digest is not null")
    return rows.groupBy("digest").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``docs`` with ``digest`` of the whole canonical text and its ``licence``, if it is a known one."""
    rows = docs.drop("digest", "licence").withColumn("digest", digest(F.col("text")))
    return rows.join(known.select("digest", "licence"), "digest", "left").select(*rows.columns, "licence")
