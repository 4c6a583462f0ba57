"""License scan by canonical digests, in DataFrame functions only.

A text's canonical form: A-Z lower-cased, copyright lines dropped, runs of
punctuation and blanks turned into one space, equivalent spellings made one.
Its SHA-256 is looked up among the digests of the known licenses by a hash
join. The texts looked up are each document as a whole and each of its
lines, since a notice usually stands on a line of its own.

The known texts are a parameter (``license_id``, ``text``); ``KNOWN`` is a
small default list. Only their digests are broadcast, and only when counted
as at most ``BROADCAST_ROWS``; a larger list is joined by shuffle.

Null and empty texts match nothing (a canonical form without words has no
license). Known texts that share a digest: the lowest id is reported. Rows
that repeat a ``doc_id`` with the same text share one count per row; other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import ascii_lower, query, table

BROADCAST_ROWS = 100_000

# Notices and short licenses with their SPDX ids.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
             "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
             "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
             "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
             "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
            "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
            "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
            "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
            "IN THE SOFTWARE."),
]

# Rules applied in this order. A newline stays until the end, as it separates the lines.
COPYRIGHT_LINE = r"(^|\n)[ \t*#/;-]*(copyright|\(c\)|©)[^\n]*"
PUNCTUATION = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
SPELLINGS = [  # British forms at the start of a word, and what they become
    (r"(^|[ \n])licenc", "licens"),
    (r"(^|[ \n])(author|organ|recogn|util)is([aei])", "{2}iz{3}"),
    (r"(^|[ \n])(fav|behavi|hon)our", "{2}or"),
]


def canonical_lines(text: Column) -> Column:
    """The canonical form with its line breaks."""
    out = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "$1")
    out = F.regexp_replace(out, PUNCTUATION, " ")
    for pattern, put in SPELLINGS:
        out = F.regexp_replace(out, pattern, "$1" + put.replace("{2}", "$2").replace("{3}", "$3"))
    return out


def one_line(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, license): one row per digest of the known texts, as wholes."""
    form = known.select("license_id", one_line(canonical_lines(F.col("text"))).alias("form")).where("form <> ''")
    out = form.groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("license_id").alias("license"))
    return F.broadcast(out) if out.count() <= BROADCAST_ROWS else out


def default_known(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "license_id string, text string")


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, canonical_sha256, license (whole text), n_license_lines, line_licenses."""
    digests = known_digests(known)
    lines = docs.select("doc_id", F.xxhash64("text").alias("row_hash"), canonical_lines(F.col("text")).alias("lines"))
    found = (lines.select("doc_id", "row_hash", F.posexplode(F.split("lines", "\n")).alias("no", "line"))
             .select("doc_id", "row_hash", "no", F.sha2(F.trim("line"), 256).alias("digest"))
             .join(digests, "digest")
             .groupBy("doc_id", "row_hash").agg(
                 F.countDistinct("no").alias("n"),
                 F.concat_ws(",", F.array_sort(F.collect_set("license"))).alias("ids")))
    whole = lines.select("doc_id", "row_hash", F.sha2(one_line(F.col("lines")), 256).alias("digest")).join(
        digests, "digest", "left").alias("w")
    found = found.alias("f")
    return whole.join(found, F.col("w.doc_id").eqNullSafe(F.col("f.doc_id"))
                      & (F.col("w.row_hash") == F.col("f.row_hash")), "left").select(
        "w.doc_id", F.col("w.digest").alias("canonical_sha256"), "w.license",
        F.coalesce("f.n", F.lit(0)).cast("long").alias("n_license_lines"),
        F.coalesce("f.ids", F.lit("")).alias("line_licenses"))


def _sql_lines(text: str) -> str:
    out = (f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    out = rf"regexp_replace({out}, '{COPYRIGHT_LINE}', '\1', 'g')"
    out = f"regexp_replace({out}, '{PUNCTUATION}', ' ', 'g')"
    for pattern, put in SPELLINGS:
        out = rf"regexp_replace({out}, '{pattern}', '\1{put.format(0, 1, chr(92) + '2', chr(92) + '3')}', 'g')"
    return out


def _sql_one(lines: str) -> str:
    return f"trim(regexp_replace({lines}, '[ \\n]+', ' ', 'g'))"


def _sql_known() -> str:
    return ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN)


SQL = f"""
WITH known AS (SELECT sha256({_sql_one(_sql_lines('text'))}) AS digest, min(license_id) AS license
               FROM (VALUES {_sql_known()}) AS k(license_id, text) GROUP BY 1),
d AS (SELECT doc_id, {_sql_lines('text')} AS lines FROM documents),
found AS (SELECT doc_id, count(DISTINCT no) AS n, array_to_string(list_sort(list(DISTINCT license)), ',') AS ids
          FROM (SELECT doc_id, unnest(string_split(lines, chr(10))) AS line,
                       generate_subscripts(string_split(lines, chr(10)), 1) AS no FROM d)
          JOIN known ON sha256(trim(line)) = digest GROUP BY doc_id)
SELECT d.doc_id, sha256({_sql_one('lines')}) AS canonical_sha256, license, coalesce(n, 0) AS n_license_lines,
       coalesce(ids, '') AS line_licenses
FROM d LEFT JOIN known ON sha256({_sql_one('lines')}) = known.digest LEFT JOIN found ON found.doc_id = d.doc_id
"""


@query("op3_license_scan", SQL)
def op3(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"), default_known(spark))
