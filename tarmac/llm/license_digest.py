"""License scans: canonical digest lookup of entire texts (SQL functions only).

``canonical`` lower-cases A-Z, drops copyright statements (lines that start
with the word and a sign, year or holder; not lines of a wrapped text that
start with the word), replaces punctuation by blanks, maps equivalent spellings to one form
and collapses blanks, so the width that a text is wrapped at does not
matter.  A holder's statement that is itself broken over lines goes up to the
first break only.  Texts
with equal canonical forms share a SHA-256 digest, and documents are
hash-joined to the digests of the known texts.  Two units are looked up: the
document's whole text and each of its lines (a notice standing alone).

Defined results: null text has no digest and no license; an empty text has
the digest of the empty string and no license (known texts are not empty);
repeated rows are answered each; line licenses are distinct and sorted.  The
known texts (whole licences with their usual titles, ``license_texts``, and
notices) are a few hundred, so their digests are broadcast; a caller's own
table above ``BROADCAST_ROWS`` rows is joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import license_texts
from tarmac.llm.common import UPPER, ascii_lower, table

BROADCAST_ROWS = 10_000

# Spellings taken as equivalent (from, to), replaced wherever they stand.
SPELLINGS = [
    ("licence", "license"),
    ("acknowledgement", "acknowledgment"),
    ("merchantibility", "merchantability"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("noninfringement", "non infringement"),
    ("copyright owner", "copyright holder"),
]

# A statement that fills a line: "copyright" and a sign, a colon, a placeholder, "by" or a year
# (next or last), or a sign and a year.
COPYRIGHT = (r"^[^0-9a-z\n]*((c\)|©)[^0-9a-z\n]*)?copyright[ \t]*(\(c\)|©|:|[0-9<{\[]|by[ \t]|[^\n]*[^0-9](19|20)[0-9][0-9][^0-9a-z\n]*$)[^\n]*"
             r"|^[^0-9a-z\n]*(c\)|©)[ \t]*(19|20)[0-9][0-9][^\n]*")
# Statements known by their words, however they are wrapped ("B" stands for blanks): the Foundation's with its
# address, those of the examples in its licences, and the reservation of rights.
STATEMENTS = "|".join([
    r"copyrightB\(c\)B[0-9, \t\n]+freeBsoftwareBfoundation,Binc\.,?(B<https?://fsf\.org/>)?(B(51|59|675)B[0-9a-z \t\n,.-]*?usa)?",
    r"copyrightB\(c\)B<?(year|19yy|19xx)>?B<?(nameBofBauthor|yourBname)>?\.?",
    r"allBrightsBreserved\.?",
]).replace("B", r"[ \t\n]+")
# What follows a statement starts a line of its own.
FOLLOWING = ["everyone is permitted to copy", "permission is hereby granted", "redistribution and use"]
# ASCII characters that are neither letter, digit nor line feed.
SIGNS = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"

# Known license texts and notices (public texts).
KNOWN = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:\nThe above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED \"AS IS\", "
            "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
            "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
            "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
            "OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies.\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
            "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR "
            "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
            "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
            "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
             "is hereby granted.\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH "
             "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
             "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
             "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
             "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT-notice", "Released under the MIT License."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
]
# These and the forms of whole licences: every head of an id goes with every body.
HEADS, BODIES = license_texts.heads_and_bodies(dict(KNOWN))
HEADS = list(dict.fromkeys(HEADS + [(name, "\n") for name, _ in KNOWN]))
BODIES = list(dict.fromkeys(BODIES + KNOWN))


def lines_of(text: Column) -> Column:
    """Array of the canonical lines: no copyright lines, no blank lines."""
    t = F.regexp_replace(ascii_lower(text), STATEMENTS, "\n")
    for x in FOLLOWING:
        t = F.replace(t, F.lit(x), F.lit("\n" + x))
    t = F.regexp_replace(t, "(?md)" + COPYRIGHT, "")
    t = F.regexp_replace(t, SIGNS, " ")
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.filter(F.transform(F.split(t, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def whole(lines: Column) -> Column:
    """The lines as one text, with the spellings that stood across lines."""
    t = F.array_join(lines, " ")
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b)) if " " in a else t
    return t


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license_id): one row per distinct canonical text, smallest id first."""
    heads = HEADS if known is None else sorted({(name, "") for name, _ in known})
    heads = spark.createDataFrame(heads, "license_id string, head string").select("license_id", lines_of(F.col("head")).alias("_h"))
    df = spark.createDataFrame(BODIES if known is None else known, "license_id string, text string")
    df = df.select("license_id", lines_of(F.col("text")).alias("_b")).join(F.broadcast(heads), "license_id")
    return (df.select("license_id", F.sha2(whole(F.concat("_h", "_b")), 256).alias("digest"))
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def scan(docs: DataFrame, digests: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id, canonical_sha256, license_id of the whole text (or null), line_licenses.

    One pass: every document sends the digest of its whole text and of its
    lines to the hash join; only hits and the whole-text row go on to the
    grouping, which shuffles digests and never texts.
    """
    if digests.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        digests = F.broadcast(digests)
    lines = docs.select(F.col(id_col).alias("_id"), lines_of(F.col(text_col)).alias("_l"))
    units = lines.select(
        "_id", F.sha2(whole(F.col("_l")), 256).alias("canonical_sha256"),
        F.array_distinct(F.transform("_l", lambda x: F.sha2(x, 256))).alias("_d"),
    ).select(
        "_id", "canonical_sha256",
        F.explode(F.concat(
            F.array(F.struct(F.lit(True).alias("all"), F.col("canonical_sha256").alias("digest"))),
            F.coalesce(F.transform("_d", lambda x: F.struct(F.lit(False).alias("all"), x.alias("digest"))),
                       F.array().cast("array<struct<all:boolean,digest:string>>")),
        )).alias("u"),
    ).select("_id", "canonical_sha256", "u.*")
    hits = units.join(digests, "digest", "left").filter(F.col("all") | F.col("license_id").isNotNull())
    per = hits.groupBy("_id", "canonical_sha256").agg(
        F.max(F.when(F.col("all"), F.col("license_id"))).alias("license_id"),
        F.sort_array(F.collect_set(F.when(~F.col("all"), F.col("license_id")))).alias("line_licenses"),
        F.sum(F.col("all").cast("int")).alias("_copies"),
    )
    # rows that repeat an id and a canonical text have equal answers; give each row its own
    return per.select(
        F.col("_id").alias(id_col), "canonical_sha256", "license_id",
        F.array_join("line_licenses", ",").alias("line_licenses"),
        F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))).alias("_c"),
    ).drop("_c")


def op8_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), known_digests(spark))


def _sql_literal(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _sql_rows(rows: list[tuple[str, str]]) -> str:
    return ", ".join(f"({_sql_literal(a)}, {_sql_literal(b)})" for a, b in rows)


def _sql_lines(col: str) -> str:
    t = f"translate({col}, '{UPPER}', '{UPPER.lower()}')"
    t = f"regexp_replace({t}, '{STATEMENTS}', chr(10), 'g')"
    for x in FOLLOWING:
        t = f"replace({t}, '{x}', chr(10) || '{x}')"
    t = f"regexp_replace({t}, '(?m){COPYRIGHT}', '', 'g')"
    t = f"regexp_replace({t}, '{SIGNS}', ' ', 'g')"
    for a, b in SPELLINGS:
        t = f"replace({t}, '{a}', '{b}')"
    return f"list_filter(list_transform(string_split({t}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"


def _sql_whole(lines: str) -> str:
    t = f"array_to_string({lines}, ' ')"
    for a, b in SPELLINGS:
        t = f"replace({t}, '{a}', '{b}')" if " " in a else t
    return t


SQL = f"""
WITH heads AS (
  SELECT license_id, {_sql_lines("head")} AS h FROM (VALUES {_sql_rows(HEADS)}) AS k(license_id, head)
), bodies AS (
  SELECT license_id, {_sql_lines("text")} AS b FROM (VALUES {_sql_rows(BODIES)}) AS k(license_id, text)
), known AS (
  SELECT sha256({_sql_whole("list_concat(h, b)")}) AS digest, min(license_id) AS license_id
  FROM heads JOIN bodies USING (license_id)
  GROUP BY 1
), d AS (
  SELECT row_number() OVER () AS r, doc_id, {_sql_lines("text")} AS l FROM documents
), w AS (
  SELECT r, doc_id, sha256({_sql_whole("l")}) AS canonical_sha256, l FROM d
), lines AS (
  SELECT DISTINCT u.r, k.license_id
  FROM (SELECT r, sha256(unnest(l)) AS digest FROM w) u JOIN known k USING (digest)
), per AS (
  SELECT r, string_agg(license_id, ',' ORDER BY license_id) AS line_licenses FROM lines GROUP BY r
)
SELECT w.doc_id, w.canonical_sha256, k.license_id, coalesce(p.line_licenses, '') AS line_licenses
FROM w LEFT JOIN known k ON k.digest = w.canonical_sha256 LEFT JOIN per p USING (r)
"""
