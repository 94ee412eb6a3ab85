"""Benchmark decontamination (SQL functions only).

Words are runs of digits, letters a-z (after lower-casing A-Z) and any
non-ASCII character.  A benchmark window is 13 consecutive words of an item,
or the whole item if it has fewer (but some).  Every window gets a 64-bit key
of three of its words; the keys are a hash set that is broadcast while it has
at most ``BROADCAST_ROWS`` rows (checked) and joined by shuffle beyond.
Every word position of a document is first looked up by the words that windows
begin with, which gives the lengths to try there; windows of these lengths are
looked up by key and then verified word by word.

A word is hit if it lies in any occurrence of a window; a document is
contaminated if hits are at least a twentieth of its words.  Defined results:
null or wordless texts have no words and are clean; null or wordless items
have no windows; item ids that share a window are all reported; repeated rows
are answered each; empty tables give clean documents or no rows.

One pass over the texts: each document also sends one marker row (position
-1) through the lookups, so clean documents come out of the same grouping.
The grouping shuffles one row per document and one per verified occurrence.
Positions are generated inside the code of the scanning stage, so no row of a
window carries the document's words; beyond the broadcast a row has the words
of its own window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import UPPER, stored, table, whole_row

# ASCII characters that are no part of a word; A-Z are made a-z in the same step.
BETWEEN = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
WINDOW = 13
BROADCAST_ROWS = 500_000
LEAD = 2  # words that a position is first looked up by, or the shortest window's
SHARE = 20  # contaminated: SHARE * n_hit >= n_words


def words(text: Column) -> Column:
    """Array of the words, by one translation and a split at blanks (a pattern takes several times as long)."""
    plain = F.translate(text, UPPER + BETWEEN, UPPER.lower() + " " * len(BETWEEN))
    return F.array_remove(F.split(plain, " "), "")


def _key(w: Column, start: Column, n: Column) -> Column:
    """Key of the window of ``n`` words from ``start``: first, middle and last word."""
    at = lambda k: F.get(w, (start + k).cast("int"))
    return F.xxhash64(n, at(F.lit(0)), at(F.floor(n / 2)), at(n - 1))


def _lead(w: Column, start: Column, n: int) -> Column:
    """Hash of the ``n`` words from ``start``."""
    return F.xxhash64(*[F.get(w, start + k) for k in range(n)])


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """(key, n, window array<string>, items array<id>): one row per distinct window."""
    b = benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    n = F.least(F.size("w"), F.lit(window))
    w = b.filter(F.size("w") > 0).select(
        "item", n.alias("n"), F.explode(F.sequence(F.lit(0), F.size("w") - n)).alias("i"), "w")
    w = w.select("item", "n", F.slice("w", F.col("i") + 1, F.col("n")).alias("window"))
    return (w.groupBy("n", "window").agg(F.collect_set("item").alias("items"))
            .withColumn("key", _key(F.col("window"), F.lit(0), F.col("n"))))


def find(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated, spans array<(pos, n)>, text_md5.

    ``spans`` are word positions of the verified occurrences.
    """
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())  # at most ``window`` numbers
    lead = min([LEAD, *lengths])
    firsts = (windows.select(_lead(F.col("window"), F.lit(0), lead).alias("lead"), "n")
              .groupBy("lead").agg(F.collect_set("n").alias("lens")))
    known = windows.select("key", F.col("n").alias("k"), "window", "items")
    if windows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        firsts, known = F.broadcast(firsts), F.broadcast(known)

    d = docs.select(F.struct(F.col(id_col)).alias("row"), F.coalesce(F.md5(text_col), F.lit("null")).alias("h"),
                    F.coalesce(words(F.col(text_col)), F.array().cast("array<string>")).alias("w"))
    d = d.select("row", "h", "w", F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("pos"))
    # the marker has no lead and no key: it passes the left joins; other rows need a partner
    if firsts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        d = d.withColumn("lead", F.when(F.col("pos") >= 0, _lead(F.col("w"), F.col("pos"), lead)))
        d = d.join(F.broadcast(firsts), "lead", "left").filter("pos < 0 OR lens IS NOT NULL")
        tries = F.coalesce("lens", F.array(F.lit(0)))
    else:
        tries = F.when(F.col("pos") < 0, F.array(F.lit(0))).otherwise(F.array(*[F.lit(n) for n in lengths]))
    d = d.select("row", "h", "w", "pos", F.explode(tries).alias("n"))
    d = d.filter("n = 0 OR pos + n <= size(w)").select(
        "row", "h", "pos", "n", F.when(F.col("pos") < 0, F.size("w")).alias("n_words"),
        F.when(F.col("n") > 0, _key(F.col("w"), F.col("pos"), F.col("n"))).alias("key"),
        F.when(F.col("n") > 0, F.slice("w", F.col("pos") + 1, F.col("n"))).alias("here"))
    d = d.join(known, "key", "left").filter("n = 0 OR (k = n AND here = window)")
    per = d.groupBy("row", "h").agg(
        F.sum(F.when(F.col("pos") < 0, 1).otherwise(0)).alias("copies"),
        F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_set(F.when(F.col("n") > 0, F.struct("pos", "n")))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["pos"] + s["n"] - F.greatest(a["end"], s["pos"]))).alias("n"),
            F.greatest(a["end"], s["pos"] + s["n"]).alias("end")),
        lambda a: a["n"])
    out = per.select(
        "row", "h", F.col("n_words").cast("long").alias("n_words"), covered.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "spans", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_c"))
    bad = (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))
    out = out.withColumn("contaminated", bad).drop("_c")
    return out.select(F.col("row")[id_col].alias(id_col), "n_words", "n_hit", "n_items", "items_sha256",
                      "contaminated", "spans", F.col("h").alias("text_md5"))


def clean(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    bad = stored(find(docs, windows, id_col, text_col).filter("contaminated")
                 .select(F.col(id_col).alias("_id"), F.col("text_md5").alias("_h")).distinct(), "contaminated")
    if bad.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        bad = F.broadcast(bad)
    d = docs.select(whole_row(docs), F.col(id_col).alias("key"), F.md5(text_col).alias("md5"))
    return d.join(bad, F.col("key").eqNullSafe(F.col("_id")) & (F.col("md5") == F.col("_h")), "left_anti").select("row.*")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = benchmark_windows(table(spark, sf_dir, "benchmark"))
    return find(table(spark, sf_dir, "documents"), windows).drop("spans", "text_md5")


SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, unnest(list_transform(generate_series(1, len(w) - least(13, len(w)) + 1),
         lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS g
  FROM bw WHERE len(w) > 0
), lens AS (SELECT DISTINCT n FROM win), dg AS (
  SELECT r, n, unnest(generate_series(1, len(w) - n + 1)) AS p,
         unnest(list_transform(generate_series(1, len(w) - n + 1), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
  FROM dw JOIN lens ON len(w) >= n
), occ AS (
  SELECT dg.r, dg.p, dg.n, win.item_id FROM dg JOIN win ON dg.g = win.g AND dg.n = win.n
), hit AS (
  SELECT r, count(DISTINCT q) AS n_hit
  FROM (SELECT r, unnest(generate_series(p, p + n - 1)) AS q FROM (SELECT DISTINCT r, p, n FROM occ)) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY r
)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""
