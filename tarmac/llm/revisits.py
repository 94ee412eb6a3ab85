"""WARC not-modified revisits resolved to the full response they repeat.

Records: (record_id long, url string, ts long, kind 'response' | 'revisit',
etag, last_modified, digest strings, headers map<string,string>).  A revisit
is as-of joined, by canonical URL, to the latest *earlier* full response;
then its validators are checked, and the response's headers are updated with
those that a 304 may update.

Status: ``resolved`` (the strongest validator that both hold agrees: digest,
else entity tag compared weakly, else last-modified), ``mismatch`` (it
differs), ``unverified`` (they have none in common), ``no_response`` (nothing
earlier at that URL).  Only resolved revisits get headers.  A response at the
revisit's own time is not earlier.  Among responses of one time the largest
record_id counts as latest.  Rows with a null URL, time or kind take no part;
repeated revisits are answered each.  Empty tables give empty results.

The join is two-level, so a URL that holds a third of all rows is not one
task: time is cut into equal slices, the same for all URLs; inside a (URL,
slice) a window carries the last response, and one row per (URL, slice)
carries it to later slices.  Bodies never move; a record is a reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import table

# Header fields that a 304 response may update.
UPDATABLE = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
# Query parameters that do not change the page.
TRACKING = r"(?:utm_[a-z]+|ref|gclid|fbclid)"
ROWS_PER_SLICE = 20_000


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, default port, fragment, tracking parameters and a closing slash go; the host is lower case."""
    u = F.regexp_replace(url, r"#.*$", "")
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    u = F.regexp_replace(u, rf"([?&]){TRACKING}=[^&]*", r"$1")
    u = F.regexp_replace(F.regexp_replace(u, r"&+", "&"), r"[?]&", "?")
    u = F.regexp_replace(u, r"[?&/]+$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(u, r"^[^/?]*", 0)), r"^www\.|:(80|443)$", "")
    return F.concat(host, F.regexp_replace(u, r"^[^/?]*", ""))


def _slices(records: DataFrame, rows_per_slice: int) -> tuple[int, int]:
    lo, hi, n = records.agg(F.min("ts"), F.max("ts"), F.count(F.lit(1))).first()
    if not n:
        return 0, 1
    return lo, max(1, -(-(hi - lo + 1) // max(1, -(-n // rows_per_slice))))


def resolve(records: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """One row per revisit: record_id, canonical_url, ts, status, response_id, headers."""
    r = records.filter("url IS NOT NULL AND ts IS NOT NULL AND kind IN ('response', 'revisit')").select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), F.col("ts").cast("long").alias("ts"),
        "kind", "etag", "last_modified", "digest", "headers")
    lo, width = _slices(r, rows_per_slice)
    full = F.when(F.col("kind") == "response",
                  F.struct("ts", "record_id", "etag", "last_modified", "digest", "headers"))
    r = r.withColumn("slice", F.floor((F.col("ts") - lo) / width)).withColumn("full", full)

    inside = (Window.partitionBy("canonical_url", "slice")
              .orderBy("ts", (F.col("kind") == "response").cast("int"), "record_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    earlier = Window.partitionBy("canonical_url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        r.groupBy("canonical_url", "slice")
        .agg(F.max_by("full", F.when(F.col("full").isNotNull(), F.struct("ts", "record_id"))).alias("final"))
        .select("canonical_url", "slice", F.last("final", ignorenulls=True).over(earlier).alias("carried"))
    )
    out = (
        r.withColumn("near", F.last("full", ignorenulls=True).over(inside))
        .filter("kind = 'revisit'")
        .join(carried, ["canonical_url", "slice"])
        .withColumn("res", F.coalesce("near", "carried"))
    )
    weak = lambda c: F.regexp_replace(c, r"^W/", "")
    agree = F.coalesce(F.col("digest") == F.col("res.digest"),
                       weak(F.col("etag")) == weak(F.col("res.etag")),
                       F.col("last_modified") == F.col("res.last_modified"))
    status = (F.when(F.col("res").isNull(), "no_response").when(agree, "resolved")
              .when(agree.isNull(), "unverified").otherwise("mismatch"))
    none = F.create_map().cast("map<string,string>")
    old, new = F.coalesce("res.headers", none), F.coalesce("headers", none)
    fresh = F.map_filter(new, lambda k, v: F.lower(k).isin(UPDATABLE) & v.isNotNull())
    names = F.transform(F.map_keys(fresh), F.lower)
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(names, F.lower(k))), fresh)
    return out.select(
        "record_id", "canonical_url", "ts", status.alias("status"), F.col("res.record_id").alias("response_id"),
        F.when(status == "resolved", merged).alias("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """Capture records derived from ``pages``: per page a response and two later revisits at its site's front page.

    Times interleave with other pages of the same site, so some revisits meet
    a response newer than the one they repeat.
    """
    tag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 12), F.lit('"'))
    site = F.regexp_extract("url", r"^(?:[A-Za-z]+://)?[^/?#]+", 0)
    seed = F.col("page_id") * 7919 % 1009
    date = lambda ts: F.concat(F.lit("t"), ts.cast("string"))
    p = pages.filter("page_id IS NOT NULL AND url IS NOT NULL").select(
        "page_id", site.alias("site"), tag.alias("tag"), seed.alias("seed"))
    t0 = F.col("page_id") * 10
    t1, t2 = t0 + 1 + F.col("seed") % 7, t0 + 10 + F.col("seed") % 400
    rows = F.array(
        F.struct((F.col("page_id") * 3).alias("record_id"), F.concat("site", F.lit("/?utm_source=feed")).alias("url"),
                 t0.alias("ts"), F.lit("response").alias("kind"), F.col("tag").alias("etag"),
                 F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), F.col("tag"),
                              F.lit("Date"), date(t0)).alias("headers")),
        F.struct((F.col("page_id") * 3 + 1).alias("record_id"), F.concat("site", F.lit("/#top")).alias("url"),
                 t1.alias("ts"), F.lit("revisit").alias("kind"), F.concat(F.lit("W/"), "tag").alias("etag"),
                 F.create_map(F.lit("content-type"), F.lit("text/plain"), F.lit("date"), date(t1)).alias("headers")),
        F.struct((F.col("page_id") * 3 + 2).alias("record_id"), F.col("site").alias("url"),
                 t2.alias("ts"), F.lit("revisit").alias("kind"),
                 F.when(F.col("seed") % 5 != 0, F.col("tag")).alias("etag"),
                 F.create_map(F.lit("date"), date(t2)).alias("headers")),
    )
    none = F.lit(None).cast("string")
    return p.select(F.explode(rows).alias("r")).select(
        "r.*", none.alias("last_modified"), none.alias("digest"))


def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = lambda h: F.array_join(F.array_sort(F.transform(
        F.map_entries(h), lambda e: F.concat(F.lower(e["key"]), F.lit("="), e["value"]))), ";")
    return resolve(captures(table(spark, sf_dir, "pages"))).withColumn("headers", flat(F.col("headers")))


SQL = r"""
WITH p AS (
  SELECT page_id, regexp_extract(url, '^(?:[A-Za-z]+://)?[^/?#]+') AS site,
         '"' || substr(md5(html), 1, 12) || '"' AS tag, page_id * 7919 % 1009 AS seed
  FROM pages WHERE page_id IS NOT NULL AND url IS NOT NULL
), s AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_replace(site, '^[A-Za-z]+://', '')),
                           '^www[.]', ''), ':(80|443)$', '') AS canonical_url FROM p
), resp AS (
  SELECT page_id * 3 AS response_id, canonical_url, page_id * 10 AS at, tag FROM s
), rev AS (
  SELECT page_id * 3 + 1 AS record_id, canonical_url, page_id * 10 + 1 + seed % 7 AS ts, tag FROM s
  UNION ALL
  SELECT page_id * 3 + 2, canonical_url, page_id * 10 + 10 + seed % 400,
         CASE WHEN seed % 5 <> 0 THEN tag END FROM s
), j AS (
  SELECT v.record_id, v.canonical_url, v.ts, r.response_id, r.tag AS have,
         CASE WHEN r.response_id IS NULL THEN 'no_response' WHEN v.tag IS NULL OR r.tag IS NULL THEN 'unverified'
              WHEN v.tag = r.tag THEN 'resolved' ELSE 'mismatch' END AS status
  FROM rev v ASOF LEFT JOIN resp r ON v.canonical_url = r.canonical_url AND v.ts > r.at
)
SELECT record_id, canonical_url, ts, status, response_id,
       CASE WHEN status = 'resolved' THEN 'content-type=text/html;date=t' || ts || ';etag=' || have END AS headers
FROM j
"""
