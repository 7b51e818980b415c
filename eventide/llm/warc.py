"""Not-modified revisits: as-of join by canonical URL to the latest earlier full response.

A capture has a record id, URL, time, status and headers (a map with
lower-case names). A revisit is a capture with status 304; a full response one
with status 200. A revisit takes the latest full response of its canonical URL
with a smaller time (of equal times the one with the largest record id). Its
validators must agree with that response: a strong entity tag must be equal, a
weak one equal up to the weakness mark, and without a tag the last-modified
dates must be equal; a revisit without any validator is accepted. An accepted
revisit gets the response's headers, replaced by its own except for the fixed
ones that a 304 must not change. Otherwise the outcome says why.

The join is a running maximum in two steps, so a URL holding a third of all
captures is not one task: within (URL, time bucket), then over one row per
(URL, bucket) that carries the last response of the buckets before.

Captures without URL, time or record id match nothing. Null headers are empty.
Repeated rows are resolved each on their own. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of a time bucket, in the unit of the time column.
BUCKET = 50_000
# Headers of a stored response that a 304 does not replace.
KEPT = ["connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
        "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade"]
# Fixed value: query parameters that do not tell pages apart.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"
RESOLVED, MISMATCH, MISSING = "resolved", "validator_mismatch", "no_earlier_response"


def canonical_url(url: Column) -> Column:
    """Host, path and sorted query: no scheme, user, default port, ``www.``, fragment, last slash or tracking."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1), r"/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&"),
                                  lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(host != "", F.concat(host, path, F.when(F.size(query) > 0, F.concat(
        F.lit("?"), F.array_join(query, "&"))).otherwise("")))


def _validators_agree() -> Column:
    own, stored = F.col("headers"), F.col("found.headers")
    tag, other = own["etag"], stored["etag"]
    date, other_date = own["last-modified"], stored["last-modified"]
    strong = ~tag.startswith("W/")
    same_tag = F.when(strong, tag == other).otherwise(
        F.regexp_replace(tag, "^W/", "") == F.regexp_replace(other, "^W/", ""))
    return F.when(tag.isNotNull(), F.coalesce(same_tag, F.lit(False))).when(
        date.isNotNull(), F.coalesce(date == other_date, F.lit(False))).otherwise(F.lit(True))


def resolve(captures: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Revisits of ``captures`` (record_id, url, time, status, headers) with their outcome.

    Returns record_id, url_key, time, response_id (null if none was found),
    outcome and the merged headers (null unless resolved).
    """
    c = captures.select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), F.col("time").cast("long").alias("time"), "status",
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"))
    entries = F.array_sort(F.map_entries("headers"))
    full = F.when((F.col("status") == 200) & F.col("record_id").isNotNull() & F.col("time").isNotNull(),
                  F.struct("time", "record_id", entries.alias("entries")))
    c = c.where("status in (200, 304)").withColumn("full", full).withColumn("bucket", F.floor(F.col("time") / bucket))
    known = c.where("url_key is not null and time is not null")
    inside = Window.partitionBy("url_key", "bucket").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    near = known.withColumn("near", F.max("full").over(inside)).where("status = 304").drop("full")
    last = known.where("full is not null").groupBy("url_key", "bucket").agg(F.max("full").alias("full"))
    marks = last.unionByName(near.select("url_key", "bucket").distinct().withColumn("full", F.lit(None).cast(
        last.schema["full"].dataType)))
    marks = marks.groupBy("url_key", "bucket").agg(F.max("full").alias("full"))
    before = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.select("url_key", "bucket", F.max("full").over(before).alias("far"))
    joined = near.join(marks, ["url_key", "bucket"]).withColumn("hit", F.coalesce("near", "far")).drop("near", "far")
    lost = c.where("status = 304 and (url_key is null or time is null)").drop("full").withColumn(
        "hit", F.lit(None).cast(last.schema["full"].dataType))
    found = joined.unionByName(lost).withColumn("found", F.when(F.col("hit").isNotNull(), F.struct(
        F.col("hit.record_id").alias("record_id"), F.map_from_entries("hit.entries").alias("headers"))))
    kept = F.array(*[F.lit(h) for h in KEPT])
    merged = F.map_concat(
        F.map_filter("found.headers", lambda k, v: F.array_contains(kept, k) | ~F.map_contains_key("headers", k)),
        F.map_filter("headers", lambda k, v: ~F.array_contains(kept, k)))
    outcome = F.when(F.col("found").isNull(), MISSING).when(_validators_agree(), RESOLVED).otherwise(MISMATCH)
    return found.withColumn("outcome", outcome).select(
        "record_id", "url_key", "time", F.col("found.record_id").alias("response_id"), "outcome",
        F.when(F.col("outcome") == RESOLVED, merged).alias("headers"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Captures over ``pages``: each page's full response, and a later fetch of the same URL answered by 304.

    The response is at time 10 * page_id with the page's digest as its tag.
    The 304 comes 5 later; every seventh page has changed by then (another
    tag), every seventh other was asked for before (5 earlier), every third
    sends a date instead of a tag. Pages without html have no response.
    """
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    date = F.concat(F.lit("day "), (F.col("page_id") % 365).cast("string"))
    response = pages.where("html is not null").select(
        (F.col("page_id") * 2).alias("record_id"), "url", (F.col("page_id") * 10).alias("time"), F.lit(200).alias("status"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("content-length"),
                     F.octet_length("html").cast("string"), F.lit("etag"), tag, F.lit("last-modified"), date,
                     F.lit("cache-control"), F.lit("max-age=60")).alias("headers"))
    turn = F.col("page_id") % 7
    own_tag = F.when(turn == 3, F.lit('"changed"')).otherwise(F.coalesce(tag, F.lit('"none"')))
    revisit = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url",
        (F.col("page_id") * 10 + F.when(turn == 5, -5).otherwise(5)).alias("time"), F.lit(304).alias("status"),
        F.when(F.col("page_id") % 3 == 0, F.create_map(F.lit("last-modified"), date, F.lit("content-length"), F.lit("0")))
        .otherwise(F.create_map(F.lit("etag"), own_tag, F.lit("cache-control"), F.lit("max-age=600"),
                                F.lit("content-length"), F.lit("0"))).alias("headers"))
    return response.unionByName(revisit)


def header_text(headers: str) -> Column:
    """Headers as sorted ``name: value`` lines."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)),
                                    lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


ORACLE = r"""
WITH p AS (
  SELECT page_id, url, html, '"' || md5(html) || '"' AS tag, 'day ' || (page_id % 365) AS day,
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)),
      '^.*@', ''), ':(80|443)$', ''), '^www\.', '') AS host,
    regexp_replace(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS query
  FROM pages),
k AS (
  SELECT *, CASE WHEN host <> '' THEN host || path || CASE WHEN len(query) > 0
    THEN '?' || array_to_string(query, '&') ELSE '' END END AS url_key FROM p),
f AS (SELECT page_id * 2 AS rid, url_key, page_id * 10 AS time, tag, day, octet_length(encode(html)) AS size
  FROM k WHERE html IS NOT NULL),
r AS (
  SELECT page_id * 2 + 1 AS record_id, url_key, page_id * 10 + CASE WHEN page_id % 7 = 5 THEN -5 ELSE 5 END AS time,
    CASE WHEN page_id % 3 <> 0 THEN CASE WHEN page_id % 7 = 3 THEN '"changed"' ELSE coalesce(tag, '"none"') END END AS rtag,
    CASE WHEN page_id % 3 = 0 THEN day END AS rday
  FROM k),
j AS (
  SELECT r.*, f.rid, f.tag, f.day, f.size,
    row_number() OVER (PARTITION BY record_id ORDER BY f.time DESC NULLS LAST, f.rid DESC) AS n
  FROM r LEFT JOIN f ON f.url_key = r.url_key AND f.time < r.time),
o AS (
  SELECT *, CASE WHEN rid IS NULL THEN 'no_earlier_response'
    WHEN rtag IS NOT NULL AND rtag = tag THEN 'resolved'
    WHEN rtag IS NULL AND rday = day THEN 'resolved' ELSE 'validator_mismatch' END AS outcome
  FROM j WHERE n = 1)
SELECT record_id, url_key, rid AS response_id, outcome,
  CASE WHEN outcome = 'resolved' THEN
    'cache-control: ' || CASE WHEN rtag IS NOT NULL THEN 'max-age=600' ELSE 'max-age=60' END || chr(10)
    || 'content-length: ' || size || chr(10) || 'content-type: text/html' || chr(10)
    || 'etag: ' || coalesce(rtag, tag) || chr(10) || 'last-modified: ' || coalesce(rday, day) END AS headers
FROM o
"""
