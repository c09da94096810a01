"""Not-modified revisit records of a web archive, resolved to the full response that they stand for.

A revisit (status 304) says that a page hasn't changed. It stands for the latest full response (status 200) of the same
canonical URL with an earlier time. It is resolved only if its validators agree: the entity tags where both sides have one
(compared weakly), else the modification dates where both have one. Headers that a 304 response may update replace those of
the response; all others stay.

The as-of join is a running maximum per URL, cut into segments of ``SEGMENT`` time units so that a URL with a large share
of all captures is dealt to many tasks: within a segment a window finds the latest response, and the last responses of
earlier segments, one row each, are carried over.

Captures with a NULL URL, time or status match nothing: such a revisit is returned unresolved. Of responses at one time the one
with the greatest capture id counts. Repeated revisits are each resolved. Empty tables give no rows; headers are compared by
lower-case name; other columns are left aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEGMENT = 4096
UPDATED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
HEADERS = "array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` or default port, https, no fragment, tracking parameters or final slash."""
    out = F.regexp_replace(url, "#.*$", "")
    out = F.regexp_replace(out, "([?&])(?:utm_[A-Za-z]+|ref)=[^&]*", "$1")
    out = F.regexp_replace(F.regexp_replace(out, "([?&])&+", "$1"), "[?&]+$", "")
    host = F.lower(F.regexp_extract(out, "^([A-Za-z]+://[^/?]*)", 1))
    rest = F.substring(out, F.length(host) + 1, F.length(out))
    host = F.regexp_replace(F.regexp_replace(host, "^http://(?:www\\.)?|^https://(?:www\\.)?", "https://"), ":(?:80|443)$", "")
    # A slash at the end of a query is part of a value.
    return F.regexp_replace(F.concat(host, rest), "^([^?]*?)/+$", "$1")


def header(headers: str, name: str) -> Column:
    """The first value of a header, NULL where it isn't there."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]


def resolved(captures: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per revisit: the response that it stands for, whether its validators agree, and the merged headers.

    ``captures`` has capture_id long, url string, time long, status int and headers (an array of name and value).
    """
    rows = captures.select(
        F.col("capture_id").cast("long").alias("capture_id"), "url", F.col("time").cast("long").alias("time"), "status",
        F.col("headers").cast(HEADERS).alias("headers"), canonical_url(F.col("url")).alias("canonical"))
    usable = F.col("canonical").isNotNull() & F.col("time").isNotNull()
    rows = rows.withColumn("segment", F.floor(F.col("time") / segment))
    response = F.when((F.col("status") == 200) & usable, F.struct("time", "capture_id", "headers"))
    # Rows without a URL or time would meet under one NULL key: they are dealt apart by their id and match nothing.
    rows = rows.withColumn("response", response).withColumn("apart", F.when(~usable, F.xxhash64("capture_id", "url", "time")))
    last = rows.where("response is not null").groupBy("canonical", "segment").agg(F.max("response").alias("last"))
    # A row per segment that has captures of the URL; each gets the last response of those before it.
    marks = rows.where(usable).select("canonical", "segment").distinct().join(last, ["canonical", "segment"], "left")
    before = Window.partitionBy("canonical").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.select("canonical", "segment", F.last("last", ignorenulls=True).over(before).alias("carried"))
    earlier = Window.partitionBy("canonical", "segment", "apart").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn("inner", F.max("response").over(earlier)).where("status = 304")
    found = found.join(carried, ["canonical", "segment"], "left").withColumn("full", F.coalesce("inner", "carried"))
    weak = lambda tag: F.regexp_replace(tag, "^W/", "")
    found = found.select(
        "capture_id", "url", "canonical", "time", "headers", F.col("full.capture_id").alias("response_id"),
        F.col("full.time").alias("response_time"), F.col("full.headers").alias("full_headers"))
    found = found.withColumn("tag", weak(header("headers", "etag"))).withColumn("full_tag", weak(header("full_headers", "etag")))
    date, full_date = header("headers", "last-modified"), header("full_headers", "last-modified")
    agree = (
        F.when(F.col("response_id").isNull(), F.lit(False))
        .when(F.col("tag").isNotNull() & F.col("full_tag").isNotNull(), F.col("tag") == F.col("full_tag"))
        .otherwise(F.coalesce(date == full_date, F.lit(False))))
    found = found.withColumn("resolved", agree)
    update = F.filter(F.col("headers"), lambda h: F.lower(h["name"]).isin(UPDATED))
    names = F.transform(update, lambda h: F.lower(h["name"]))
    kept = F.filter(F.col("full_headers"), lambda h: ~F.array_contains(names, F.lower(h["name"])))
    return found.withColumn("merged_headers", F.when(F.col("resolved"), F.concat(kept, F.coalesce(update, F.array().cast(HEADERS))))).drop(
        "tag", "full_tag", "full_headers", "headers")


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Captures that follow from the pages: the page's own response, and a later not-modified answer.

    The revisit of every seventh page has another entity tag, that of every eleventh none (its date decides), and that of every
    fifth is asked under another spelling of the URL.
    """
    page = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5(F.coalesce(F.col("html"), F.lit("")).cast("binary")), F.lit('"'))
    entry = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (page % 300).cast("int")), "yyyy-MM-dd")
    response = pages.select(
        (page * 2).alias("capture_id"), "url", (page * 10).alias("time"), F.lit(200).alias("status"),
        F.array(entry("Content-Type", F.lit("text/html")), entry("ETag", tag), entry("Last-Modified", day),
                entry("Content-Length", F.length("html").cast("string")), entry("Cache-Control", F.lit("max-age=60"))).alias("headers"))
    revisit = pages.select(
        (page * 2 + 1).alias("capture_id"),
        F.when(page % 5 == 0, F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again"))).otherwise(F.col("url")).alias("url"),
        (page * 10 + 5 + (page * 7919) % 100_000).alias("time"), F.lit(304).alias("status"),
        F.filter(F.array(
            F.when(page % 11 != 0, entry("ETag", F.when(page % 7 == 0, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), tag)))),
            entry("Last-Modified", day), entry("Cache-Control", F.concat(F.lit("max-age="), (page % 100).cast("string"))),
            entry("Content-Length", F.lit("0"))), lambda h: h.isNotNull()).alias("headers"))
    return response.unionByName(revisit)


def op4_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolve the revisits that follow from all pages."""
    from roompulse.llm.storage import table

    found = resolved(captures_of_pages(table(spark, sf_dir, "pages")))
    text = F.array_join(F.array_sort(F.transform("merged_headers", lambda h: F.concat(F.lower(h["name"]), F.lit("="), h["value"]))), ";")
    return found.select("capture_id", "canonical", "time", "response_id", "response_time", "resolved",
                        F.coalesce(text, F.lit("")).alias("merged"))


OP4_SQL = r"""
WITH c AS (
  SELECT 2 * page_id AS capture_id, page_id * 10 AS time, url, 200 AS status, '"' || md5(html) || '"' AS tag,
         strftime(DATE '2024-01-01' + CAST(page_id % 300 AS INTEGER), '%Y-%m-%d') AS day, CAST(length(html) AS VARCHAR) AS size,
         'max-age=60' AS cache FROM pages
  UNION ALL
  SELECT 2 * page_id + 1, page_id * 10 + 5 + (page_id * 7919) % 100000,
         CASE WHEN page_id % 5 = 0 THEN regexp_replace(url, '#.*$', '') || '#again' ELSE url END, 304,
         CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '"changed"' ELSE '"' || md5(html) || '"' END,
         strftime(DATE '2024-01-01' + CAST(page_id % 300 AS INTEGER), '%Y-%m-%d'), '0', 'max-age=' || page_id % 100 FROM pages
), k AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''),
    '([?&])(?:utm_[A-Za-z]+|ref)=[^&]*', '\1', 'g'), '([?&])&+', '\1', 'g'), '[?&]+$', ''), '^https?://(www\.)?', 'https://') AS plain FROM c
), q AS (SELECT *, regexp_replace(plain, '^([^?]*?)/+$', '\1') AS canonical FROM k),
m AS (
  SELECT r.*, f.capture_id AS response_id, f.time AS response_time, f.tag AS full_tag, f.day AS full_day, f.size AS full_size
  FROM (SELECT * FROM q WHERE status = 304) r
  ASOF LEFT JOIN (SELECT * FROM q WHERE status = 200) f ON r.canonical = f.canonical AND r.time > f.time
), v AS (
  SELECT *, CASE WHEN response_id IS NULL THEN false WHEN tag IS NOT NULL THEN tag = full_tag ELSE day = full_day END AS resolved FROM m
)
SELECT capture_id, canonical, time, response_id, response_time, resolved,
       CASE WHEN resolved THEN 'cache-control=' || cache || ';content-length=' || full_size || ';content-type=text/html;etag='
         || CASE WHEN tag IS NULL THEN full_tag ELSE 'W/' || tag END || ';last-modified=' || day ELSE '' END AS merged
FROM v
"""
