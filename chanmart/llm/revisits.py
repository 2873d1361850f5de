"""Resolution of not-modified revisit records of a web archive.

A revisit (a 304 answer, or a digest seen before) stands for the latest
earlier full response of the same canonical URL: an as-of join.  A URL may
hold a third of all records, so its records are split into slices of time
(bounds from approximate quantiles of all capture times).  The last response
of each (URL, slice) is one partial aggregate, carried over a URL's at most
``slices`` slices by a window on those aggregates alone; inside a slice a
window finds the last response before each revisit.  Payloads don't move: the
join carries record ids, validators and headers.

The found response counts when its validators agree with the revisit's: equal
entity tags, or equal payload digests, or, where neither record has a tag or
a digest, equal modification times.  Its headers are then merged: the
revisit's win where a 304 answer may change them, length, encoding and range
stay those of the stored response.

Defined cases: "earlier" is strictly earlier; of responses at one time the
largest record id is the latest; a record without URL or readable time is never a
response and stays unresolved as a revisit (``no_response``); NULL validators
never agree; NULL headers are none; repeated rows give repeated results; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chanmart.llm.common import prepare, staged

SLICES = 64
#: Query parameters that name a visit rather than a page.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"
#: Headers that a 304 answer does not change in the stored response.
STORED_ONLY = ("content-length", "content-encoding", "content-range", "transfer-encoding", "content-type")


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, default port, fragment, tracking parameters and closing slashes dropped; host in lower case, parameters sorted."""
    bare = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www[0-9]*\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"^[^?]*\?(.*)$", 1)
    parameters = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    asked = F.when(F.size(parameters) > 0, F.concat(F.lit("?"), F.array_join(parameters, "&"))).otherwise("")
    return F.when(url.isNotNull(), F.concat(host, path, asked))


#: Fixed value: the fourteen digits of an archive's capture time.
FOURTEEN = r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$"


def instant(df: DataFrame, column: str) -> Column:
    """A capture time as microseconds, to be compared.

    Times of any kind, ISO texts and the archive's fourteen digits; without a
    zone they are UTC, whatever the session's.  A text that is no time is
    NULL.  Whole numbers stay as they are, fractions count as seconds.
    """
    value, kind = F.col(column), df.schema[column].dataType.typeName()
    if kind == "timestamp":
        return F.unix_micros(value)
    if kind in ("byte", "short", "integer", "long"):
        return value.cast("long")
    if kind in ("float", "double", "decimal"):
        return F.round(value * 1_000_000).try_cast("long")
    text = F.trim(value.cast("string"))
    text = F.regexp_replace(text, FOURTEEN, "$1-$2-$3T$4:$5:$6")
    return F.unix_micros(F.coalesce(F.concat(text, F.lit("Z")).try_cast("timestamp"), F.concat(text, F.lit("T00:00:00Z")).try_cast("timestamp"), text.try_cast("timestamp")))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """Stored headers with those of the 304 answer that may replace them."""
    empty = F.create_map().cast("map<string,string>")
    fresh = F.map_filter(F.coalesce(fresh, empty), lambda k, v: ~k.isin(*STORED_ONLY))
    stored = F.map_filter(F.coalesce(stored, empty), lambda k, v: ~F.map_contains_key(fresh, k))
    return F.map_concat(stored, fresh)


def agree(revisit: dict[str, Column], response: dict[str, Column]) -> Column:
    both = lambda c: revisit[c].isNotNull() & response[c].isNotNull()
    stronger = both("etag") | both("digest")
    same = lambda c: F.coalesce(revisit[c] == response[c], F.lit(False))
    return F.when(stronger, same("etag") | same("digest")).otherwise(same("last_modified"))


def resolve_revisits(records: DataFrame, slices: int = SLICES) -> DataFrame:
    """Per revisit record: record_id, canonical_url, status, response_id, headers (merged, of resolved ones).

    ``records``: record_id, url, captured_at (see ``instant``), is_revisit,
    etag, digest, last_modified and headers (map); other columns are ignored.
    """
    prepare(records.sparkSession)
    kept = records.select(
        "record_id",
        canonical_url(F.col("url")).alias("url"),
        instant(records, "captured_at").alias("at"),
        F.coalesce("is_revisit", F.lit(False)).alias("is_revisit"),
        *(F.col(c).alias(c) for c in ("etag", "digest", "last_modified", "headers")),
    )
    kept = staged(kept.filter(F.col("is_revisit") | (F.col("url").isNotNull() & F.col("at").isNotNull())), "captures")
    shares = [i / slices for i in range(1, slices)]
    bounds = kept.agg(F.percentile_approx("at", shares, 10_000)).first()[0] or []  # fewer than ``slices``
    number = F.lit(0)
    for b in sorted(set(bounds)):
        number = number + (F.col("at") > F.lit(b)).cast("int")
    events = kept.withColumn("slice", F.when(F.col("at").isNull(), F.lit(-1)).otherwise(number))
    response = F.when(~F.col("is_revisit"), F.struct("at", "record_id", "etag", "digest", "last_modified", "headers"))
    order = F.when(~F.col("is_revisit"), F.struct("at", "record_id"))
    usable = events.filter(F.col("url").isNotNull() & F.col("at").isNotNull())
    last = usable.groupBy("url", "slice").agg(F.max_by(response, order).alias("last"))
    before = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("url", "slice", F.last("last", ignorenulls=True).over(before).alias("carried"))
    inside = Window.partitionBy("url", "slice").orderBy("at", F.desc("is_revisit"), "record_id").rowsBetween(Window.unboundedPreceding, -1)
    seen = events.withColumn("here", F.when(F.col("url").isNotNull() & F.col("at").isNotNull(), F.last(response, ignorenulls=True).over(inside)))
    found = seen.filter("is_revisit").join(carried, ["url", "slice"], "left").withColumn("r", F.coalesce("here", "carried"))
    valid = agree({c: F.col(c) for c in ("etag", "digest", "last_modified")}, {c: F.col(f"r.{c}") for c in ("etag", "digest", "last_modified")})
    status = F.when(F.col("r").isNull(), "no_response").when(valid, "resolved").otherwise("validator_mismatch")
    return found.withColumn("status", status).select(
        "record_id",
        F.col("url").alias("canonical_url"),
        "status",
        F.when(F.col("status") == "resolved", F.col("r.record_id")).alias("response_id"),
        F.when(F.col("status") == "resolved", merged_headers(F.col("r.headers"), F.col("headers"))).alias("headers"),
    )


#: A second crawl asks for every page again so many records later; in between others may have been stored under its URL.
SECOND_CRAWL = 1000


def crawl_records(pages: DataFrame) -> DataFrame:
    """Two crawls of every page: a full response, and later a 304 answer with the first one's entity tag.

    Pages whose markup names an advertisement slot beginning with 7 answer
    with another tag, as if they had changed without the archive noticing.
    """
    tag = F.md5(F.coalesce("html", F.lit("")))
    first = pages.select(
        (F.col("page_id") * 2).alias("record_id"),
        "url",
        F.col("page_id").alias("captured_at"),
        F.lit(False).alias("is_revisit"),
        tag.alias("etag"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"), F.lit("date"), F.col("page_id").cast("string")).alias("headers"),
    )
    again = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        "url",
        (F.col("page_id") + SECOND_CRAWL).alias("captured_at"),
        F.lit(True).alias("is_revisit"),
        F.when(F.col("html").contains("<!-- ad 7"), F.reverse(tag)).otherwise(tag).alias("etag"),
        F.create_map(F.lit("content-length"), F.lit("0"), F.lit("date"), (F.col("page_id") + SECOND_CRAWL).cast("string"), F.lit("cache-control"), F.lit("max-age=60")).alias("headers"),
    )
    none = F.lit(None).cast("string")
    return first.unionByName(again).withColumns({"digest": none, "last_modified": none})


def op7_warc_revisits(spark, sf_dir: str) -> DataFrame:
    records = crawl_records(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    headers = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    found = resolve_revisits(records)
    return found.withColumns({"headers": F.coalesce(headers, F.lit("")), "response_id": F.coalesce("response_id", F.lit(-1).cast("long"))})


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, html, md5(coalesce(html, '')) AS tag, CASE WHEN url IS NOT NULL THEN
    regexp_replace(regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), '^www[0-9]*\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(q) > 0 THEN '?' || array_to_string(list_sort(q), '&') ELSE '' END END AS u
  FROM (SELECT *, list_filter(string_split(regexp_extract(b, '^[^?]*\?(.*)$', 1), '&'),
               lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)')) AS q
        FROM (SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM pages))
), r AS (
  SELECT page_id, u, tag, octet_length(encode(coalesce(html, ''))) AS n FROM p
), v AS (
  SELECT page_id, u, page_id + 1000 AS t, CASE WHEN contains(html, '<!-- ad 7') THEN reverse(tag) ELSE tag END AS tag FROM p
), j AS (
  SELECT v.page_id, v.u, v.t, v.tag, arg_max(r.page_id, r.page_id) AS rp
  FROM v LEFT JOIN r ON v.u = r.u AND r.page_id < v.t GROUP BY ALL
)
SELECT j.page_id * 2 + 1 AS record_id, j.u AS canonical_url,
       CASE WHEN rp IS NULL THEN 'no_response' WHEN j.tag = r.tag THEN 'resolved' ELSE 'validator_mismatch' END AS status,
       CASE WHEN j.tag = r.tag THEN rp * 2 ELSE -1 END AS response_id,
       CASE WHEN j.tag = r.tag THEN 'cache-control=max-age=60;content-length=' || n || ';content-type=text/html;date=' || j.t ELSE '' END AS headers
FROM j LEFT JOIN r ON r.page_id = j.rp
"""
