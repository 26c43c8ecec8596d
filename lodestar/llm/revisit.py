"""WARC not-modified revisits (operator 3): an as-of join by canonical URL.

A revisit takes the latest full response of its canonical URL that is strictly
earlier, if the validators agree; permitted headers of the 304 replace the stored
ones.  The join is a two-level prefix scan: rows are first reduced to one per (url,
time), time is cut into buckets of equal row counts over all urls, a window finds the
latest response within each (url, bucket), and a second window over bucket summaries carries it
onwards.  No task ever holds one url's whole history, however hot the url is.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import cut, shuffle_width

#: Header fields of a 304 that replace the stored response's (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary", "last-modified")
_HEADERS = "map<string,string>"


def canonical_url(url: Column) -> Column:
    """Without scheme, fragment, a leading ``www.`` or ``m.``, the default port, tracking
    parameters (``utm_*``) and trailing slashes of the path; host A-Z lower-cased; parameters
    sorted.  Null stays null; a text without ``://`` is taken as it is."""
    bare = F.regexp_replace(F.regexp_replace(url, r"(?s)^[^:/?#]*://", ""), r"(?s)#.*$", "")
    host = F.regexp_extract(bare, r"(?s)^[^/?]*", 0)
    path = F.regexp_replace(F.regexp_extract(bare, r"(?s)^[^/?]*([^?]*)", 1), r"/+$", "")
    low = F.regexp_replace(F.regexp_replace(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"^(www|m)\.", ""), r":(80|443)$", "")
    params = F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"(?s)^[^?]*\?(.*)$", 1), "&"), lambda x: (x != "") & ~x.startswith("utm_")))
    return F.when(F.instr(url, "://") > 0, F.concat(low, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))).otherwise(url)


def _entries(headers: Column) -> Column:
    """A header map as a sorted array of (name, value), names lower-cased, of equal names the greatest value."""
    low = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("name"), F.coalesce(e["value"], F.lit("")).alias("value")))
    rows = F.array_sort(low)
    kept = F.filter(rows, lambda e, i: (i == F.size(rows) - 1) | (F.get(rows, i + 1)["name"] != e["name"]))
    return F.coalesce(kept, F.array().cast("array<struct<name:string,value:string>>"))


def _value(entries: Column, name: str) -> Column:
    return F.get(F.filter(entries, lambda e: e["name"] == name), F.lit(0))["value"]


def merge_headers(stored: Column, fresh: Column, permitted=PERMITTED) -> Column:
    """Stored entries, those of permitted names replaced by or added from the 304's."""
    new = F.filter(fresh, lambda e: e["name"].isin(*permitted))
    old = F.filter(stored, lambda e: ~F.exists(new, lambda x: x["name"] == e["name"]))
    return F.array_sort(F.concat(old, new))


def _weak(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def validators(stored: Column, fresh: Column) -> Column:
    """``match`` or ``mismatch`` by ETag (weak comparison) if both have one, else by
    Last-Modified if both have it, else ``unverified``."""
    a, b = _value(stored, "etag"), _value(fresh, "etag")
    c, d = _value(stored, "last-modified"), _value(fresh, "last-modified")
    same = F.when(a.isNotNull() & b.isNotNull(), _weak(a) == _weak(b)).when(c.isNotNull() & d.isNotNull(), c == d)
    return F.when(same.isNull(), "unverified").when(same, "match").otherwise("mismatch")


def latest_before(keys: DataFrame, buckets: int) -> DataFrame:
    """(url, ts, full) with one row per (url, ts) -> (url, ts, found): the greatest
    ``full`` struct of the latest earlier ts of that url that has one."""
    edges = keys.agg(F.percentile_approx("ts", [k / buckets for k in range(1, buckets)], 20 * buckets)).first()[0] or []
    splits = [-float("inf"), *sorted({float(x) for x in edges}), float("inf")]
    if len(splits) > 2:
        cut_up = Bucketizer(splits=splits, inputCol="at", outputCol="bucket").transform(keys.withColumn("at", F.col("ts").cast("double")))
    else:
        cut_up = keys.withColumn("bucket", F.lit(0.0))
    state = F.when(F.col("full").isNotNull(), F.struct("ts", "full"))
    near = Window.partitionBy("url", "bucket").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    inside = cut_up.select("url", "ts", "bucket", F.max(state).over(near).alias("near"))
    ends = cut_up.groupBy("url", "bucket").agg(F.max(state).alias("last"))
    carried = ends.select("url", "bucket", F.max("last").over(
        Window.partitionBy("url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)).alias("far"))
    return inside.join(carried, ["url", "bucket"]).select("url", "ts", F.coalesce("near", "far").alias("found"))


def resolve(records: DataFrame, id_col: str = "record_id", url_col: str = "url", ts_col: str = "ts", kind_col: str = "kind",
            digest_col: str = "digest", headers_col: str = "headers", permitted=PERMITTED) -> DataFrame:
    """One row per revisit: record_id, url (canonical), ts, status, response_id, response_ts,
    digest, headers (array of name, value).

    ``kind`` is ``response`` (full) or ``revisit``; other kinds are left out.  ``status``:
    ``resolved`` (validators agree), ``unverified`` (no common validator; resolved all the
    same), ``mismatch`` or ``orphan`` (no earlier response, or a null url or time); the last two have no
    digest and keep the revisit's own headers.  Of several responses at one time the greatest record id (then digest,
    headers) counts; a response at the revisit's own time is not earlier.  Repeated revisits are all returned.
    """
    rows = records.select(F.col(id_col).alias("record_id"), canonical_url(F.col(url_col)).alias("url"), F.col(ts_col).cast("long").alias("ts"),
                          F.col(kind_col).alias("kind"), F.col(digest_col).alias("digest"), _entries(F.col(headers_col).cast(_HEADERS)).alias("entries"))
    rows = rows.where(F.col("kind").isin("response", "revisit"))
    full = F.when(F.col("kind") == "response", F.struct("record_id", "digest", "entries"))
    keys = cut(rows.where("url is not null and ts is not null").groupBy("url", "ts").agg(F.max(full).alias("full")))
    found = cut(latest_before(keys, 4 * shuffle_width(records.sparkSession)).where("found is not null"))
    out = rows.where("kind = 'revisit'").join(found, ["url", "ts"], "left")
    seen = validators(F.col("found.full.entries"), F.col("entries"))
    out = out.withColumn("status", F.when(F.col("found").isNull(), "orphan").when(seen == "match", "resolved").otherwise(seen))
    done = F.col("status").isin("resolved", "unverified")
    return out.select(
        "record_id", "url", "ts", "status", F.col("found.full.record_id").alias("response_id"), F.col("found.ts").alias("response_ts"),
        F.when(done, F.col("found.full.digest")).alias("digest"),
        F.when(done, merge_headers(F.col("found.full.entries"), F.col("entries"), permitted)).otherwise(F.col("entries")).alias("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """WARC records made from ``pages``: each page is a full response and a later 304.

    Response 2p of page p at time 10p; revisit 2p + 1 at a time that depends on the url's
    length, sometimes before the response.  The 304 names the page's ETag, only its
    Last-Modified, or neither.
    """
    n = F.coalesce(F.length("url"), F.lit(0))
    md5 = F.md5(F.coalesce("html", F.lit("")))
    tag, modified = F.concat(F.lit('"'), F.substring(md5, 1, 16), F.lit('"')), F.concat(F.lit("day "), F.length(F.coalesce("html", F.lit(""))))
    page = F.col("page_id")
    response = F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Date"), (10 * page).cast("string"),
                            F.lit("ETag"), tag, F.lit("Last-Modified"), modified)
    later = 10 * page + F.when(n % 11 == 0, -5).otherwise(10 * (n * 97 % 500) + 5)
    always = F.create_map(F.lit("Date"), later.cast("string"), F.lit("Content-Length"), F.lit("0"), F.lit("Expires"), F.concat(F.lit("t"), later))
    revisit = F.when(n % 5 == 0, F.map_concat(always, F.create_map(F.lit("Last-Modified"), modified))).when(
        n % 5 == 1, always).otherwise(F.map_concat(always, F.create_map(F.lit("ETag"), F.concat(F.lit("W/"), tag))))
    both = F.array(
        F.struct((2 * page).alias("record_id"), (10 * page).alias("ts"), F.lit("response").alias("kind"), md5.alias("digest"), response.alias("headers")),
        F.struct((2 * page + 1).alias("record_id"), later.alias("ts"), F.lit("revisit").alias("kind"), F.lit(None).cast("string").alias("digest"), revisit.alias("headers")))
    return pages.select("url", F.explode(both).alias("r")).select("url", "r.*")
