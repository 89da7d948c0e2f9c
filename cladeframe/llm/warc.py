"""Not-modified revisit resolution: an as-of join by canonical URL (operator 7).

A revisit takes the latest earlier full response of its canonical URL, if its validators
agree, and that response's headers under those that a 304 may renew. Records are ordered
by (URL, time) in range partitions, which split a hot URL by time. Within a partition a
window carries the last response on; the last response of each URL and partition, at most
one row per partition, is carried over to the partitions after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeframe.session import read_table, stage

# The header fields that a 304 response renews (RFC 9110, 15.4.5, and Age).
RENEWED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def unescaped(text: Column) -> Column:
    """Percent escapes of unreserved characters (RFC 3986, 2.3) as these; others in capitals."""
    pieces = F.split(text, "%", -1)

    def piece(x: Column, i: Column) -> Column:
        code = F.upper(F.substring(x, 1, 2))
        letter = F.chr(F.conv(code, 16, 10).cast("int"))
        read = F.when(letter.rlike("^[A-Za-z0-9._~-]$"), letter).otherwise(F.concat(F.lit("%"), code))
        own = F.when(x.rlike("^[0-9A-Fa-f]{2}"), F.concat(read, F.substring(x, 3, 1 << 30))).otherwise(F.concat(F.lit("%"), x))
        return F.when(i == 0, x).otherwise(own)

    return F.when(F.contains(text, F.lit("%")), F.array_join(F.transform(pieces, piece), "")).otherwise(text)


def canonical_url(url: Column) -> Column:
    """Host in lower case and the rest, without scheme, its default port, www., parameters named
    utm_ and a word in any case, empty parameters, fragment and closing slashes; escapes of
    unreserved characters are read. Null and empty URLs give null."""
    own = F.regexp_replace(url, "#.*$", "")
    scheme = F.lower(F.regexp_extract(own, "^([A-Za-z]+)://", 1))
    bare = F.regexp_replace(own, "^[Hh][Tt][Tt][Pp][Ss]?://", "")
    host = F.lower(F.regexp_extract(bare, "^[^/?]*", 0))
    port = F.when(scheme == "http", ":80$").when(scheme == "https", ":443$").otherwise("$^")
    host = F.regexp_replace(F.regexp_replace(host, port, F.lit("")), "^www\\.", "")
    rest = F.regexp_replace(unescaped(F.regexp_replace(bare, "^[^/?]*", "")), "(?i)([?&])utm_[a-z]+=[^&]*", "$1")
    rest = F.regexp_replace(rest, "([?&])&+", "$1")
    return F.nullif(F.concat(host, F.regexp_replace(rest, "[?&/]+$", "")), F.lit(""))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """record_id, canonical, ts, status, refers_to, digest, headers of every revisit.

    records: record_id long, url string, ts long, kind ('response' or 'revisit'), digest
    string, headers map<string, string> with names in lower case. status is 'resolved',
    'changed' (payload digests, an etag, or without one on both sides a last-modified date,
    disagree) or 'missing' (no earlier response, or no URL). Etags are compared weakly, as for
    a 304 (RFC 9110, 8.8.3.2): `W/` before them doesn't count. Responses of the same second are not
    earlier; of equal times the larger record_id is the latest. Rows without a time, and
    kinds other than the two, are left out. Unless resolved, digest and refers_to are null
    and headers are the revisit's own. Repeated rows are resolved one by one; other
    columns are ignored.
    """
    rows = records.where("ts is not null and kind in ('response', 'revisit')").select("record_id", canonical_url(F.col("url")).alias("canonical"), "ts", "kind", "digest", "headers")
    order = ["canonical", "ts", F.col("kind") == "response", "record_id"]
    dealt = stage(rows.where("canonical is not null").repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "records")
    response = F.struct("ts", "record_id", "digest", "headers")
    before = Window.partitionBy("part", "canonical").orderBy("ts", F.col("kind") == "response", "record_id")
    near = F.last(F.when(F.col("kind") == "response", response), ignorenulls=True).over(before.rowsBetween(Window.unboundedPreceding, -1))
    local = dealt.withColumn("near", near).where("kind = 'revisit'")
    last = dealt.where("kind = 'response'").groupBy("part", "canonical").agg(F.max_by(response, F.struct("ts", "record_id")).alias("own"))
    # One row per partition and URL; only URLs in more than one partition carry anything.
    ends = dealt.select("part", "canonical").distinct().join(last, ["part", "canonical"], "left")
    over = Window.partitionBy("canonical").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    far = ends.withColumn("far", F.last("own", ignorenulls=True).over(over)).where("far is not null").select("part", "canonical", "far")
    found = local.join(far, ["part", "canonical"], "left").withColumn("r", F.coalesce("near", "far"))
    lost = rows.where("canonical is null and kind = 'revisit'").withColumn("r", F.lit(None).cast(found.schema["r"].dataType))
    columns = ["record_id", "canonical", "ts", "digest", "headers", "r"]
    found = found.select(columns).unionByName(lost.select(columns))
    own, old = F.coalesce("headers", F.create_map().cast("map<string,string>")), F.coalesce("r.headers", F.create_map().cast("map<string,string>"))
    tags = [F.regexp_replace(F.element_at(x, "etag"), "^W/", "") for x in (own, old)]
    dates = (F.element_at(own, "last-modified"), F.element_at(old, "last-modified"))
    # Nulls compare to null: an etag on both sides decides, else a date on both sides, else nothing
    # disagrees; digests on both sides must agree besides.
    agrees = F.coalesce(tags[0] == tags[1], dates[0] == dates[1], F.lit(True)) & F.coalesce(F.col("digest") == F.col("r.digest"), F.lit(True))
    status = F.when(F.col("r").isNull(), "missing").when(agrees, "resolved").otherwise("changed")
    renew = F.map_filter(own, lambda k, v: k.isin(*RENEWED) & v.isNotNull())
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(renew, k)), renew)
    done = F.col("status") == "resolved"
    return found.withColumn("status", status).select(
        "record_id", "canonical", "ts", "status",
        F.when(done, F.col("r.record_id")).alias("refers_to"), F.when(done, F.col("r.digest")).alias("digest"),
        F.when(done, merged).otherwise(own).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Crawl records derived from pages: a response of each page, a revisit, for some a second
    response and a late revisit, and a capture of the host's front page. Some have weak etags,
    payload digests that agree or don't, or another spelling of the URL."""
    p = F.col("page_id")
    at = F.lit(1_700_000_000) + p * 60
    tag, tag2 = F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.substring(F.md5(F.concat(p.cast("string"), F.lit("b"))), 1, 16)
    full = lambda t: F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("etag"), t, F.lit("content-length"), F.length(F.coalesce("html", F.lit(""))).cast("string"), F.lit("date"), at.cast("string"))
    light = lambda t, s: F.create_map(F.lit("etag"), t, F.lit("date"), s.cast("string"), F.lit("cache-control"), F.lit("max-age=60"), F.lit("content-length"), F.lit("0"))
    one = lambda k, url, ts, kind, digest, headers: F.struct((p * 10 + k).alias("record_id"), url.alias("url"), ts.cast("long").alias("ts"), kind.alias("kind"), digest.alias("digest"), headers.alias("headers"))
    none, url = F.lit(None).cast("string"), F.col("url")
    front = F.concat(F.lit("http://"), F.regexp_extract(url, "^https?://([^/?#]*)", 1), F.lit("/"))
    is_full = p % 10 == 0
    early = F.when(p % 11 == 0, at - 30).otherwise(at + 3600)
    records = F.array(
        one(0, url, at, F.lit("response"), F.md5(F.coalesce("html", F.lit(""))), full(tag)),
        one(1, F.concat(url, F.lit("#again")), early, F.lit("revisit"), none, light(F.concat(F.when(p % 3 == 0, "W/").otherwise(""), tag), early)),
        one(2, F.concat(F.regexp_replace(url, "^(http://[^/?#]*)", "$1:80"), F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit("UTM_Source=again")), at + 7200, F.when(p % 5 == 0, "response").otherwise("revisit"), F.when(p % 5 == 0, tag2), F.when(p % 5 == 0, full(tag2)).otherwise(light(tag, at + 7200))),
        one(3, url, at + 9000, F.lit("revisit"), F.when(p % 13 == 0, "other").when(p % 13 == 1, F.when(p % 5 == 0, tag2).otherwise(F.md5(F.coalesce("html", F.lit(""))))), light(F.when((p % 5 == 0) & (p % 7 != 0), tag2).otherwise(tag), at + 9000)),
        one(4, front, at, F.when(is_full, "response").otherwise("revisit"), F.when(is_full, tag), F.when(is_full, full(F.lit("front"))).otherwise(light(F.lit("front"), at))),
    )
    return pages.where("page_id is not null").select(F.explode(records).alias("r")).select("r.*")


def op7_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures(read_table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.withColumn("headers", F.concat_ws(";", lines))


ORACLE = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, 1700000000 + page_id * 60 AS ts0, substr(md5(coalesce(html, '')), 1, 16) AS tag,
                  substr(md5(page_id || 'b'), 1, 16) AS tag2 FROM pages WHERE page_id IS NOT NULL),
raw AS (
  SELECT page_id * 10 AS record_id, url, ts0 AS ts, 'response' AS kind, md5(html) AS digest, tag AS etag, length(html) AS len, ts0 AS date FROM p
  UNION ALL SELECT page_id * 10 + 1, url || '#again', CASE WHEN page_id % 11 = 0 THEN ts0 - 30 ELSE ts0 + 3600 END, 'revisit', NULL, CASE WHEN page_id % 3 = 0 THEN 'W/' ELSE '' END || tag, 0,
                   CASE WHEN page_id % 11 = 0 THEN ts0 - 30 ELSE ts0 + 3600 END FROM p
  UNION ALL SELECT page_id * 10 + 2, regexp_replace(url, '^(http://[^/?#]*)', '\1:80') || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'UTM_Source=again', ts0 + 7200,
                   CASE WHEN page_id % 5 = 0 THEN 'response' ELSE 'revisit' END, CASE WHEN page_id % 5 = 0 THEN tag2 END,
                   CASE WHEN page_id % 5 = 0 THEN tag2 ELSE tag END, CASE WHEN page_id % 5 = 0 THEN length(html) ELSE 0 END, CASE WHEN page_id % 5 = 0 THEN ts0 ELSE ts0 + 7200 END FROM p
  UNION ALL SELECT page_id * 10 + 3, url, ts0 + 9000, 'revisit', CASE WHEN page_id % 13 = 0 THEN 'other' WHEN page_id % 13 = 1 THEN CASE WHEN page_id % 5 = 0 THEN tag2 ELSE md5(html) END END,
                   CASE WHEN page_id % 5 = 0 AND page_id % 7 <> 0 THEN tag2 ELSE tag END, 0, ts0 + 9000 FROM p
  UNION ALL SELECT page_id * 10 + 4, 'http://' || regexp_extract(url, '^https?://([^/?#]*)', 1) || '/', ts0, CASE WHEN page_id % 10 = 0 THEN 'response' ELSE 'revisit' END,
                   CASE WHEN page_id % 10 = 0 THEN tag END, 'front', CASE WHEN page_id % 10 = 0 THEN length(html) ELSE 0 END, ts0 FROM p),
-- scheme, host, port, then path and query, as a URL is made up
parts AS (SELECT *, regexp_extract(url, '^(?:(?i)(https?)://)?([^/?#:]*)(?::([0-9]+))?([^#]*)', ['scheme', 'host', 'port', 'rest']) AS u FROM raw),
-- each escape: the letter it stands for if that is unreserved, else the escape in capitals
decoded AS (SELECT *, array_to_string(list_transform(string_split(u.rest, '%'), lambda x, i: CASE WHEN i = 1 THEN x WHEN NOT regexp_matches(x, '^[0-9A-Fa-f]{2}') THEN '%' || x
              WHEN regexp_matches(chr(CAST('0x' || substr(x, 1, 2) AS INT)), '^[-A-Za-z0-9._~]$') THEN chr(CAST('0x' || substr(x, 1, 2) AS INT)) || substr(x, 3) ELSE '%' || upper(substr(x, 1, 2)) || substr(x, 3) END), '') AS rest FROM parts),
-- parameters one by one: none named utm_, none empty
split AS (SELECT *, regexp_extract(rest, '^[^?]*') AS path, list_filter(string_split(substr(regexp_extract(rest, '[?].*$'), 2), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(?i)utm_[a-z]+=')) AS params FROM decoded),
records AS (SELECT record_id, ts, kind, digest, etag, len, date, regexp_replace(lower(u.host), '^www\.', '')
              || CASE WHEN u.port = '' OR lower(u.scheme) = 'http' AND u.port = '80' OR lower(u.scheme) = 'https' AND u.port = '443' THEN '' ELSE ':' || u.port END
              || regexp_replace(path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END, '[?&/]+$', '') AS canonical FROM split),
paired AS (SELECT v.record_id, v.canonical, v.ts, v.etag, v.date, f.record_id AS f_id, f.digest AS f_digest, f.len AS f_len,
                  f.record_id IS NOT NULL AND ltrim(v.etag, 'W/') = ltrim(f.etag, 'W/') AND (v.digest IS NULL OR f.digest IS NULL OR v.digest = f.digest) AS ok
           FROM records v ASOF LEFT JOIN (SELECT canonical, ts, max(record_id) AS last FROM records WHERE kind = 'response' GROUP BY ALL) g
             ON v.canonical = g.canonical AND v.ts > g.ts
           LEFT JOIN records f ON f.record_id = g.last AND f.kind = 'response'
           WHERE v.kind = 'revisit')
SELECT record_id, canonical, ts, CASE WHEN f_id IS NULL THEN 'missing' WHEN ok THEN 'resolved' ELSE 'changed' END AS status,
       CASE WHEN ok THEN f_id END AS refers_to, CASE WHEN ok THEN f_digest END AS digest,
       'cache-control=max-age=60;content-length=' || CASE WHEN ok THEN f_len ELSE 0 END
         || CASE WHEN ok THEN ';content-type=text/html' ELSE '' END || ';date=' || date || ';etag=' || etag AS headers
FROM paired
"""

QUERIES = {"op7_revisit_resolution": op7_revisit_resolution}
ORACLES = {"op7_revisit_resolution": ORACLE}
