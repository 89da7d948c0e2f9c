import random

from pyspark.sql import functions as F

from cladeframe.llm import warc

SCHEMA = "record_id long, url string, ts long, kind string, digest string, headers map<string,string>"


def brute(rows):
    out = {}
    for rid, url, ts, kind, digest, headers in rows:
        if kind != "revisit" or ts is None:
            continue
        earlier = [x for x in rows if x[3] == "response" and x[1] == url and x[2] is not None and x[2] < ts]
        if url is None or not earlier:
            out[rid] = ("missing", None)
            continue
        r = max(earlier, key=lambda x: (x[2], x[0]))
        a, b = ((h.get("etag") or "").removeprefix("W/") for h in (headers, r[5]))
        ok = a == b if a and b else headers.get("last-modified") == r[5].get("last-modified") if headers.get("last-modified") and r[5].get("last-modified") else True
        ok = ok and (digest is None or r[4] is None or digest == r[4])
        out[rid] = ("resolved", r[0]) if ok else ("changed", None)
    return out


def test_against_brute_force(spark):
    r = random.Random(8)
    rows = []
    for i in range(600):
        url = "http://hot.example/x" if i % 3 == 0 else r.choice(["http://a.example/1", "http://a.example/2", None])
        h = {k: r.choice("xy") for k in ("last-modified", "date") if r.random() < 0.6}
        h |= {"etag": r.choice(['"x"', 'W/"x"', '"y"', 'W/"y"'])} if r.random() < 0.6 else {}
        rows.append((i, url, r.choice([None, *range(200)]), r.choice(["response", "revisit"]), r.choice([None, "d", "e"]), h))
    got = warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert {x.record_id: (x.status, x.refers_to) for x in got.collect()} == brute(rows)


def test_headers_and_urls(spark):
    rows = [
        (1, "HTTP://www.Example.com/a/?utm_source=f#top", 10, "response", "d", {"etag": "e", "content-type": "text/html", "date": "1", "content-length": "9"}),
        (2, "https://example.com/a", 11, "revisit", None, {"etag": "e", "date": "2", "content-length": "0", "set-cookie": "x"}),
        (3, "https://example.com/a", 12, "revisit", None, None),
    ]
    got = {x.record_id: x for x in warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA).withColumn("r", F.lit(1)).withColumn("part", F.lit(1))).collect()}
    assert got[2].canonical == "example.com/a" and got[2].digest == "d"
    assert got[2].headers == {"etag": "e", "content-type": "text/html", "date": "2", "content-length": "9"}
    assert got[3].refers_to == 1 and got[3].headers["date"] == "1"
    assert warc.resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pages(spark):
    pages = spark.createDataFrame([(10, "http://h.example/p", "<p>"), (11, None, None), (None, "x", "y")], "page_id long, url string, html string")
    got = {x.record_id: x.status for x in warc.resolve_revisits(warc.captures(pages)).collect()}
    assert got[101] == "resolved" and got[111] == "missing"


def test_only_parameters_named_utm_go(spark):
    urls = ["http://x.org/?my_utm_id=5&k=1", "http://x.org/?my_utm_id=6&k=1", "http://x.org/?utm_source=a&utm_medium=b&k=1", "http://x.org/?k=1&utm_source=a", "http://x.org/utm_a=1/"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(warc.canonical_url(F.col("u")).alias("c"))
    assert [r.c for r in rows.collect()] == ["x.org/?my_utm_id=5&k=1", "x.org/?my_utm_id=6&k=1", "x.org/?k=1", "x.org/?k=1", "x.org/utm_a=1"]


def test_spellings_of_one_url(spark):
    same = ["http://x.org/~a?k=1", "HTTP://WWW.X.ORG:80/%7Ea?UTM_Source=b&k=1", "https://x.org:443/%7ea?k=1&uTm_id=3#f", "http://x.org/%7%65a?k=1".replace("%7%65", "~")]
    apart = ["https://x.org:80/~a?k=1", "http://x.org:443/~a?k=1", "http://x.org:8080/~a?k=1", "http://x.org/~A?k=1", "http://x.org/%2Fa?k=1", "http://x.org/%2fa%?k=%4"]
    got = [r.c for r in spark.createDataFrame([(u,) for u in same + apart], "u string").select(warc.canonical_url(F.col("u")).alias("c")).collect()]
    assert set(got[: len(same)]) == {"x.org/~a?k=1"}
    assert got[len(same) :] == ["x.org:80/~a?k=1", "x.org:443/~a?k=1", "x.org:8080/~a?k=1", "x.org/~A?k=1", "x.org/%2Fa?k=1", "x.org/%2Fa%?k=%4"]


def test_weak_etags_and_digests(spark):
    rows = [(1, "http://a.b/", 1, "response", "d", {"etag": '"v1"'})]
    asked = [(None, 'W/"v1"'), ("d", 'W/"v1"'), ("other", '"v1"'), (None, 'W/"v2"'), ("other", None), ("d", None)]
    rows += [(2 + i, "http://a.b", 5, "revisit", d, {"etag": t} if t else {}) for i, (d, t) in enumerate(asked)]
    got = {x.record_id: x.status for x in warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[2 + i] for i in range(6)] == ["resolved", "resolved", "changed", "changed", "changed", "resolved"]
