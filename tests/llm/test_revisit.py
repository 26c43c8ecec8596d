import random

import pytest
from pyspark.sql import functions as F

from lodestar.llm import revisit as R

SCHEMA = "record_id long, url string, ts long, kind string, digest string, headers map<string,string>, full string, bucket string"
PERMITTED = {"cache-control", "content-location", "date", "etag", "expires", "vary", "last-modified"}


def brute_headers(h):
    return {k.lower(): v for k, v in sorted((h or {}).items(), key=lambda kv: (kv[0].lower(), kv[1]))}


def brute(rows, canon):
    out = []
    for i, u, ts, kind, _, h in rows:
        if kind != "revisit":
            continue
        u, own, status, got = canon[u], brute_headers(h), "orphan", None
        best = None
        for j, v, t, k, d, g in rows:
            if k == "response" and u is not None and ts is not None and canon[v] == u and t is not None and t < ts:
                key = (t, j, d, sorted(brute_headers(g).items()))
                if best is None or key > best[0]:
                    best = (key, d, brute_headers(g))
        if best:
            a = best[2]
            weak = lambda x: x[2:] if x.startswith("W/") else x
            if "etag" in a and "etag" in own:
                status = "resolved" if weak(a["etag"]) == weak(own["etag"]) else "mismatch"
            elif "last-modified" in a and "last-modified" in own:
                status = "resolved" if a["last-modified"] == own["last-modified"] else "mismatch"
            else:
                status = "unverified"
            got = best[0]
        ok = status in ("resolved", "unverified")
        merged = {**best[2], **{k: v for k, v in own.items() if k in PERMITTED}} if ok else own
        out.append((i, u, ts, status, got and got[1], got and got[0], best[1] if ok else None, tuple(sorted(merged.items()))))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [1, 50])
def test_matches_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(R, "shuffle_width", lambda s: width)
    rnd = random.Random(6)
    urls = ["http://www.A.com/x/", "https://a.com:443/x#f", "a://m.a.com/x?utm_z=1", "http://b.com/y?b=2&a=1", "http://b.com/y?a=1&b=2&utm_s=q", "plain", None, "http://hot.com/"]
    rows = []
    for k in range(400):
        u = "http://hot.com/" if rnd.random() < 0.4 else rnd.choice(urls)
        ts = rnd.choice([None, 5, 5] + list(range(60)))
        h = {n: rnd.choice(vs) for n, vs in (("ETag", ['"a"', 'W/"a"', '"b"']), ("Last-Modified", ["m1", "m2"]), ("DATE", [str(k)]), ("X-Own", ["1"]),
                                             ("Content-Length", ["0", "9"]), ("expires", ["e"])) if rnd.random() < 0.6}
        rows.append((k // 2 if k % 9 else None, u, ts, rnd.choice(["response", "revisit", "revisit", "other"]), f"d{k}", h if k % 17 else None))
    rows = [(i if i is not None or r == "revisit" else 10_000 + k, u, t, r, d, h) for k, (i, u, t, r, d, h) in enumerate(rows)]
    rows += rows[:6]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    canon = {r.u: r.c for r in spark.createDataFrame([(u,) for u in urls], "u string").select("u", R.canonical_url(F.col("u")).alias("c")).collect()}
    assert canon == {"http://www.A.com/x/": "a.com/x", "https://a.com:443/x#f": "a.com/x", "a://m.a.com/x?utm_z=1": "a.com/x", "http://b.com/y?b=2&a=1": "b.com/y?a=1&b=2",
                     "http://b.com/y?a=1&b=2&utm_s=q": "b.com/y?a=1&b=2", "plain": "plain", None: None, "http://hot.com/": "hot.com"}
    got = [(r.record_id, r.url, r.ts, r.status, r.response_id, r.response_ts, r.digest, tuple((e["name"], e["value"]) for e in r.headers)) for r in R.resolve(df).collect()]
    assert sorted(got, key=str) == brute(rows, canon)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert R.resolve(df).count() == 0
