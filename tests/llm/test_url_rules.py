from itertools import combinations

from lodestar.llm import url_rules as U

RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
URLS = [
    None, "", "no scheme/fr/", "http://A.Example.ORG/es/1", "https://example.org/en/12?x", "https://example.org/en/2", "http://myexample.org/es/",
    "http://x.com/fr/9", "http://x.com/fr", "http://com/de/1#f", "http://x.com?/de/", "http://x.com#/de/", "http://org", "http://org/", "http://x.com:80/de/",
    "ftp://a://b.com/fr/", "http://ÀB.ORG/é?q=1&&r", "http:///fr/", "://com/fr/", "http://a.net/x" + "y" * 5000, "http://a.net/p\nq?z#w",
]


def brute_parts(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.index(c) for c in "?#" if c in path] + [len(path)])]
    fits = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return host, path, max(fits, key=len) if fits else None


def test_fixed_rules_match_brute_force(spark):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, URLS[3], "x", "y"), (3, URLS[3], "x", "y")],
                               "page_id long, url string, host string, verdict string")
    got = U.judge(df).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule = brute_parts(URLS[3 if r.page_id is None else r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert rule is None or (r.verdict, r.method) == (RULES[rule], "rule")
        assert r.verdict in ("allow", "block")


def test_mined_rules_match_brute_force(spark):
    pages = [(i, f"https://{'casino' if i % 4 == 0 else 'news'}.example.net/{'win' if i % 4 == 0 or i % 7 == 0 else 'en'}/{i}{'?ref=x' if i % 3 else ''}") for i in range(240)]
    labels = [(i, 0 if i % 4 == 0 else 1, 0) for i in range(0, 200)] + [(1, 1, 1), (None, 0, 0), (2, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    said = {}
    for i, q, t in labels:
        if i is not None:
            said[i] = "block" if q == 0 or t == 1 or said.get(i) == "block" else "allow"
    h, p = U.host_of(df.url), U.path_of(df.url)
    items = {r.page_id: tuple(r["items"]) for r in df.select("page_id", U.tokens(df.url, h, p).alias("items")).collect()}
    known = [(items[i], v) for i, v in said.items()]
    count, both = {}, {}
    for its, v in known:
        for k in range(1, len(its) + 1):
            for c in combinations(its, k):
                count[c] = count.get(c, 0) + 1
                both[c, v] = both.get((c, v), 0) + 1
    n = len(known)
    rules = {(c, v): (x / count[c], x / n) for (c, v), x in both.items() if x / n >= 0.05 and x / count[c] >= 0.9}
    mined = U.mine(spark.createDataFrame([(list(a), b) for a, b in known], "items array<string>, verdict string"), 0.05, 0.9)
    assert {(tuple(r["items"]), r.verdict) for r in mined.collect()} == set(rules) and rules
    got = {r.page_id: r for r in U.judge(df, lab, min_support=0.05).collect()}
    for i, its in items.items():
        fit = [(*rules[c, v], len(c), v, " ".join(c)) for c, v in rules if set(c) <= set(its)]
        assert got[i].verdict == (max(fit)[3] if fit else U.DEFAULT) and got[i].method == ("mined" if fit else "default")
    assert {r.verdict for r in got.values()} == {"allow", "block"}


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert U.judge(df, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_tied_rules_go_to_the_first(spark):
    df = spark.createDataFrame([("a.com", "/x/y")], "host string, path string")
    name, verdict = U.fixed_rule(df.host, df.path, (("a.com", "/x", "block"), ("com", "/x/y", "allow")))
    assert tuple(df.select(name, verdict).first()) == ("a.com/x", "block")
