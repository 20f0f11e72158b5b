"""URL verdicts against a direct reading of the rules."""
from noisyframe.llm import url_filter as M

URLS = [
    None, "", "no scheme", "http://", "http:///path", "http://com", "http://com/", "HTTP://COM/x", "http://www.example.com/en/1",
    "https://example.com/en/", "https://example.com/en", "https://blog.Example.COM/en/7#top", "http://notexample.com/en/1",
    "http://x.example.net/es/1?a=/fr/", "http://net/fr/", "http://internet/fr/", "http://a.net?q=/es/", "http://a.net#/es/",
    "http://a.b.c.d.example.com/en/x/y/z", "http://www.example.com./en/1", "http://com:80/x", "x://y://z.com/a",
    "http://a.net//es/", "http://a.org/" + "p/" * 300, "http://ex.org/abcd", "http://ex.org/ab\ncd", "http://ünï.com/ñ",
]
RULES = [*M.RULES, ("block", "org", "/abc"), ("allow", "ex.org", "/"), ("allow", "ex.org", "/"), ("block", "ex.org", "/"),
         ("block", "B.com", "/aa/"), ("allow", "a.b.com", "/a")]


def judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?", 1)[0].split("#", 1)[0]
    fits = [(len(h + p), len(h), v, h + p) for v, h, p in ((v, h.lower(), p) for v, h, p in RULES)
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_verdicts(spark, monkeypatch):
    urls = [*URLS, "http://a.b.com/aa/x", "http://a.b.com/ab"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate([*urls, *urls])], "page_id long, url string, host string")
    rules = spark.createDataFrame([*RULES, ("block", None, "/"), ("block", "", "/"), ("allow", "com", None)],
                                  "verdict string, host string, path string")
    for limit in (M.BROADCAST_RULES, 0):
        monkeypatch.setattr(M, "BROADCAST_RULES", limit)
        got = {r["page_id"]: tuple(r["judged"]) for r in M.judge(pages, rules).collect()}
        assert [got[i] for i in range(2 * len(urls))] == [judge(u) for u in urls] * 2
    assert M.judge(pages.limit(0), rules).count() == 0
    assert {r["judged"]["verdict"] for r in M.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_very_long_paths_and_hosts_end(spark):
    urls = [(1, "http://example.com/en/" + "a/" * 100_000), (2, "http://" + "x." * 20_000 + "example.com/en/q"),
            (3, "http://a.net/" + "/" * 100_000), (4, "http://a.net/es/" + "b" * 300_000)]
    rules = spark.createDataFrame(M.RULES, "verdict string, host string, path string")
    frame = spark.createDataFrame(urls, "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in M.judge(frame, rules).select("page_id", "judged.rule", "judged.verdict").collect()}
    assert got == {1: ("example.com/en/", "block"), 2: ("example.com/en/", "block"), 3: (None, "allow"), 4: ("net/es/", "block")}
