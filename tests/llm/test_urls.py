"""Listed rules by plain string code; mined rules on a small set."""

from corpuscle.llm import urls

DDL = "page_id LONG, url STRING, host STRING, rule STRING, tokens STRING, row STRING"
URLS = ["http://a.NET/x", "https://net", "http://net/", "http://xnet/", "http://example.net/en/1?q", "http://m.example.net/en",
        "http://www.example.com/de/#top", "http://example.com/den/", "http://a.org/fr/x", "ftp://a.org?x=/fr/", "no scheme.net/",
        "", None, "://b.net/c", "http://u:p@h.net:80/p", "http://A.ORG/FR/x", "http://é.net/\n?x", "http://a.net/x://y/de/", "http://"]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = path = ""
    for i, ch in enumerate(rest + "?"):
        if ch in "/?#":
            host, rest = rest[:i], rest[i:]
            break
    for ch in rest:
        if ch in "?#":
            break
        path += ch
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_listed_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "r", "t", "w") for i, u in enumerate(URLS)] + [(0, URLS[0], None, None, None, None)], DDL)
    got = urls.judge(pages).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path, rule, verdict = plain(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.page_id]
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    assert urls.judge(pages.limit(0)).count() == 0


def test_mined_rules_match(spark):
    rows = [f"http://casino-{i % 3}x.shop.net/en/{i}" for i in range(60)] + [f"http://news.example.net/en/{i}" for i in range(60)]
    rows += ["http://casino-9x.free.org/en/", "http://news.free.org/en/", "http://plain.free.org/en/"]
    pages = spark.createDataFrame([(i, u, None, None, None, None) for i, u in enumerate(rows)], DDL)
    got = {r.page_id: r for r in urls.judge(pages).collect()}
    assert (got[120].verdict, got[121].verdict, got[122].verdict) == ("block", "allow", "allow")
    assert got[120].evidence == "casino" and got[121].evidence == "news" and got[122].evidence is None


def test_longer_rules_that_add_nothing_go(spark):
    data = [(["a", "b"], "block")] * 30 + [(["a"], "block")] * 10 + [(["c"], "allow")] * 40 + [(["b", "c"], "allow")] * 5
    rules = urls.mine(spark.createDataFrame(data, "tokens ARRAY<STRING>, verdict STRING"), confidence=0.5)
    assert {(tuple(r["items"]), r.verdict) for r in rules.collect()} >= {(("a",), "block"), (("c",), "allow")}
    assert (("a", "b"), "block") not in {(tuple(r["items"]), r.verdict) for r in rules.collect()}
