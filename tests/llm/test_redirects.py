from fleetscope.llm import redirects as rd
from fleetscope.llm.queries import URL_RULES, op6_redirects


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))]


def rule(host, path):
    fits = [(len(h + p), v == "allow", v, h + p) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def test_pages_equal_brute_force(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in op6_redirects(spark, sf).collect()}
    want = {}
    for r in pages:
        verdict, name = rule(*parts(r["url"]))
        want[r["page_id"]] = (*parts(r["url"]), name, verdict or "allow")
    assert got == want


def test_blocks_reach_aliases(spark):
    link = '<link rel="canonical" href="{}">'.format
    rows = [
        (1, "http://a.net/x", link("http://b.com/de/1")),                                # alias of a blocked address
        (2, "https://a.net/x#frag", None),                                                # the same address as 1
        (3, "http://c.net/y", '<META HTTP-EQUIV=refresh CONTENT="0; URL=//a.net/x">'),    # a chain
        (4, "http://d.net/z", link("http://e.com/de/2") + link("http://f.org/ok")),       # block and allow: allow wins
        (5, "http://g.net/dir/page", link("other")),                                      # relative, in the page's folder
        (6, "http://g.net/dir/other", link("http://b.com/de/9")),
        (7, "http://h.org/k", link("http://p.com/de/7")),                                 # its own rule allows it,
        (14, "http://q.net/", link("http://p.com/de/7")),                                 # and so its alias
        (8, None, link("http://b.com/de/1")), (9, "no url", None), (10, "http://i.net/q?a=1", None), (10, "http://i.net/q?a=1", None),
        (11, "http://j.net/", link("mailto:x@y")), (12, "http://k.net", link("")), (13, "HTTP://User.NET/A?x#y", "<link rel=canonical href=/A>")]
    pages = spark.createDataFrame([(*r, "extra", "allow?") for r in rows], "page_id long, url string, html string, other string, verdict string")
    got = rd.judge_urls(pages, URL_RULES, spark.createDataFrame([("http://i.net/q?a=1", "http://c.net/y")], "source string, target string"))
    assert got.columns == ["page_id", "url", "other", "host", "path", "rule", "verdict"]
    verdict = {}
    for r in got.collect():
        verdict.setdefault(r["page_id"], []).append(r["verdict"])
    assert {k for k, v in verdict.items() if v[0] == "block"} == {1, 2, 3, 5, 6, 10} and len(verdict[10]) == 2
    assert verdict[4] == verdict[7] == verdict[14] == ["allow"]
    assert rd.judge_urls(pages.limit(0), URL_RULES).count() == 0
