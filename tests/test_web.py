import tempfile

import pytest
from pyspark.sql import functions as F

from lexwarrant.functions import urls as U
from lexwarrant.operators import checks as C
from lexwarrant.sources import web as W


def one(spark, f, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(f(*[F.col(c) for c in df.columns])).first()[0]


@pytest.mark.parametrize(
    "url, domain",
    [
        ("https://blog.example.com/x", "example.com"), ("http://www.example.de", "example.de"), ("https://a.b.co.uk/", "b.co.uk"), ("https://co.uk/", "co.uk"),
        ("HTTPS://User@News.Example.COM:8080/x?y", "example.com"), ("not a url", "not a url"), ("Mixed Case", "mixed case"), ("https://localhost/x y", "localhost"),
    ],
)
def test_domains(spark, url, domain):
    assert one(spark, U.domain_of, url) == domain


ROBOTS = "User-agent: Googlebot\nDisallow: /google\n\nUser-agent: *\nDisallow: /admin # private\nAllow: /admin/ok\nDisallow: \nDISALLOW:/search\nno colon\n"


def test_robots(spark):
    assert one(spark, U.disallowed_paths, ROBOTS) == ["/admin", "/search"]
    assert one(spark, U.disallowed_paths, "User-agent: *\nUser-agent: other\nDisallow: /x") == []
    assert one(spark, U.disallowed_paths, "") == []
    rules = F.array(F.lit("/admin"), F.lit("/search"))
    for url, ok in (("https://x.de/admin/a", False), ("https://x.de/a", True), ("https://x.de", True), ("nonsense", False)):
        assert one(spark, lambda u: U.allowed(u, rules), url) is ok
    assert one(spark, lambda u: U.allowed(u, F.array(F.lit("/"))), "https://x.de") is False


def test_links(spark):
    assert one(spark, U.sitemap_links, "<loc> https://a/1 </loc><loc>https://a/2</loc><loc></loc>") == ["https://a/1", "https://a/2"]
    assert one(spark, U.is_sitemap_index, "<sitemapindex xmlns='x'>") and not one(spark, U.is_sitemap_index, "<urlset>")
    assert one(spark, U.feed_links, '<link href="https://a/2"/><link>https://a/1</link><link>https://a/1</link>') == ["https://a/1", "https://a/2"]
    html = """<a href="/a?p=2">x</a><a class=y href='b'>y</a><a href="#top">z</a><a href="/c#d">w</a><a href="mailto:x@y">m</a><A HREF="https://Other.org">o</A><a href="/a?p=2">again</a>"""
    assert one(spark, U.page_links, html, "https://x.de/dir/page") == ["https://x.de/a?p=2", "https://x.de/dir/b", "https://other.org/"]


def found(spark, pages, domain="x.de", **more):
    """Addresses of one site in order, its closed paths, and what was asked for."""
    log = tempfile.mktemp()

    def get(url):
        with open(log, "a") as f:
            f.write(url + "\n")
        return pages.get(url)

    rows = W.discover(spark.createDataFrame([(domain,)], "domain string"), get, delay=0, **more).orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(len(rows)))
    return [r["url"] for r in rows], [list(r["closed"]) for r in rows[:1]], open(log).read().split()


def test_discovery(spark):
    urls, closed, _ = found(spark, {"https://x.de/robots.txt": "Sitemap: https://x.de/map.xml\nUser-agent: *\nDisallow: /no", "https://x.de/map.xml": "<loc>https://x.de/1</loc><loc>https://x.de/no/2</loc><loc>https://other.org/3</loc><loc>https://x.de/a.css?v=1</loc><loc>https://www.x.de/4</loc><loc>https://x.de/1</loc>"})
    assert urls == ["https://x.de/1", "https://www.x.de/4"] and closed == [["/no"]]
    index = {"https://x.de/sitemap.xml": "<sitemapindex >" + "".join(f"<loc>https://x.de/s{i}</loc>" for i in range(9)) + "</sitemapindex>"} | {f"https://x.de/s{i}": f"<loc>https://x.de/p{i}</loc>" for i in range(9)}
    assert found(spark, index)[0] == [f"https://x.de/p{i}" for i in range(5)]
    urls, _, asked = found(spark, index, limit=2)
    assert urls == ["https://x.de/p0", "https://x.de/p1"]
    assert [u.rpartition("/")[2] for u in asked] == ["robots.txt", "sitemap.xml", "s0", "s1"]  # it has enough
    _, _, asked = found(spark, {"https://x.de/robots.txt": "Sitemap: https://x.de/a.xml\nSitemap: https://x.de/b.xml", "https://x.de/a.xml": "<loc>https://x.de/1</loc><loc>https://y.de/2</loc>"}, limit=2)
    assert [u.rpartition("/")[2] for u in asked] == ["robots.txt", "a.xml"]
    assert found(spark, {"https://x.de/rss": "<link>https://x.de/r</link>"})[0] == ["https://x.de/r"]
    urls, _, asked = found(spark, {"https://x.de/": '<link rel="stylesheet" href="/s.css"><a href="/front">f</a>'})
    assert urls == ["https://x.de/front"] and len(asked) == 11 and asked[0].endswith("robots.txt") and asked[-1] == "https://x.de/"
    urls, *_ = found(spark, {"https://x.de/robots.txt": "Sitemap: https://x.de/en/map.xml\nSitemap: https://x.de/de/map.xml", "https://x.de/en/map.xml": "<loc>https://x.de/de/wrong</loc>", "https://x.de/de/map.xml": "<loc>https://x.de/de/a</loc><loc>https://x.de/den</loc>"}, "x.de/de/")
    assert urls == ["https://x.de/de/a"]
    assert found(spark, {})[0] == []


def test_harvest(spark):
    pages = {"https://x.de/sitemap.xml": "<loc>https://x.de/1</loc><loc>https://x.de/2</loc><loc>https://x.de/3</loc><loc>https://x.de/4</loc>", "https://x.de/1": "<p>" + "Wort " * 60 + "</p>", "https://x.de/2": "<p>kurz</p>", "https://x.de/3": "body { }" * 60}
    got = W.harvest_sites(spark.createDataFrame([("x.de",), ("y.de",)], "domain string"), pages.get, delay=0)
    assert sorted(r["url"] for r in got.collect()) == ["https://x.de/1", "https://x.de/2", "https://x.de/3"]
    docs = W.page_documents(W.admissible(got))
    assert [(r["source"], r["locator"]) for r in docs.collect()] == [("web:x.de", "https://x.de/1")]


SOURCES = "id string, family string, locator_kind string, template string, as_of string"


def test_prove(spark):
    sources = spark.createDataFrame([("wiki:de", "wikimedia", "template", "https://w/{id}", None), ("gut", "gutenberg", "template", "https://g/{id}/{id}.txt", None), ("lz", "leipzig", "url", None, "2021")], SOURCES)
    rows = [("SCHADE", "wiki:de", ["1", "2", "3", "4"]), ("SCHADE", "gut", ["5"]), ("SCHADE", "lz", ["https://l/1", "https://l/2", "https://l/3", "https://l/4", "https://l/5"]), ("SCHADE", "nope", ["x"])]
    a = spark.createDataFrame(rows, "word string, source string, locators array<string>")
    archive = lambda u, y="2020": f"https://web.archive.org/web/{y}/{u}"
    pages = {
        "https://w/1": "Wie schade!", "https://w/2": "schadenfroh", archive("https://w/3"): "Schade", archive("https://g/5/5.txt"): "nichts",
        archive("https://l/1", "2021"): "schade", archive("https://l/2", "2021"): "weg", "https://l/2": "schade", "https://l/3": "schade", "https://l/4": "weg",
    }
    checked, proofs = C.prove(a, sources, pages.get)
    got = {r["locator"]: (r["url"], r["outcome"]) for r in checked.collect()}
    assert {k: v[1] for k, v in got.items()} == {
        "1": "found", "2": "absent", "3": "archived", "4": "unreachable", "5": "absent", "x": "unresolvable",
        "https://l/1": "archived", "https://l/2": "unreachable", "https://l/3": "found", "https://l/4": "unreachable", "https://l/5": "unreachable",
    }
    assert got["x"][0] == "" and got["5"][0] == "https://g/5/5.txt"
    assert tuple(proofs.first()) == ("SCHADE", 2, False)
    assert {r["outcome"]: r["n"] for r in C.tally(checked).collect()}["unreachable"] == 4
    words = spark.createDataFrame([(str(i),) for i in range(20)], "word string")
    assert C.sample_words(words, 3).collect() == C.sample_words(words.repartition(3), 3).collect()


def test_conform(spark):
    sources = spark.createDataFrame([("a", "f1"), ("b", "f2"), ("c", "f3")], "id string, family string")
    attested = spark.createDataFrame([("GOOD", s, ["1"]) for s in "abc"] + [("THIN", "a", ["1"]), ("THIN", "x", [])], "word string, source string, locators array<string>")
    words = spark.createDataFrame([("GOOD",), ("THIN",)], "word string")
    ship = lambda *w: spark.createDataFrame([(x,) for x in w], "word string")
    assert C.conform(ship("GOOD"), attested.where("word = 'GOOD'"), words.limit(1), sources).collect() == []
    got = {r["check"]: r["detail"] for r in C.conform(ship("GOOD", "THIN", *[f"M{i}" for i in range(7)]), attested, words, sources).collect()}
    assert got == {
        "every source is registered": "unknown: x", "every shipped word has evidence": "7 without any: M0, M1, M2, M3, M4, and 2 more",
        "every shipped word has 3 independent sources": "1 short: THIN", "every attestation says where to look": "1 with a source and no locator: THIN",
    }
