import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import html as H
from corpusloom.functions import text as T
from corpusloom.functions import url as U
from corpusloom.operators import dedup as D

URLS = [
    ("HTTP://Example.COM:80/a//b?b=2&a=1&utm_x=3#f", "http://example.com/a/b?a=1&b=2"), ("https://u:p@h.com:8443/x;y=1?q=a b", "https://h.com:8443/x?q=a+b"), ("http://e.com", "http://e.com/"), ("mailto:x@y", None), ("ftp://e.com/", None),
    ("http://e.com/a.PDF", None), ("http://e.com/the,end/für?x=&y=1", "http://e.com/the%2Cend/f%C3%BCr?y=1"), ("", None), (None, None), ("http:///x", None), ("http://e.com:bad/x", None), ("http://e.com/%zz?q=%zz", "http://e.com/%zz?q=%25zz"),
    ("  http://e.com/p?a=1&a=0 ", "http://e.com/p?a=0&a=1"), ("https://e_x.com/a b", "https://e_x.com/a%20b"), ("http://e.com/é🎉", "http://e.com/%C3%A9%F0%9F%8E%89"), ("/relative", None), ("http://[::1]:80/x", "http://[::1]/x"),
]


def one(spark, col, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(col(F.col("x"))).first()[0]


def test_normalize(spark):
    df = spark.createDataFrame([(u,) for u, _ in URLS], "u string").select("u", U.normalize(F.col("u")).alias("n"))
    assert {r.u: r.n for r in df.collect()} == dict(URLS)
    for u, n in URLS:
        if u is None or "[" not in u:
            assert U.normalize_one(u) == n
    assert U.normalize_one("../b?x=1#z", "http://e.com/a/c") == "http://e.com/b?x=1"
    assert U.normalize_one("http://e.com/a.pdf", allow_static=True) == "http://e.com/a.pdf"


def test_profiles(spark):
    u = "http://e.com/x.exe?b=&a=1&UTM_q=1&sid=3"
    df = spark.createDataFrame([(u,)], "u string")
    got = df.select(*[U.normalize(F.col("u"), p).alias(p) for p in ("strict", "scored", "fast")]).first()
    assert got.strict is None and got.scored == "http://e.com/x.exe?a=1" and got.fast is None
    v = u.replace(".exe", "")
    assert U.normalize_one(v, None, "fast") == one(spark, lambda c: U.normalize(c, "fast"), v) == "http://e.com/x?b=&a=1&UTM_q=1"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abAB/?&=#%:;.,~+ é2", max_size=20), min_size=20, max_size=20))
def test_normalize_is_idempotent(paths):
    for p in paths:
        n = U.normalize_one("http://e.com/" + p)
        assert n is None or U.normalize_one(n) == n


def test_sites(spark):
    df = spark.createDataFrame([(u,) for u in ("https://www.example.com/x", "http://www.blog.example.co.uk/", "http://1.2.3.4/", "http://freecasino.com/", "http://localhost/", "", None, "http://123.example.com/")], "u string")
    got = {r.u: (r.s.reason, r.s.seed_url, r.s.scope) for r in df.select("u", U.site_of(F.col("u")).alias("s")).collect()}
    assert got["https://www.example.com/x"] == (None, "https://www.example.com/", "example.com")
    assert got["http://www.blog.example.co.uk/"] == (None, "http://blog.example.co.uk/", "example.co.uk")
    assert {got[u][0] for u in ("http://1.2.3.4/", "http://freecasino.com/", "http://localhost/", "http://123.example.com/")} == {"invalid_site"}
    assert got[""][0] == got[None][0] == "missing_target_url"


@pytest.mark.parametrize("host, english", [("example.com", True), ("example.co.uk", True), ("example.fr", False), ("xn--a.com", False), ("bücher.com", False), ("-a.com", False), ("", False), (None, False)])
def test_english(spark, host, english):
    assert one(spark, U.is_english_host, host) == english


def test_small_functions(spark):
    assert one(spark, U.safe_name, "a b/c") == "a_b_c" and one(spark, U.safe_name, "//") == "site"
    assert one(spark, U.absolute_path, "/x/y").endswith(".org/x/y") and one(spark, U.absolute_path, "https://a/b") == "https://a/b"
    assert one(spark, lambda c: U.in_scope(c, ["a.com"], ["b.com"], True), "x.b.com") and not one(spark, lambda c: U.in_scope(c, ["a.com"], ["b.com"], False), "x.b.com")
    assert one(spark, U.is_low_value, "http://e.com/a/Login?x") and one(spark, U.is_low_value, "http://e.com/?a=1&b=2&c=3&d=") and one(spark, U.is_low_value, "http://e.com/page/1234") and not one(spark, U.is_low_value, "http://e.com/pages/12")
    assert one(spark, lambda c: U.path_allowed(c, ["/docs/"]), "http://e.com/docs/x") and not one(spark, lambda c: U.path_allowed(c, ["/docs"]), "http://e.com/docsx")
    assert one(spark, T.clean_text, " a \t b\n \n\n c ") == "a b\n c"
    assert one(spark, T.content_hash, " A  b\n") == one(spark, T.content_hash, "a B") and one(spark, T.content_hash, None) is None
    assert one(spark, lambda c: T.retry_after(c, 1.5), "99") == 30.0 and one(spark, lambda c: T.retry_after(c, 1.5), "soon") == 1.5
    assert one(spark, lambda c: T.header(c, "content-TYPE", "none"), {"Content-Type": "x"}, "map<string,string>") == "x"
    assert one(spark, lambda c: T.header(c, "other", "none"), {"Content-Type": "x"}, "map<string,string>") == "none"
    assert one(spark, lambda c: T.shingles(T.tokens(c)), "one two three four five six") == ["one two three", "two three four", "three four five", "four five six"]
    assert one(spark, lambda c: T.shingles(T.tokens(c)), "one two three") == ["one", "two", "three"]
    assert one(spark, T.is_challenge, "<p>Just A Moment...") and not one(spark, T.is_challenge, None)
    assert one(spark, lambda c: T.looks_like_xml(c, F.lit("text/plain")), "  <?XML version") and not one(spark, lambda c: T.looks_like_xml(c, F.lit("text/html")), "<html>")


def test_html(spark):
    page = "<html><head><title>A &amp; B</title><style>x</style></head><body><nav>menu</nav><p>One&nbsp;two</p><script>bad()</script><a href='/x?utm_a=1'>l</a><link rel='canonical' href='/c'><link rel='alternate' type='application/rss+xml' href='/feed'></body></html>"
    assert one(spark, T.title_of_html, page) == "A & B"
    assert "bad" not in one(spark, T.text_of_html, page) and "menu" in one(spark, T.text_of_html, page)
    assert one(spark, T.hrefs, page) == ["/x?utm_a=1", "/c", "/feed"]
    r = spark.createDataFrame([(page, "http://e.com/"), (None, None)], "h string, b string").select(H.parsed_text("h").alias("t"), H.parsed_links("h", "b").alias("l")).collect()
    assert r[0].t.title == "A & B" and "menu" not in r[0].t.text and r[0].l.links == ["http://e.com/x"] and r[0].l.feeds == ["http://e.com/feed"] and r[0].l.canonical == "http://e.com/c"
    assert r[1].t.title is None and r[1].l.links == []


def test_xml_and_bytes():
    ns = "http://www.sitemaps.org/schemas/sitemap/0.9"
    xml = f"<urlset xmlns='{ns}'><url><loc> http://e.com/a </loc><lastmod>2025-01-01</lastmod></url><url><lastmod>x</lastmod></url></urlset>".encode()
    import gzip

    for raw in (xml, gzip.compress(xml)):
        assert H.read_sitemap(raw) == ([], [{"url": "http://e.com/a", "lastmod": "2025-01-01", "changefreq": "", "priority": ""}])
    assert H.read_sitemap(b"<broken") == ([], []) == H.read_sitemap(None)
    assert H.read_sitemap(b"<sitemapindex><sitemap><loc>http://e.com/s.xml.gz</loc></sitemap></sitemapindex>")[0][0]["url"] == "http://e.com/s.xml.gz"
    assert H.read_feed(b"<feed><entry><link href='/a'/><link rel='self' href='/b'/></entry></feed>", "http://e.com/") == ["http://e.com/a"]
    assert H.decode("é".encode("latin-1"), "text/html; charset=latin-1") == "é" and H.decode(b"<meta charset=cp1251>\xcf", None).endswith("П") and H.decode(b"\xff\xfe\xfa", None, ("utf-8",)) == "���" and H.decode(None, None) is None
    allow = H.robots_allow("bot").func
    assert allow(pd.Series(["User-agent: *\nDisallow: /x", None]), pd.Series(["http://e.com/x/1", "http://e.com/x"])).tolist() == [False, True]


def test_simhash():
    assert D.blake_simhash([]) == (1 << 64) - 1
    a = D.blake_simhash("the quick brown fox jumps over the lazy dog today".split())
    assert a == D.blake_simhash("the quick brown fox jumps over the lazy dog today".split())
