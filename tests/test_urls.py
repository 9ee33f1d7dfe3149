import random
from urllib.parse import urljoin, urlparse, urlunparse

from linkloom.functions import urls

URLS = [
    "http://www.bbc.co.uk/x", "HTTP://a.com/p?#z", "http://www.awww.b.com/x//?q=1#f", "http://a.com:80/p;x=1?y#z",
    "http://u@h_b.com/p;", "mailto:x@y#z", "a/b#c", "//h/p", "http://h", "http://h?x#y", "localhost:80/x", "1a:b", "",
    " http://a.com/\tx", "http://h/a;b/c;d#e", "http:/x", "http://h/p#a#b", "file:/x", "http://h/p;;#r",
    "https://пример.рф/путь?q=ж#я", "http://h/%20?a=b&c=d", "http://h//x//y/",
]
BASES = ["http://h/a/b/c", "http://h/a/b/", "http://h", "http://h/a//b/c?q=1#f", "https://x.y/z;p?u"]
HREFS = [
    "", "/w", "w", "./w", "../w", "../../../w", "?n=1", "#f", "//o/p", "https://o/p/../q", "http:foo", "mailto:a@b",
    "javascript:x", "w/", "..", ".", "../", "/a/./b/../c", "/..//x", "a//b", "/", "http://h/P?#", "w;v", "a/..", "/a/..",
    "x?y=/../z", "HTTP://UP/x#", "/a/.b/..c",
]


def test_parts_and_strip_follow_the_standard_library(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    for r in df.select("u", urls.url_parts("u").alias("p"), urls.strip_fragment("u").alias("s")).collect():
        parsed = urlparse(r.u)
        assert tuple(r.p) == (parsed.scheme, parsed.netloc, parsed.path, parsed.query, parsed.fragment), r.u
        assert r.s == urlunparse(parsed._replace(fragment="")), r.u


def test_resolve_follows_the_standard_library(spark):
    df = spark.createDataFrame([(b, h) for b in BASES for h in HREFS], "b string, h string")
    for r in df.select("b", "h", urls.resolve_link("b", "h").alias("r")).collect():
        assert r.r == urljoin(r.b, r.h), (r.b, r.h)


PIECES = [
    "a", "b.c", "..", ".", "..;x", ";", "p", "/", "//", "?q", "?", "#f", "#", "http:", "https:", "mailto:", "x:", "ftp:", "@", "h.org:80", " ", "é",
    "%20", "=", "&", "",
]
ODD_BASES = ["http://h/a/b;p/c?q#f", "https://x.y/z;p", "http://h", "mailto:a@b;", "ftp://f/a//b/", "file:/x/y;", "http:////a/b", "x:a/b;", "http://"]


def test_random_urls_follow_the_standard_library(spark):
    pick = random.Random(11)
    made = lambda: "".join(pick.choice(PIECES) for _ in range(pick.randint(0, 7)))
    rows = [(pick.choice(ODD_BASES) if pick.random() < 0.7 else "http://" + made(), made()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "b string, h string")
    for r in df.select("b", "h", urls.resolve_link("b", "h").alias("r"), urls.strip_fragment("h").alias("s"), urls.netloc("h").alias("n")).collect():
        try:
            parsed, joined = urlparse(r.h), urljoin(r.b, r.h)
        except ValueError:
            continue
        assert (r.r, r.s, r.n) == (joined, urlunparse(parsed._replace(fragment="")), parsed.netloc), (r.b, r.h)


def test_site_names(spark):
    cases = {"www.bbc.co.uk": "co", "m.example.com": "example", "www.en": "www", "news.site.org": "news", "WWW.Abc.d": "d", "abc": "abc"}
    df = spark.createDataFrame([(h,) for h in cases], "h string")
    assert {r.h: r.n for r in df.select("h", urls.site_name("h").alias("n")).collect()} == cases


def test_norms(spark):
    df = spark.createDataFrame([("http://www.awww.b.com/x//?q=1#f",), ("https://b.com/",)], "u string")
    rows = df.select(urls.site_norm("u").alias("s"), urls.link_norm("u").alias("l")).collect()
    # ``www.`` goes wherever it stands in the host.
    assert [tuple(r) for r in rows] == [("ab.com/x", "ab.com/x?q=1#f"), ("b.com", "b.com")]
