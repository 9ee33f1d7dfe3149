from pyspark.sql import functions as F

from linkloom.operators import lookups, robots, sites
from linkloom.plans import jobs

LINKS = "lid_label string, ord long, link string"


def _merged(spark, rows):
    df = spark.createDataFrame([("l", i, u) for i, u in enumerate(rows)], LINKS)
    merged = sites.merge_sites(sites.group_by_site(df))
    return merged, [(r.site_url, r.link) for r in merged.orderBy("site_url", "ord", "link").collect()]


def test_lonely_site_is_untouched(spark):
    _, got = _merged(spark, ["http://a.com/b", "http://a.com/a", "http://a.com/b"])
    assert got == [("http://a.com", u) for u in ("http://a.com/b", "http://a.com/a", "http://a.com/b")]


def test_variants_merge_under_https_as_sorted_set(spark):
    _, got = _merged(spark, ["http://a.com/b", "http://a.com/a", "https://www.a.com/c", "http://a.com/a"])
    assert got == [("https://www.a.com", u) for u in ("http://a.com/a", "http://a.com/b", "https://www.a.com/c")]


def test_without_https_the_first_site_leads(spark):
    _, got = _merged(spark, ["http://www.a.com/b", "http://a.com/a"])
    assert {site for site, _ in got} == {"http://www.a.com"}


def test_name_must_agree(spark):
    # "m." is no naming part but stays in the address, so these two stay apart.
    _, got = _merged(spark, ["http://m.a.com/b", "http://a.com/a"])
    assert {site for site, _ in got} == {"http://m.a.com", "http://a.com"}


def test_dedup_modes(spark):
    df = spark.createDataFrame([("l", 0, "http://a.com/u#1"), ("l", 1, "http://a.com/v"), ("l", 2, "http://a.com/u#2")], LINKS)
    grouped = sites.group_by_site(df)
    order = lambda d: [r.link for r in d.orderBy("ord").collect()]
    assert order(sites.dedup_fragments(grouped)) == ["http://a.com/u", "http://a.com/v"]
    kept = sites.dedup_fragments(grouped, strip=False)
    assert order(kept) == ["http://a.com/u#1", "http://a.com/v"]
    again = sites.dedup_fragments(kept.select(*sites.SITE_COLUMNS), strip=False)
    assert order(again) == order(kept)


def test_merge_keeps_every_link(spark):
    rows = [f"http{'s' * (i % 2)}://{'www.' * (i % 3 == 0)}s{i % 5}.org/{i % 7}" for i in range(120)]
    merged, _ = _merged(spark, rows)
    assert {r.link for r in merged.collect()} == set(rows)


def test_site_positions(spark):
    df = spark.createDataFrame([("l", 5, "http://a.com/x"), ("l", 2, "http://a.com/y"), ("l", 9, "http://b.com/")], LINKS)
    got = {(r.site_url, r.pos): r.link for r in sites.site_positions(sites.group_by_site(df)).collect()}
    assert got == {("http://a.com", 1): "http://a.com/y", ("http://a.com", 2): "http://a.com/x", ("http://b.com", 1): "http://b.com/"}


def test_robots(spark):
    cases = {
        "User-agent: CCBot\nDisallow: /x\nDisallow: /": True,
        "User-agent: CCBot\nUser-agent: Foo\nDisallow: /": False,
        "user-agent: CCBot\nDisallow: /": False,
        "User-agent: CCBot\nAllow: /\nDisallow: /": False,
        "User-agent: *\nDisallow: /": False,
        "User-agent: CCBot\r\nDisallow: /\r\nAllow: /": True,
        "User-agent: CCBot\nDisallow: / # all": False,
        "": False,
    }
    texts = [(f"http://s{i}", t) for i, t in enumerate(cases)] + [("http://none", None)]
    df = spark.createDataFrame(texts, "site_url string, robots_txt string")
    got = {r.site_url: r.blocked for r in robots.robots_verdict(df).collect()}
    assert got == {f"http://s{i}": v for i, v in enumerate(cases.values())} | {"http://none": False}
    links = spark.createDataFrame([("l", "n", "http://s0", 0, "x"), ("l", "n", "http://unknown", 1, "y")], "lid_label string, site_name string, site_url string, ord long, link string")
    assert [r.site_url for r in robots.robots_filter(links, df).collect()] == ["http://unknown"]


def _lookup_tables(spark):
    names = spark.createDataFrame([("bpy", "Bishnupriya")], "alpha3 string, name string")
    speakers = spark.createDataFrame([(1, "abk", 5.0), (0, "abk", 7.0), (2, "ace", None)], "ord int, iso_639_3_code string, estimated_number_of_speakers double")
    languoid = spark.createDataFrame(
        [(0, "a1", "f1", "Abk", "abk"), (1, "f1", None, "Fam", None), (2, "f1", None, "Later", None), (3, "a2", None, "Ace", "ace")],
        "ord int, id string, family_id string, name string, iso639P3code string",
    )
    return names, speakers, languoid


def test_catalogue_row(spark):
    names, speakers, languoid = _lookup_tables(spark)
    labels = spark.createDataFrame([("bpy_Beng",), ("abk_Cyrl",), ("ace_Latn",), ("odd",)], "lid_label string")
    lists = {"flag": ("lid_label", spark.createDataFrame([("abk_Cyrl",), ("abk_Cyrl",), (None,)], "code string"))}
    got = {r.lid_label: (r.language_name, r.speakers, r.family, r.subgrouping, r.flag) for r in lookups.language_catalogue(labels, names, speakers, languoid, lists).collect()}
    assert got == {
        "bpy_Beng": ("Bishnupriya", "No data", "No data", "", 0),
        "abk_Cyrl": ("abk", "7.0", "Fam", "", 1),
        "ace_Latn": ("ace", "NaN", "No data", "", 0),
    }


def test_speakers_fallback_keeps_empty_hit(spark):
    table = spark.createDataFrame([(0, "abk", "X", None), (1, "zzz", "BISHNUPRIYA", "9")], "ord int, alpha3 string, name string, speakers string")
    names, _, _ = _lookup_tables(spark)
    codes = spark.createDataFrame([("abk",), ("bpy",), ("nope",)], "code string")
    got = {r.code: r.speakers for r in lookups.speakers_fallback(codes, table, names).collect()}
    assert got == {"abk": None, "bpy": "9", "nope": None}


def test_bcp_codes(spark):
    iso = spark.createDataFrame([("en", "eng"), (None, "ace")], "alpha2 string, alpha3 string")
    tags = spark.createDataFrame([("en",), ("ace_Arab",), ("xx",), ("total*",)], "bcp47 string")
    assert {r.bcp47: r.iso3 for r in lookups.bcp_to_iso3(tags, iso).collect()} == {"en": "eng", "ace_Arab": "ace", "xx": None, "total*": "total*"}


def test_chain_and_report(spark, tmp_path):
    names, speakers, languoid = _lookup_tables(spark)
    crawled = spark.createDataFrame([("abk_Cyrl", 0, "http://a.com/x#1"), ("abk_Cyrl", 1, "https://a.com/x"), ("abk_Cyrl", 2, "http://no.org/")], LINKS)
    shut = spark.createDataFrame([("http://no.org", "User-agent: CCBot\nDisallow: /")], "site_url string, robots_txt string")
    made = jobs.format_catalogue(crawled, names, speakers, languoid, {})
    cleaned = jobs.clean_catalogue(made, shut)
    assert [(r.site_url, r.link) for r in cleaned.site_links.orderBy("link").collect()] == [("https://a.com", "http://a.com/x"), ("https://a.com", "https://a.com/x")]
    assert cleaned.sites().first().n_links == 2
    metadata = spark.createDataFrame([("abk_Cyrl", "seed_urls", "s"), ("zzz_Latn", "seed_urls", "t")], "lid_label string, kind string, url string")
    jobs.report(made.languages, metadata, [], path=str(tmp_path / "r"))
    rows = spark.read.option("header", True).csv(str(tmp_path / "r")).collect()
    assert len(rows) == 1 and rows[0].alpha_3_code == "abk_Cyrl" and rows[0].text_len is None and rows[0].acquired_urls == "0"
