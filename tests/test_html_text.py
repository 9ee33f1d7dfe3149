import time
from html.parser import HTMLParser

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.functions import html, labels, markup, text
from linkloom.operators import pages

PAGE = (
    '<!DOCTYPE html><html lang="de"><head><title> A &amp; B </title><style>p{}</style>'
    '<meta name="description" content="d &lt;x&gt;"><meta content=\'k1, k2\' name="keywords">'
    '<script>var t="<a href=/no>"</script></head><body><nav><a href="/nav">n</a></nav><!-- <a href="/hid">h</a> -->'
    '<article><h1>Head</h1><p>One <b>two</b>\nthree<br>four</article><a class="x" href=\'q?a=1&amp;b=2\'>l</a>'
    '<a data-href="/d">d</a><a href=bare.html>b</a><a href="/nav">again</a><footer>f</footer></body></html>'
)


class TextCollector(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.pieces, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.pieces.append(data)


def parsed_text(source):
    collector = TextCollector()
    collector.feed(source)
    collector.close()
    return " ".join(" ".join(collector.pieces).split())


def _one(spark, column):
    return spark.createDataFrame([(PAGE,)], "html string").select(column.alias("x")).first().x


def test_html_to_text(spark):
    got = _one(spark, html.html_to_text("html"))
    assert got == "A & B n Head One two three four l d b again f"
    assert parsed_text(PAGE) == got


def test_main_text(spark):
    assert _one(spark, html.main_text("html")) == "Head\nOne two three\nfour"
    empty = spark.createDataFrame([("<html><body><nav>x</nav> </body></html>",), (None,)], "html string")
    assert [r.t for r in empty.select(html.main_text("html").alias("t")).collect()] == [None, None]


def test_links_and_metadata(spark):
    assert _one(spark, html.hrefs("html")) == ["/nav", "q?a=1&b=2", "bare.html"]
    headers = F.create_map(F.lit("Content-Language"), F.lit("fr"))
    meta = _one(spark, html.page_metadata("html", headers))
    assert tuple(meta) == ("de", "fr", "A & B", "d <x>", "k1, k2")
    none = spark.createDataFrame([("<p>x",)], "html string").select(html.page_metadata("html").alias("m")).first().m
    assert none is None


def test_page_links_resolve(spark):
    df = spark.createDataFrame([("http://h/a/b", PAGE)], "url string, html string")
    assert {r.dst for r in pages.page_links(df).collect()} == {"http://h/nav", "http://h/a/q?a=1&b=2", "http://h/a/bare.html"}


def test_failed_fetch_has_no_text(spark):
    links = spark.createDataFrame([("l", "http://h/a"), ("l", "http://gone/"), ("m", "http://h/a")], "lid_label string, link string")
    store = spark.createDataFrame([("http://h/a", "<body>hi</body>")], "url string, html string")
    got = {(r.lid_label, r.link, r.text) for r in pages.scrape_links(links, store).collect()}
    assert got == {("l", "http://h/a", "hi"), ("l", "http://gone/", None), ("m", "http://h/a", "hi")}


def test_tokeniser_and_newlines(spark):
    df = spark.createDataFrame([("ab cd",), ("\n\n",), ("",), ("a \U0001F600b\n",)], "t string")
    assert [r.x for r in df.select(text.char_tokenize("t").alias("x")).collect()] == ["a b  c d", "", "", "a  \U0001F600 b"]
    joined = spark.createDataFrame([("ab\ncd",)], "t string").select(text.drop_newlines("t").alias("x")).first().x
    assert joined == "abcd"


def test_char_ngrams(spark):
    df = spark.createDataFrame([("a\U0001F600b\nc",), ("ab",), ("",)], "t string")
    rows = df.select(text.char_ngrams("t", 3).alias("x"), text.char_ngrams("t", 3, True).alias("y")).collect()
    assert rows[0].x == ["a\U0001F600b", "\U0001F600b\n", "b\nc"]
    assert rows[0].y == ["a\U0001F600b", "\U0001F600b\n", "b\nc", "\nc", "c"]
    assert rows[1].x == [] and rows[1].y == ["ab", "b"] and rows[2].x == []


def test_labels(spark):
    df = spark.createDataFrame([("__label__bpy_Beng",), ("__label__zho",), ("x",)], "r string")
    assert [r.x for r in df.select(labels.extract_label("r").alias("x")).collect()] == ["bpy_Beng", None, None]


REFERENCES = [
    "It&#8217;s &eacute;t&#xe9; &amp;amp; &lt;b&gt; &nbsp;x", "&ampfoo &notit; &notin; &#0; &#x80; &#128; &#xD800; &#99999999999; &#1; &#; &#x;",
    "& && &unknown; &copy2 &CounterClockwiseContourIntegral; &fjlig;", "a&b=1&copy=2", "", "&#38;lt;", "&#x1F600;", "&#127; &#xfffe;&#13;&#9;", "&#000065;",
]


def test_references_as_in_the_standard_library(spark):
    import html as standard

    df = spark.createDataFrame([(t,) for t in REFERENCES], "t string")
    assert [r.u for r in df.select(html.unescape("t").alias("u")).collect()] == [standard.unescape(t) for t in REFERENCES]


def test_quoted_marks_and_decoys(spark):
    source = (
        '<a title="see href=bad" href="good">x</a><a data-x="1>2" href="/q?x=1&#38;y=2">y</a><a href=bare>b</a><a name=t>n</a>'
        "<A HREF='u'>c</A><p class=don't>z</p> 1 < 2"
    )
    df = spark.createDataFrame([(source,)], "h string")
    assert df.select(html.hrefs("h").alias("x")).first().x == ["good", "/q?x=1&y=2", "bare", "u"]
    assert df.select(html.html_to_text("h").alias("x")).first().x == "x y b n c z 1 < 2"


def test_text_equals_the_parser_on_all_pages(spark):
    stored = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = stored.select("html", html.html_to_text("html").alias("text")).collect()
    assert rows and all(r.text == parsed_text(r.html) for r in rows)


UNITS = ["<nav x ", "<form>x ", "<form ", '<a "', "<a '\"", "<p class=don't>", "<!-- ", "<script ", "</nav>", "<nav><form>", "<a \"'>", "< ", '<a href="x">t</a> text ']


@pytest.mark.parametrize("unit", UNITS)
def test_time_grows_in_proportion(unit):
    """Pages of a quarter and of one megabyte, unclosed tags and quotes among them, read in all four ways."""
    taken = []
    for size in (250_000, 1_000_000):
        page = unit * (size // len(unit))
        start = time.process_time()
        for read in (markup.blocks, markup.visible, markup.hrefs, markup.metadata):
            read(page)
        taken.append(time.process_time() - start)
    # Four times the page: far from sixteen times the time.
    assert taken[1] < 9 * max(taken[0], 0.03)


def test_unclosed_tags_are_read_by_their_quotes(spark):
    pages = {
        "<p>one<nav x": "one<nav x",
        '<p title="a>b>two</p> three': "b>two three",
        "<form>kept <b>text</b>": "kept text",
        "a <!-- gone": "a",
        "a <script>gone": "a",
        "a <script gone": "a",
        "x < y <= z": "x < y <= z",
        "</b>end<?pi ok?>": "end",
    }
    df = spark.createDataFrame([(k,) for k in pages], "h string")
    assert {r.h: r.t for r in df.select("h", html.html_to_text("h").alias("t")).collect()} == pages


# Whole pages without article, judged by hand: P is prose that stays, L lists of links and their labels that go.
LABELLED = [
    (
        "<body><ul><li><a href=/a>Home</a></li><li><a href=/b>News of the day</a></li></ul><div>Menu</div><p><a href=/c>All topics</a> |"
        " <a href=/d>Archive</a></p><p>The river rose by two metres in the night, as the <a href=/e>station</a> says.</p>"
        "<table><tr><td><a href=/f>Older</a></td><td>or</td><td><a href=/g>Newer</a></td></tr></table><p>It falls again.</p></body>",
        "The river rose by two metres in the night, as the station says.\nIt falls again.",
    ),
    (
        "<body><form action=/s>Search <p>Prose inside a form that nobody closed stays in the page, as browsers show it.</p>"
        "<div><a href=/1>One</a> <a href=/2>Two</a> <a href=/3>Three</a></div><p>Short.</p></body>",
        "Search\nProse inside a form that nobody closed stays in the page, as browsers show it.\nShort.",
    ),
    (
        "<body><nav><ul><li>Plain label</li><nav>inner</nav><li>more</li></ul></nav><h1>Title</h1><p>Text <a href=/x>with a link</a> in the middle of it,"
        " and more words after.</p><footer>Imprint</footer></body>",
        "Title\nText with a link in the middle of it, and more words after.",
    ),
    ("<body><p><a href=/1>only</a></p><p><a href=/2>links</a></p></body>", None),
]


def test_link_lists_go_and_prose_stays(spark):
    df = spark.createDataFrame(LABELLED, "h string, want string")
    for row in df.select("want", html.main_text("h").alias("got")).collect():
        assert row.got == row.want


def test_closed_forms_leave_references_without_an_end(spark):
    source = (
        "<html lang=de><head><title>a &lt;&amp;&amp</title></head><body><article><h1>a &lt;&amp;&amp</h1>"
        "<p>x &copy y &#38 z &#38; &#x26 &copy; and so on to the end</p></article></body></html>"
    )
    df = spark.createDataFrame([("http://h/1", source)], "url string, html string")
    line = "x &copy y &#38 z & &#x26 © and so on to the end"
    assert pages.page_texts(df, source="main_closed").first().text == f"a <&&amp\n{line}"
    assert pages.page_texts(df, source="stripped_closed").first().text == f"a <&&amp a <&&amp {line}"
    assert pages.page_metadata(df, bare=False).first().title == "a <&&amp"
    assert pages.page_metadata(df).first().title == "a <&&"


def test_a_url_with_two_pages_has_its_links_once(spark):
    rows = [("http://h/1", '<a href="/a">x</a><a href="/b">y</a>'), ("http://h/1", '<a href="/b">y</a><a href="/c">z</a>'), ("http://h/2", '<a href="/b">y</a>')]
    found = [(r.src, r.href) for r in pages.page_links(spark.createDataFrame(rows, "url string, html string")).collect()]
    assert sorted(found) == [("http://h/1", "/a"), ("http://h/1", "/b"), ("http://h/1", "/c"), ("http://h/2", "/b")]


def test_parsed_pages_of_one_url_keep_all_texts(spark, tmp_path):
    from linkloom.registry.urls_pages import parse_pages

    page = "<html><body><article><p>{}</p></article>{}</body></html>"
    rows = [(1, "http://h/1", page.format("one", '<a href="/a">x</a>')), (2, "http://h/1", page.format("two", '<a href="/b">x</a>'))]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = sorted((r.dst, r.text) for r in parse_pages(spark, str(tmp_path)).collect())
    assert found == [("http://h/a", "one"), ("http://h/a", "two"), ("http://h/b", "one"), ("http://h/b", "two")]


def test_visible_texts_leave_a_batch_in_slices(spark):
    """A worker holds a batch and a slice of its texts, not all texts of the batch once more as strings and as an array."""
    sources = ["<p>é" + "x" * 300_000, None, "", "<b>" + "y" * (3 << 20)] * 3
    made = list(html._visible_slices(iter([pa.array(sources), pa.array([], pa.string())])))
    assert max(map(len, made)) <= 4 and [x for part in made for x in part.to_pylist()] == [s and markup.visible(s) for s in sources]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sources)], "i long, source string").coalesce(1)
    rows = df.select("i", html.html_to_text("source").alias("t")).orderBy("i").collect()
    assert [r.t for r in rows] == [s and s[3:] for s in sources]
