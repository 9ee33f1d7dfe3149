"""Operators on tables of fetched pages (url, html)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from linkloom.functions import html as H
from linkloom.functions import urls
from linkloom.functions.local import bind, work_out
from linkloom.operators.sieve import sift


# The closed forms decode only references that end in ``;``.
TEXT_OF = {
    "main": H.main_text,
    "stripped": H.html_to_text,
    "main_closed": partial(H.main_text, bare=False),
    "stripped_closed": partial(H.html_to_text, bare=False),
}


def _link_structs(url: str, hrefs: Column) -> Column:
    base = F.col(url)

    def resolved(parts):
        return F.transform(hrefs, lambda href: F.struct(href.alias("href"), urls.resolve_against(base, parts, href).alias("dst")))

    return bind(urls.split_base(base), resolved)


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (src, href, dst) of the link graph; one row per distinct target as written, also of a URL with several pages."""
    # Resolved before the explode: what a generator gives out is never worked out twice.
    read = work_out(pages.select(F.col(url).alias("src"), F.col(html).alias("html")), "hrefs", H.hrefs("html"))
    links = read.select("src", F.inline(_link_structs("src", F.col("hrefs"))))
    return links.select("src", "href", "dst").distinct()


def parse_pages(pages: DataFrame, url: str = "url", html: str = "html", source: str = "main") -> DataFrame:
    """(link, text, links): text and link targets of each page in one pass over its source."""
    read = pages.select(F.col(url).alias("link"), F.struct(TEXT_OF[source](html).alias("text"), H.hrefs(html).alias("hrefs")).alias("read"))
    made = work_out(read, "page", F.col("read"))
    links = F.array_distinct(F.transform(_link_structs("link", F.col("page.hrefs")), lambda link: link["dst"]))
    return made.select("link", F.col("page.text").alias("text"), links.alias("links"))


def page_texts(pages: DataFrame, url: str = "url", html: str = "html", source: str = "main") -> DataFrame:
    """(link, text) per page, worked out once: its main text, null where there is none, or all visible text."""
    sources = pages.select(F.col(url).alias("link"), F.col(html).alias("html"))
    return work_out(sources, "text", TEXT_OF[source]("html")).drop("html")


def page_metadata(pages: DataFrame, url: str = "url", html: str = "html", headers: str | None = None, bare: bool = True) -> DataFrame:
    """Language, title, description and keywords per page; all null where it has no ``<html>``."""
    column = F.col(headers) if headers else None
    return pages.select(url, H.page_metadata(html, column, bare).alias("m")).select(url, "m.*")


def wanted_texts(pages: DataFrame, links: DataFrame, link: str = "link", source: str = "main") -> DataFrame:
    """(link, text) of the pages that ``links`` names.

    Pages are sifted and parsed where they lie; their sources are never moved, and parsing grows with the links asked for.
    """
    wanted = links.select(F.col(link).alias("link")).distinct()
    # An inner join: the optimizer would push a semi join down to the page sources.
    return page_texts(sift(pages.select("url", "html"), "url", wanted), source=source).join(wanted, "link")


def scrape_links(links: DataFrame, pages: DataFrame, link: str = "link", source: str = "main") -> DataFrame:
    """Add the text of each link's page; null for a link that was not fetched."""
    texts = wanted_texts(pages, links, link, source).withColumnRenamed("link", link)
    return links.join(texts, link, "left")
