"""Site catalogue: grouping links by site, merging site variants, link dedup.

Links stay flat, one row each. A site's link list is the set of its rows in
the order of ``(ord, link)``; no operator gathers a site into one value, since a
single site may hold a large share of all links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkloom.functions import urls
from linkloom.operators.ordering import position

SITE_COLUMNS = ("lid_label", "site_name", "site_url", "ord", "link")


def group_by_site(links: DataFrame) -> DataFrame:
    """(lid_label, ord, link) with the site each link belongs to; no shuffle."""
    return links.select(
        "lid_label",
        urls.site_name(urls.netloc("link")).alias("site_name"),
        urls.site_url("link").alias("site_url"),
        "ord",
        "link",
    )


def site_positions(site_links: DataFrame) -> DataFrame:
    """Add each link's place in its site's list, by input order."""
    return position(site_links, ["lid_label", "site_url"], "ord")


def domain_distribution(site_links: DataFrame) -> DataFrame:
    return site_links.groupBy("lid_label", "site_url").agg(F.count(F.lit(1)).alias("n_links"))


def merge_sites(site_links: DataFrame) -> DataFrame:
    """Join sites of one label that share name and protocol-free address.

    The result goes under the group's first https site, else its first site.
    Links of a joined group are a sorted set (``ord`` is null and ``link`` is the
    order); the list of a site that stays alone is untouched, repeats included.
    """
    group = ["lid_label", "site_name", "norm"]
    sites = (
        site_links.groupBy("lid_label", "site_name", "site_url")
        .agg(F.min("ord").alias("first_ord"))
        .withColumn("norm", urls.site_norm("site_url"))
    )
    # A site address says all about its own group, so groups are far fewer than links.
    preferred = F.struct(~F.startswith("site_url", F.lit("https")), F.col("first_ord"))
    groups = sites.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_sites"), F.min_by("site_url", preferred).alias("base_url")
    )
    plan = sites.join(groups, group).select("lid_label", "site_url", "base_url", "n_sites")
    placed = site_links.join(plan, ["lid_label", "site_url"])
    return placed.select(
        "lid_label",
        "site_name",
        F.col("base_url").alias("site_url"),
        F.when(F.col("n_sites") == 1, F.col("ord")).alias("ord"),
        "link",
    ).distinct()


def dedup_fragments(site_links: DataFrame, strip: bool = True) -> DataFrame:
    """First link of each fragment-free address per site, in list order.

    ``strip`` gives out the fragment-free form, otherwise the link as it was.
    """
    first = F.min(F.struct("ord", "link")).alias("first")
    kept = (
        site_links.withColumn("clean", urls.strip_fragment("link"))
        .groupBy("lid_label", "site_name", "site_url", "clean")
        .agg(first)
    )
    link = F.col("clean") if strip else F.col("first.link")
    return kept.select(
        "lid_label",
        "site_name",
        "site_url",
        F.col("first.ord").alias("ord"),
        F.col("first.link").alias("first_link"),
        link.alias("link"),
    )
