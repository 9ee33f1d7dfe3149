"""Breadth-first expansion of seeds over the link graph, for all labels at once."""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import Column, DataFrame, Window, functions as F

from linkloom.constants import GROWTH_FACTOR, MAX_PAGES, MAX_URL_LENGTH
from linkloom.functions import urls
from linkloom.operators.filters import same_site_hosts
from linkloom.operators.pages import parse_pages
from linkloom.operators.sieve import sift
from linkloom.session import shared_path, stored

# Edges in a bucket of the link graph, and the most buckets (folders) it is filed under.
BUCKET_EDGES = 1_000_000
MOST_BUCKETS = 4096


@dataclass(frozen=True)
class LinkGraph:
    """Edges (src, dst, host, bucket), filed under a hash of src, and the hosts that each key may visit.

    An edge is there once, however many keys may follow it. Buckets are partition folders, so a level of a crawl
    reads those that its pages are in and no others. Their number follows that of the edges: a larger graph has more
    buckets, not larger ones, up to ``MOST_BUCKETS``.
    """

    edges: DataFrame
    allowed: DataFrame
    keys: tuple[str, ...]
    buckets: int

    def bucket(self, url: str) -> Column:
        return F.pmod(F.xxhash64(url), F.lit(self.buckets)).cast("int")

    def buckets_of(self, pages: DataFrame, url: str = "url") -> list[int]:
        """The buckets that hold the links of ``pages``: at most as many numbers as there are buckets."""
        return sorted(row[0] for row in pages.select(self.bucket(url)).distinct().collect())

    def links_of(self, pages: DataFrame, opened: list[int] | None = None) -> DataFrame:
        """``pages`` (keys, src, ...) with a row for each link (dst) that their key may follow; ``opened``: the buckets they are in."""
        opened = self.buckets_of(pages, "src") if opened is None else opened
        edges = self.edges if len(opened) == self.buckets else self.edges.filter(F.col("bucket").isin(opened))
        at_home = pages.withColumn("host", urls.netloc("src")).join(self.allowed, [*self.keys, "host"], "left_semi").drop("host")
        links = at_home.withColumn("bucket", self.bucket("src")).join(edges, ["src", "bucket"]).drop("bucket")
        return links.join(self.allowed, [*self.keys, "host"], "left_semi").drop("host")


def link_graph(edges: DataFrame, seeds: DataFrame, keys: list[str], max_length: int = MAX_URL_LENGTH, bucket_edges: int = BUCKET_EDGES) -> LinkGraph:
    """File the edges (src, dst) between hosts of the seeds' sites under buckets, sorted by src in each.

    They are stored first, which tells their size. A bucket that is too large for a task is written by several. Edges
    and keys meet only on the pages that a key visits, so the graph does not grow with the keys of a site.
    """
    ends = _with_hosts(edges, max_length)
    allowed = stored(_allowed_hosts(ends, seeds, keys), "allowed")
    sites = allowed.select("host").distinct()
    inside = ends.join(sites, "host", "left_semi").join(sites.withColumnRenamed("host", "src_host"), "src_host", "left_semi")
    flat = stored(inside.select("src", "dst", "host").distinct(), "edges")
    buckets = min(max(-(-flat.count() // bucket_edges), 1), MOST_BUCKETS)
    if buckets == 1:
        return LinkGraph(flat.withColumn("bucket", F.lit(0)), allowed, tuple(keys), 1)
    filed = LinkGraph(flat, allowed, tuple(keys), buckets)
    marked = flat.withColumn("bucket", filed.bucket("src")).hint("rebalance", "bucket").sortWithinPartitions("bucket", "src")
    return LinkGraph(stored(marked, "reach", ("bucket",)), allowed, tuple(keys), buckets)


@dataclass
class Crawl:
    """Visits (keys, url, depth, parent_rank, rank) and the links known at the end (keys, url)."""

    visits: DataFrame
    all_links: DataFrame


def site_hosts(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """(page_host): hosts of pages on the seeds' sites, found on the URL column alone."""
    hosts = pages.select(urls.netloc("url").alias("page_host"))
    return same_site_hosts(hosts, seeds.select(urls.netloc("url").alias("seed_host")), [], "page_host", "seed_host")


def parsed_site_pages(pages: DataFrame, seeds: DataFrame, source: str = "main") -> DataFrame:
    """(link, text, links) of the pages on the seeds' sites: the only ones a crawl can open.

    The HTML of other sites is dropped where it lies, and that of these sites is parsed there; only texts and links are joined.
    Hosts are stored, so their size is known: they go to the texts, or, when there are too many, Spark splits the texts of a large host.
    """
    hosts = stored(site_hosts(pages, seeds).distinct(), "hosts")
    parsed = parse_pages(sift(pages.select("url", "html"), urls.netloc("url"), hosts), source=source)
    return parsed.withColumn("page_host", urls.netloc("link")).join(hosts, "page_host").select(*parsed.columns)


def _with_hosts(edges: DataFrame, max_length: int) -> DataFrame:
    """Edges (src, dst, src_host, host) of bounded length."""
    short = edges.filter(F.length("dst") <= max_length)
    return short.select("src", "dst", urls.netloc("src").alias("src_host"), urls.netloc("dst").alias("host"))


def _allowed_hosts(ends: DataFrame, seeds: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, host): hosts of ``ends`` on a site of the key's seeds."""
    seed_hosts = seeds.select(*keys, urls.netloc("url").alias("seed_host"))
    hosts = ends.select("host").unionByName(ends.select(F.col("src_host").alias("host")))
    return same_site_hosts(hosts, seed_hosts, keys, "host", "seed_host")


def reachable_edges(edges: DataFrame, seeds: DataFrame, keys: list[str], max_length: int = MAX_URL_LENGTH) -> DataFrame:
    """Edges (keys, src, dst) that a key may follow: both ends on a site of the key's seeds."""
    ends = _with_hosts(edges, max_length)
    allowed = _allowed_hosts(ends, seeds, keys)
    sources = allowed.withColumnRenamed("host", "src_host")
    return (
        ends.join(allowed, "host")
        .join(sources, [*keys, "src_host"], "left_semi")
        .select(*keys, "src", "dst")
        .distinct()
    )


def crawl(
    seeds: DataFrame,
    edges: DataFrame,
    keys: list[str] | None = None,
    max_pages: int = MAX_PAGES,
    growth_factor: float | None = GROWTH_FACTOR,
    max_length: int = MAX_URL_LENGTH,
    seeds_are_links: bool = True,
    bucket_edges: int = BUCKET_EDGES,
) -> Crawl:
    """Visit pages first in, first out from each key's seeds until its budget is spent.

    ``seeds`` is (keys, url), ``edges`` is (src, dst). The order is fixed as
    (depth, least rank among linking pages, url), seeds by url. A page without
    edges counts as visited. With ``keys=['seed_id']`` and
    ``seeds_are_links=False`` each seed is crawled alone.

    The driver only loops over levels. Visits are bounded by keys times
    ``max_pages``. Each level is added to one stored table of visits, partitioned by
    depth, and reads the buckets of the graph that its pages are in. Stored tables have a
    known size: a level that is small is sent to the graph, which then is not shuffled.
    """
    keys = keys or ["lid_label"]
    starts = stored(seeds.select(*keys, "url").distinct(), "starts")
    graph = link_graph(edges, starts, keys, max_length, bucket_edges)

    by_url = Window.partitionBy(*keys).orderBy("url")
    by_parent = Window.partitionBy(*keys).orderBy("parent_rank", "url")
    first = (
        starts.withColumn("rank", F.row_number().over(by_url))
        .filter(F.col("rank") <= max_pages)
        .select(*keys, "url", F.lit(0).alias("depth"), F.lit(0).alias("parent_rank"), "rank")
    )
    path, schema = shared_path(starts.sparkSession, "visits"), first.schema

    def added(level: DataFrame, depth: int) -> DataFrame:
        level.drop("depth").write.parquet(f"{path}/depth={depth}")
        return starts.sparkSession.read.schema(schema).parquet(path)

    visits = added(first, 0)
    touched: set[int] = set()
    # A key visits at least one page per level, so the budget bounds the depth too.
    for depth in range(1, max_pages + 1):
        front = visits.filter(F.col("depth") == depth - 1)
        opened = graph.buckets_of(front)
        if not opened:
            break
        touched.update(opened)
        # Ranks run on, so the last one of a level says how much of the budget is spent.
        spent = front.groupBy(*keys).agg(F.max("rank").alias("spent"))
        found = (
            graph.links_of(front.select(*keys, F.col("url").alias("src"), "rank"), opened)
            .groupBy(*keys, F.col("dst").alias("url"))
            .agg(F.min("rank").alias("parent_rank"))
        )
        fresh = found.join(visits.select(*keys, "url"), [*keys, "url"], "left_anti")
        # The bound on the place lets each task keep only max_pages rows of a key.
        placed = fresh.withColumn("place", F.row_number().over(by_parent)).filter(F.col("place") <= max_pages)
        level = (
            placed.join(spent, keys)
            .withColumn("rank", (F.col("spent") + F.col("place")).cast("int"))
            .filter(F.col("rank") <= max_pages)
            .select(*keys, "url", F.lit(depth).alias("depth"), "parent_rank", "rank")
        )
        visits = added(level, depth)
    else:
        # The budget ended the crawl: the last level is opened, but nothing is visited from it.
        touched.update(graph.buckets_of(visits.filter(F.col("depth") == max_pages)))

    seen = sorted(touched)
    if growth_factor is not None:
        visits = stop_at_growth(visits, starts, graph, growth_factor, seen)
    links = opened_links(visits, graph, seen).select(*keys, F.col("dst").alias("url"))
    if seeds_are_links:
        links = links.unionByName(starts)
    return Crawl(visits, links.distinct())


def opened_links(visits: DataFrame, graph: LinkGraph, opened: list[int] | None = None) -> DataFrame:
    """(keys, opener, src, dst): the links met on visited pages."""
    pages = visits.select(*graph.keys, F.col("url").alias("src"), F.col("rank").alias("opener"))
    return graph.links_of(pages, opened)


def queue_sizes(visits: DataFrame, seeds: DataFrame, graph: LinkGraph, opened: list[int] | None = None) -> DataFrame:
    """(keys, rank, queue_size): how many URLs wait after each visit.

    A URL enters the queue behind its least-ranked opener. A page that links to
    itself enters once more, as it has left the queue but is not yet marked
    visited; that entry is skipped later. So the queue after visit k is the
    number of entries made up to k less the place of k's own entry.
    """
    keys = list(graph.keys)
    links = opened_links(visits, graph, opened)
    fresh = links.join(seeds.withColumnRenamed("url", "dst"), [*keys, "dst"], "left_anti")
    once = fresh.groupBy(*keys, "dst").agg(F.min("opener").alias("opener")).select(*keys, "opener", "dst", F.lit(False).alias("again"))
    again = links.filter(F.col("src") == F.col("dst")).select(*keys, "opener", "dst", F.lit(True).alias("again"))
    entries = once.unionByName(again)

    # One row per visit from here on: at most max_pages of them per key.
    made = entries.groupBy(*keys, "opener").agg(F.count(F.lit(1)).alias("made"))
    n_seeds = seeds.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_seeds"))
    upto = Window.partitionBy(*keys).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    totals = (
        visits.join(made.withColumnRenamed("opener", "rank"), [*keys, "rank"], "left")
        .join(n_seeds, keys)
        .withColumn("made", F.coalesce("made", F.lit(0)))
        .withColumn("entered", F.col("n_seeds") + F.sum("made").over(upto))
    )
    before = totals.select(*keys, F.col("rank").alias("opener"), (F.col("entered") - F.col("made")).alias("ahead"))
    # The entries of one opener are the links of one page.
    in_page = Window.partitionBy(*keys, "opener").orderBy("dst")
    places = (
        entries.withColumn("place", F.row_number().over(in_page))
        .filter(~F.col("again"))
        .join(before, [*keys, "opener"])
        .select(*keys, F.col("dst").alias("url"), (F.col("ahead") + F.col("place")).alias("queue_place"))
    )
    return totals.join(places, [*keys, "url"], "left").select(
        *keys, "rank", (F.col("entered") - F.coalesce("queue_place", "rank")).alias("queue_size")
    )


def stop_at_growth(visits: DataFrame, seeds: DataFrame, graph: LinkGraph, factor: float, opened: list[int] | None = None) -> DataFrame:
    """Cut each key's visits where the queue has outgrown them, looked at every tenth visit."""
    keys = list(graph.keys)
    sizes = queue_sizes(visits, seeds, graph, opened)
    tripped = (
        sizes.filter((F.col("rank") % 10 == 0) & (F.col("queue_size") > F.col("rank") * F.lit(factor)))
        .groupBy(*keys)
        .agg(F.min("rank").alias("stop"))
    )
    return (
        visits.join(tripped, keys, "left")
        .filter(F.col("stop").isNull() | (F.col("rank") <= F.col("stop")))
        .select(*visits.columns)
    )


def one_hop_links(seeds: DataFrame, edges: DataFrame, keys: list[str] | None = None, max_length: int = MAX_URL_LENGTH) -> DataFrame:
    """Same-site links met on the seed pages themselves (keys, url)."""
    keys = keys or ["lid_label"]
    starts = seeds.select(*keys, "url").distinct()
    reach = reachable_edges(edges, starts, keys, max_length)
    return (
        starts.withColumnRenamed("url", "src")
        .join(reach, [*keys, "src"])
        .select(*keys, F.col("dst").alias("url"))
        .distinct()
    )
