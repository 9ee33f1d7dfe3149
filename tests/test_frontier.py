import random
import re

import pytest

from linkloom.operators import frontier


def simulate(seeds, graph, max_pages, factor):
    """One queue, one page at a time."""
    queue, visited, known = sorted(set(seeds)), [], set(seeds)
    while queue and len(visited) < max_pages:
        page = queue.pop(0)
        if page in visited:
            continue
        links = graph.get(page, set())
        known |= links
        queue += [u for u in sorted(links) if u not in visited and u not in queue]
        visited.append(page)
        if factor is not None and len(visited) % 10 == 0 and len(queue) > len(visited) * factor:
            break
    return visited, known


def graphs(n_labels, seed):
    rnd = random.Random(seed)
    out = {}
    for k in range(n_labels):
        n, degree = rnd.choice([5, 20, 60]), rnd.choice([1, 2, 4, 8])
        nodes = [f"http://k{k}.org/{i:03d}" for i in range(n)]
        seeds = rnd.sample(nodes, rnd.choice([1, 3]))
        graph = {
            u: set(rnd.sample(nodes, min(n, rnd.randint(0, degree)))) | ({u} if rnd.random() < 0.3 else set())
            for u in nodes
            if rnd.random() < 0.9
        }
        out[f"k{k}"] = (seeds, graph)
    return out


@pytest.mark.parametrize("max_pages,factor", [(30, 1.0), (25, None), (60, 0.5)])
def test_crawl_equals_a_queue(spark, max_pages, factor):
    cases = graphs(30, 5)
    seeds = spark.createDataFrame([(k, s) for k, (ss, _) in cases.items() for s in ss], "lid_label string, url string")
    edges = spark.createDataFrame([(u, v) for _, g in cases.values() for u, vs in g.items() for v in vs], "src string, dst string")
    done = frontier.crawl(seeds, edges, max_pages=max_pages, growth_factor=factor)
    visits, links = {}, {}
    for r in done.visits.orderBy("lid_label", "rank").collect():
        visits.setdefault(r.lid_label, []).append(r.url)
    for r in done.all_links.collect():
        links.setdefault(r.lid_label, set()).add(r.url)
    for k, (ss, g) in cases.items():
        assert (visits[k], links[k]) == simulate(ss, g, max_pages, factor), k


def test_guard_trips_on_one_wide_page(spark):
    nodes = [f"http://a.org/{i:02d}" for i in range(41)]
    seeds = spark.createDataFrame([("l", nodes[0])], "lid_label string, url string")
    edges = spark.createDataFrame([(nodes[0], u) for u in nodes[1:]], "src string, dst string")
    assert frontier.crawl(seeds, edges, growth_factor=1).visits.count() == 10
    assert frontier.crawl(seeds, edges, growth_factor=None).visits.count() == 41


def test_per_seed_crawl_and_one_hop(spark):
    seeds = spark.createDataFrame([(1, "http://a.org/"), (2, "http://b.org/")], "seed_id int, url string")
    edges = spark.createDataFrame(
        [("http://a.org/", "http://a.org/x"), ("http://a.org/x", "http://a.org/y"), ("http://a.org/", "http://b.org/z")],
        "src string, dst string",
    )
    done = frontier.crawl(seeds, edges, keys=["seed_id"], seeds_are_links=False)
    assert {tuple(r) for r in done.all_links.collect()} == {(1, "http://a.org/x"), (1, "http://a.org/y")}
    hop = frontier.one_hop_links(seeds, edges, ["seed_id"])
    assert {tuple(r) for r in hop.collect()} == {(1, "http://a.org/x")}


def test_page_sources_are_never_moved(spark):
    """Links and pages too large to be sent around: texts and links are exchanged, HTML is not; same rows."""
    from pyspark.sql import functions as F

    from linkloom.functions import html as H
    from linkloom.operators import pages as page_ops

    stored = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    links = stored.where("page_id % 3 = 0").select(F.col("url").alias("link"), "page_id")
    seeds = stored.where("page_id < 5").select("url")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for made in (page_ops.scrape_links(links, stored), frontier.parsed_site_pages(stored, seeds)):
            assert "html" in made._jdf.queryExecution().optimizedPlan().toString()
            assert not moved(made._jdf.queryExecution().executedPlan())
        got = {tuple(r) for r in page_ops.scrape_links(links, stored).select("link", "text").collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = stored.where("page_id % 3 = 0").select("url", H.main_text("html"))
    assert got == {tuple(r) for r in want.collect()}


def moved(plan):
    """Whether an exchange has the page source among its columns."""
    held = plan.children()
    below = [held.apply(i) for i in range(held.size())]
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        below = [plan.executedPlan()]
    own = "Exchange" in plan.getClass().getSimpleName() and "html#" in plan.output().toString()
    return own or any(moved(p) for p in below)


def test_sift_keeps_all_that_is_asked_for(spark):
    from pyspark.sql import functions as F

    from linkloom.operators.sieve import sift

    rows = spark.range(20000).select(F.concat(F.lit("u"), "id").alias("url"), "id").union(spark.createDataFrame([(None, -1)], "url string, id long"))
    asked = spark.range(0, 20000, 40).select(F.concat(F.lit("u"), "id")).union(spark.createDataFrame([(None,), ("other",)], "x string"))
    kept = {r.id for r in sift(rows, "url", asked).collect()}
    assert set(range(0, 20000, 40)) <= kept and len(kept) < 600 and -1 not in kept
    assert sift(rows, "url", asked.limit(0)).count() == 0


def test_buckets_give_the_same_crawl(spark):
    cases = graphs(12, 9)
    seeds = spark.createDataFrame([(k, s) for k, (ss, _) in cases.items() for s in ss], "lid_label string, url string")
    edges = spark.createDataFrame([(u, v) for _, g in cases.values() for u, vs in g.items() for v in vs], "src string, dst string")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    whole = frontier.crawl(seeds, edges, max_pages=12, growth_factor=0.5)
    filed = frontier.crawl(seeds, edges, max_pages=12, growth_factor=0.5, bucket_edges=20)
    assert rows(whole.visits) == rows(filed.visits) and rows(whole.all_links) == rows(filed.all_links)


def test_a_crawl_reads_the_buckets_of_its_pages(spark, monkeypatch):
    """A site ten times as large, of which the crawl meets the same pages: what is read of the graph stays the same."""
    read = {}

    def crawled(others):
        chain = [("http://a.org/%03d" % i, "http://a.org/%03d" % (i + 1)) for i in range(50)]
        rest = [(f"http://a.org/x{i}", f"http://a.org/x{i + 1}") for i in range(others)]
        edges = spark.createDataFrame(chain + rest, "src string, dst string")
        seeds = spark.createDataFrame([("l", "http://a.org/000")], "lid_label string, url string")
        edges_read, plain = [], frontier.LinkGraph.links_of

        def links_of(graph, pages, opened=None):
            edges_read.append(graph.edges.filter(graph.edges["bucket"].isin(opened)).count())
            plan = plain(graph, pages, opened)._jdf.queryExecution().executedPlan().toString()
            assert re.search(r"PartitionFilters: \[[^\n]*bucket#\d+ (IN|INSET|=)", plan)
            return plain(graph, pages, opened)

        monkeypatch.setattr(frontier.LinkGraph, "links_of", links_of)
        done = frontier.crawl(seeds, edges, growth_factor=None, bucket_edges=50)
        monkeypatch.setattr(frontier.LinkGraph, "links_of", plain)
        assert done.visits.count() == 51
        # All levels and the links at the end.
        return sum(edges_read)

    small, large = crawled(2000), crawled(20000)
    assert large < 1.5 * small and large < 51 * 2 * 50 * 1.5


def test_the_graph_does_not_grow_with_the_seeds_of_a_site(spark, monkeypatch):
    made, plain = [], frontier.link_graph

    def link_graph(*args, **options):
        made.append(plain(*args, **options))
        return made[-1]

    monkeypatch.setattr(frontier, "link_graph", link_graph)
    nodes = [f"http://a.org/{i:03d}" for i in range(60)]
    edges = spark.createDataFrame(list(zip(nodes, nodes[1:])) + [(nodes[0], "http://b.org/x")], "src string, dst string")
    seeds = spark.createDataFrame(list(enumerate(nodes)), "seed_id long, url string")
    done = frontier.crawl(seeds, edges, ["seed_id"], max_pages=3, growth_factor=None, seeds_are_links=False)
    assert sorted((r.seed_id, r.url) for r in done.visits.collect()) == sorted((i, u) for i in range(60) for u in nodes[i : i + 3])
    assert made[0].edges.count() == 59


def test_texts_of_a_host_are_not_dealt_out_by_host(spark):
    """Hosts are few: their texts stay where they were parsed, however many pages a host has."""
    pages = spark.createDataFrame([(f"http://a.org/{i}", "<p>text</p>") for i in range(20)] + [("http://b.org/", "<p>x</p>")], "url string, html string")
    parsed = frontier.parsed_site_pages(pages, spark.createDataFrame([("a", "http://a.org/0")], "lid_label string, url string"))
    assert "hashpartitioning(page_host" not in parsed._jdf.queryExecution().executedPlan().toString()
    assert parsed.count() == 20
