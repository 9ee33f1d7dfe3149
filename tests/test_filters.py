import random

import pytest
from pyspark.sql import functions as F

from linkloom.constants import BLOCKLIST
from linkloom.operators import filters, sampling, sets
from linkloom.operators.ordering import position, running_total, with_line_numbers


def _links(spark, links):
    return spark.createDataFrame([(i, u) for i, u in enumerate(links)], "ord int, link string")


def test_blocklist_is_case_sensitive_substring(spark):
    df = _links(spark, ["http://a.com/Bible", "http://a.com/bible", None, "http://ok.org/"])
    assert [r.ord for r in filters.blocklist_filter(df, ["bible", "", "  "]).collect()] == [0, 3]


def test_minimal_entries_do_not_change_results(spark):
    assert len(filters.minimal_entries(list(BLOCKLIST))) < len(set(BLOCKLIST))
    links = [f"http://{e}/x" for e in BLOCKLIST] + ["http://fine.org/"]
    kept = [r.link for r in filters.blocklist_filter(_links(spark, links), list(BLOCKLIST)).collect()]
    assert kept == [u for u in links if not any(e in u for e in BLOCKLIST)]


def test_antijoin_equals_filter(spark):
    rnd = random.Random(3)
    word = lambda n: "".join(rnd.choice("abc.") for _ in range(n))
    links = ["http://" + word(rnd.randint(1, 30)) for _ in range(300)] * 2
    entries = [word(rnd.choice([1, 2, 3, 5, 8, 9, 12])) + "c" for _ in range(12)] + ["aabbaabb", ""]
    df = _links(spark, links)
    table = spark.createDataFrame([(e,) for e in entries], "entry string")
    got = sorted(r.ord for r in filters.blocklist_antijoin(df, table).collect())
    assert got == [i for i, u in enumerate(links) if not any(e and e in u for e in entries)]


@pytest.mark.parametrize("entries_each,automata", [(50_000, 16), (5, 64), (5, 1)])
def test_long_lists_equal_the_literal_filter(spark, monkeypatch, entries_each, automata):
    """One automaton, many small ones, and joins where there would be too many."""
    monkeypatch.setattr(filters, "AUTOMATON_ENTRIES", entries_each)
    monkeypatch.setattr(filters, "AUTOMATA", automata)
    rnd = random.Random(7)
    word = lambda n: "".join(rnd.choice("abcdé/.") for _ in range(n))
    links = [word(rnd.randint(0, 40)) for _ in range(500)] + ["", None, "a" * 5000]
    for n in (1, 30, 90):
        entries = [word(rnd.choice([2, 3, 4, 6, 9, 12])) for _ in range(n)] + [" ", "", None]
        got = filters.blocklist_antijoin(_links(spark, links), spark.createDataFrame([(e,) for e in entries], "entry string"))
        kept = [e.strip(" ") for e in entries if e and e.strip(" ")]
        assert sorted(r.ord for r in got.collect()) == [i for i, u in enumerate(links) if u is not None and not any(e in u for e in kept)]


def test_a_hundred_thousand_entries_move_no_row(spark):
    entries = spark.range(100_000).select(F.concat(F.lit("site-"), F.format_string("%06d", "id"), F.lit(".")).alias("entry"))
    links = spark.range(20_000).select("id", F.concat(F.lit("http://site-"), F.format_string("%06d", F.col("id") * 20), F.lit(".org/")).alias("link"))
    kept = filters.blocklist_filter(links, entries)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    assert kept.count() == 15_000 and kept.agg(F.min("id")).first()[0] == 5_000


def test_split_blocklist_filters_in_steps(spark):
    df = _links(spark, [f"http://{e}/x" for e in BLOCKLIST] + ["http://b.org/"])
    a, b = list(BLOCKLIST[:40]), list(BLOCKLIST[40:])
    both = filters.blocklist_filter(df, a + b).collect()
    assert both == filters.blocklist_filter(filters.blocklist_filter(df, a), b).collect()
    # A list beyond literals, and a table, give the same.
    more = a + b + [f"none-such-{i}" for i in range(501)]
    table = spark.createDataFrame([(e,) for e in more], "entry string")
    for entries in (more, table):
        assert {r.ord for r in filters.blocklist_filter(df, entries).collect()} == {r.ord for r in both}
    assert filters.blocklist_filter(df, table.limit(0)).count() == df.count()


def test_gates_at_the_threshold(spark):
    df = spark.createDataFrame([("x", "x", 0.7), ("x", "y", 0.9), ("x", "x", 0.71)], "lid_label string, predicted_lid string, lid_confidence double")
    assert filters.seed_gate(df).count() == 2
    assert {r.lid_confidence for r in filters.language_gate(df, "lid_label").collect()} == {0.7, 0.71}


def test_null_label_survives_exclusion(spark):
    df = spark.createDataFrame([("eng_Latn",), (None,), ("bpy_Beng",)], "predicted_lid string")
    codes = spark.createDataFrame([("eng_Latn",)], "code string")
    for listed in (codes, ["eng_Latn"]):
        assert {r[0] for r in filters.exclude_labels(df, listed).collect()} == {None, "bpy_Beng"}


def test_select_and_key_filters(spark):
    df = spark.createDataFrame([("a", None), ("b", "1")], "lid_label string, v string")
    assert filters.select_labels(df, spark.createDataFrame([("a",), ("a",)], "code string")).count() == 1
    assert filters.filter_by_key(df, "missing", None).count() == 2
    assert [r.lid_label for r in filters.filter_by_key(df, "v", None).collect()] == ["a"]
    assert filters.drop_empty(spark.createDataFrame([("",), (None,), ("x",)], "iso_code string")).count() == 1


def test_same_site_is_a_string_suffix(spark):
    links = spark.createDataFrame([("l", "http://evila.com/x"), ("l", "http://b.com/"), ("m", "http://b.com/"), ("e", "http://any/")], "lid_label string, link string")
    seeds = spark.createDataFrame([("l", "http://a.com/s"), ("m", "https://www.b.com/"), ("e", "no-host")], "lid_label string, seed_url string")
    got = {tuple(r) for r in filters.same_site_links(links, seeds, ["lid_label"]).collect()}
    assert got == {("l", "http://evila.com/x"), ("e", "http://any/")}
    assert filters.same_site_links(links, seeds, ["lid_label"], max_length=12).collect() == [("e", "http://any/")]


def test_per_seed_form(spark):
    links = spark.createDataFrame([(1, "http://x.a.com/"), (2, "http://x.a.com/")], "seed_id int, link string")
    seeds = spark.createDataFrame([(1, "http://a.com/"), (2, "http://b.com/")], "seed_id int, seed_url string")
    assert [r.seed_id for r in filters.same_site_links(links, seeds, ["seed_id"]).collect()] == [1]


def test_prune_nulls(spark):
    df = spark.createDataFrame([([None, {"a": "1", "b": None}],)], "x array<map<string,string>>")
    assert df.select(filters.prune_null_items("x").alias("y")).first().y == [{"a": "1"}]


def test_extract_codes_in_row_order(spark):
    df = spark.createDataFrame([(1, "c_D", "5", "x"), (0, "a_B", "e_F", None)], "ord int, p string, q string, r string")
    rows = filters.extract_codes(df, ["p", "q", "r"], "ord").orderBy("ord", "cell_no").collect()
    assert [r.code for r in rows] == ["a_B", "e_F", "c_D"]


def test_sets(spark):
    a = spark.createDataFrame([("a",), ("a",), ("b",)], "url string")
    b = spark.createDataFrame([("b",)], "url string")
    assert [r.url for r in sets.set_minus(a, b).collect()] == ["a"]
    assert sets.concatenate(a, b).count() == 4 and sets.set_union(a, b).count() == 2


def test_crawl_metadata_properties(spark):
    seeds = spark.createDataFrame([("l", "s1"), ("l", "s1"), ("l", "s2"), ("m", "s9")], "lid_label string, url string")
    filtered = spark.createDataFrame([("l", "s1"), ("l", "n1")], "lid_label string, url string")
    links = seeds.unionByName(filtered)
    metadata = sets.add_active_seeds(sets.crawl_metadata(seeds, links, filtered))
    by = {}
    for r in metadata.collect():
        by.setdefault((r.lid_label, r.kind), []).append(r.url)
    assert by["l", "unique_links"] == ["n1"] and by["l", "rejected_links"] == ["s2"] and by["l", "active_seed_urls"] == ["s1"]
    stats = {r.lid_label: r for r in sets.crawl_stats(metadata).collect()}
    assert stats["l"].seed_urls_len == 3 and stats["l"].all_website_links_len == 3 and stats["m"].rejected_links_len == 1


def test_running_total_over_ranges(spark):
    rnd = random.Random(1)
    # Sparse and dense order values, a hot key and a null one.
    rows = [(rnd.choice(["a", "a", "b", None]), i, rnd.randint(0, 9)) for i in rnd.sample(range(-(10**15), 10**15), 300) + list(range(100))]
    df = spark.createDataFrame(rows, "k string, ord long, v long").repartition(5)
    got = {(r.k, r.ord): (r.t, r.pos) for r in position(running_total(df, ["k"], "ord", F.col("v"), "t"), ["k"], "ord", "pos").collect()}
    assert len(got) == len(rows)
    for key in ("a", "b", None):
        total = 0
        for place, (_, o, v) in enumerate(sorted(r for r in rows if r[0] == key), 1):
            total += v
            assert got[key, o] == (total, place)


def test_line_numbers_over_many_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    (tmp_path / "f.txt").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        df = spark.read.text(str(tmp_path / "f.txt"))
        assert df.rdd.getNumPartitions() > 3
        assert [r.value for r in with_line_numbers(df).orderBy("line_no").collect()] == lines
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_many_files_are_numbered_as_one(spark, tmp_path):
    """Three files of different sizes, the largest last by name, in many splits."""
    lines, at = [f"line {i} " + "x" * (i % 50) for i in range(4000)], 0
    for name, size in (("a.txt", 300), ("b.txt", 700), ("c.txt", 3000)):
        (tmp_path / name).write_text("\n".join(lines[at : at + size]) + "\n")
        at += size
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        df = spark.read.text(str(tmp_path))
        assert df.rdd.getNumPartitions() > 8
        numbered = with_line_numbers(df).orderBy("line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.line_no, r.value) for r in numbered] == list(enumerate(lines))


def test_median_sample(spark):
    rows = [(0, "a", "x"), (1, "a", "xx"), (2, "a", "x" * 10), (3, "b", None), (4, "b", "12345"), (5, "b", "1234"), (6, None, "z")]
    df = spark.createDataFrame(rows, "ord int, iso_code string, transcription string")
    got = [(r.iso_code, r.ord, r.transcription) for r in sampling.median_sample(df).orderBy("iso_code", "diff_from_median", "ord").collect()]
    assert got == [("a", 1, "xx"), ("a", 0, "x"), ("b", 5, "1234"), ("b", 3, "nan")]


def test_median_of_even_group(spark):
    df = spark.createDataFrame([("a", n) for n in (1, 2, 10, 10)], "iso_code string, str_length int")
    assert sampling.median_lengths(df).first().median_length == 6.0


def test_every_gated_seed_is_looked_up(spark):
    from linkloom.registry import QUERIES
    from linkloom.registry.base import seed_table

    sf_dir = "/root/testdata/sf0.001"
    host = lambda url: url.split("//", 1)[1].split("/")[0].split("?")[0].split("#")[0]
    seeds = [(r["ord"], host(r["link"])) for r in seed_table(spark, sf_dir).filter("lid_confidence > 0.7").collect()]
    pages = [(r["page_id"], r["url"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    want = sorted((i, p, url) for i, h in seeds for p, url in pages if host(url).endswith(h))
    assert any(i % 2 for i, _, _ in want)
    assert sorted(map(tuple, QUERIES["same_site_every_seed"](spark, sf_dir).collect())) == want


def test_pairs_of_a_large_host_are_dealt_out(spark, monkeypatch):
    """All pairs, by brute force, and no task has more than a share of those of the one large host."""
    monkeypatch.setattr(filters, "PAIRS", 500)
    links = [(i, f"https://{'www.' if i % 3 else ''}big.org/{i}") for i in range(200)] + [(900, "https://a.net/x"), (901, "https://no.net/"), (902, "y")]
    seeds = [(i, "https://big.org/s" if i % 2 else "http://www.big.org/s") for i in range(40)] + [(70, "https://a.net/"), (71, "https://none.net/")]
    found = filters.same_site_pairs(
        spark.createDataFrame(links, "page_id long, link string"), spark.createDataFrame(seeds, "seed_id long, seed_url string"), ["seed_id"]
    )
    rows = [tuple(r) for r in found.withColumn("task", F.spark_partition_id()).collect()]
    host = lambda url: url.split("/")[2] if "//" in url else ""
    want = sorted((s, p, link) for s, seed in seeds for p, link in links if host(link).endswith(host(seed)))
    assert sorted(r[:3] for r in rows) == want and len(want) > 5000
    per_task = [sum(r[3] == t for r in rows) for t in {r[3] for r in rows}]
    assert max(per_task) < len(want) / 2
