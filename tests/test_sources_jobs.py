import json

import pytest
from pyspark.sql import functions as F

from linkloom.constants import SEED_KEYS_EARLY, SEED_KEYS_LABEL
from linkloom.plans import jobs
from linkloom.sinks import files
from linkloom.sources import seeds, tables
from linkloom.streaming import ingest


def _fake(label="bpy_Beng"):
    return lambda c: F.struct(F.when(F.contains(c, F.lit("own")), label).otherwise("eng_Latn").alias("label"), F.lit(0.7).alias("confidence"))


def test_seed_queries(spark, tmp_path):
    (tmp_path / "q.txt").write_text("ace\thello you\nabk\tone\nbroken line\nbpy\ttwo\n")
    rows = seeds.read_seed_queries(spark, str(tmp_path / "q.txt"), 1, 4).orderBy("line_no").collect()
    assert [tuple(r) for r in rows] == [(1, "abk", "one"), (3, "bpy", "two")]


def test_search_dump(spark, tmp_path):
    dump = {"ace": [{"link": "a", "engines": ["x"]}, {"link": "b", "snippet": "s"}], "bpy": []}
    (tmp_path / "d.json").write_text(json.dumps(dump, indent=4))
    rows = seeds.read_search_dump(spark, str(tmp_path / "d.json")).orderBy("pos").collect()
    assert [(r.iso_code, r.pos, r.link, r.snippet) for r in rows] == [("ace", 0, "a", None), ("ace", 1, "b", "s")]
    assert rows[0].engines == ["x"]


def test_merge_rules(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "w")], "iso_code string, line_no long, link string")
    assert {r.link for r in seeds.merge_last(df).collect()} == {"y", "z", "w"}
    queries = spark.createDataFrame([(1, "q1"), (2, "q2")], "line_no long, query string")
    assert {(r.link, r.query) for r in seeds.merge_append([df], queries).collect()} == {("x", "q1"), ("y", "q2"), ("z", "q2"), ("w", "q1")}
    ranked = df.withColumn("pos", F.length("link"))
    assert seeds.top_results(ranked, 1).count() == 3


def test_seed_files(spark, tmp_path):
    good = [{"link": "a", "lid_confidence": 0.9, "predicted_lid": "x_Y"}]
    bad = good + [{"link": "b", "lid_confidence": 0.9}]
    for name, body in (("abk_Cyrl", json.dumps(good)), ("ace_Latn", json.dumps(bad)), ("odd_Latn", "{not json")):
        (tmp_path / f"{name}.json").write_text(body)
    rows = seeds.read_seed_files(spark, str(tmp_path)).collect()
    assert [(r.lid_label, r.link) for r in rows] == [("abk_Cyrl", "a")]
    assert seeds.read_seed_files(spark, str(tmp_path / "none")).count() == 0
    assert seeds.read_seed_files(spark, str(tmp_path), SEED_KEYS_EARLY).count() == 0
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "abk_Cyrl.json").write_text(json.dumps([{"link": "a", "lid_confidence": 0.9, "lid_label": "abk_Cyrl"}]))
    assert seeds.read_seed_files(spark, str(tmp_path / "z"), SEED_KEYS_LABEL).first().lid_label == "abk_Cyrl"


def test_lookup_sources(spark, tmp_path):
    (tmp_path / "b.txt").write_text("bible\n\n  islam \nbible\n")
    assert {r.entry for r in tables.read_blocklist(spark, str(tmp_path / "b.txt")).collect()} == {"bible", "islam"}
    (tmp_path / "l.json").write_text('[\n "a_B", null,\n "c_D"]')
    assert [r.code for r in tables.read_label_list(spark, str(tmp_path / "l.json")).collect()] == ["a_B", None, "c_D"]
    (tmp_path / "t.tsv").write_text("x\ty z\n1\ta\n2\tb\n")
    assert [tuple(r) for r in tables.read_ordered(spark, str(tmp_path / "t.tsv"), ["y z"], "\t").orderBy("ord").collect()] == [("a", 0), ("b", 1)]
    (tmp_path / "m.json").write_text(json.dumps({"resources": [{"id": "g1", "identifiers": [{"identifier": "abk", "type": "iso639-3"}]}]}))
    assert tables.read_identifier_map(spark, str(tmp_path / "m.json")).first().identifiers[0].identifier == "abk"


def test_glossed_corpus_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(0, "g1", 'say "hi",\nthen go'), (1, "g2", "x")], "ord int, glottocode string, transcription string")
    files.write_delimited(df, str(tmp_path / "c"))
    back = tables.read_delimited(spark, str(tmp_path / "c"), "ord int, glottocode string, transcription string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    entries = spark.createDataFrame([("g1", [("abk", "iso639-3")])], "id string, identifiers array<struct<identifier:string,type:string>>")
    assert [tuple(r) for r in jobs.sample_seeds(df, entries).collect()] == [("abk", 'say "hi",\nthen go')]


def test_label_sinks(spark, tmp_path):
    path = str(tmp_path / "o")
    df = spark.createDataFrame([("a", "1"), (None, "2")], "predicted_lid string, link string")
    files.append_by_label(df, path)
    files.append_by_label(df, path)
    back = spark.read.schema("link string, predicted_lid string").json(path)
    assert back.count() == 4 and back.filter(F.col("predicted_lid").isNull()).count() == 2
    files.overwrite_by_label(df.filter(F.col("link") == "1"), path, "predicted_lid")
    assert spark.read.schema("link string, predicted_lid string").json(path).count() == 3
    texts = spark.createDataFrame([("a", "ü x")], "lid_label string, text string")
    files.write_text_by_label(texts, str(tmp_path / "t"))
    assert (next((tmp_path / "t" / "lid_label=a").glob("*.txt"))).read_text(encoding="utf-8") == "ü x\n"


def test_metadata_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "seed_urls", "u"), ("b", "filtered_links", "v")], "lid_label string, kind string, url string")
    files.write_metadata(df, str(tmp_path / "m"))
    assert sorted(map(tuple, tables.read_metadata(spark, str(tmp_path / "m")).collect())) == sorted(map(tuple, df.collect()))


def test_expansion_and_final_filter(spark, tmp_path):
    entries = spark.createDataFrame(
        [("bpy_Beng", "http://a.org/", "x", 0.9), ("bpy_Beng", "http://a.org/low", "x", 0.7), ("bpy_Beng", "http://gone.org/", "x", 0.8), ("abk_Cyrl", "http://c.org/", "x", 0.1)],
        "lid_label string, link string, predicted_lid string, lid_confidence double",
    )
    pages = spark.createDataFrame(
        [
            ("http://a.org/", '<body>own <a href="n">x</a><a href="eng">y</a><a href="http://far.net/">z</a></body>'),
            ("http://a.org/n", "<body>own too</body>"),
            ("http://a.org/eng", "<body>other</body>"),
        ],
        "url string, html string",
    )
    done = jobs.expand_seeds(entries, pages, _fake(), blocklist=["bible"], path=str(tmp_path))
    # A link at exactly the minimum passes, a seed does not; the label without seeds gives nothing.
    assert {(r.lid_label, r.link) for r in done.crawled.collect()} == {("bpy_Beng", "http://a.org/"), ("bpy_Beng", "http://a.org/n")}
    kinds = {}
    for r in done.metadata.collect():
        kinds.setdefault(r.kind, set()).add(r.url)
    assert kinds["unique_links"] == {"http://a.org/n"} and kinds["rejected_links"] == {"http://gone.org/"}
    assert kinds["all_website_links"] == {"http://a.org/", "http://a.org/n", "http://a.org/eng", "http://gone.org/"}
    crawled, metadata = jobs.final_filter(done.crawled, tables.read_metadata(spark, str(tmp_path / "meta_data")), ["/n"])
    assert [r.link for r in crawled.collect()] == ["http://a.org/"]
    assert {r.url for r in metadata.filter("kind = 'active_seed_urls'").collect()} == {"http://a.org/"}


def test_search_filter_appends_by_language(spark, tmp_path):
    results = spark.createDataFrame([("abk", "http://a/"), ("abk", "http://b/"), ("abk", "http://bible/")], "iso_code string, link string")
    pages = spark.createDataFrame([("http://a/", "<body>own</body>"), ("http://b/", "<body>x</body>"), ("http://bible/", "<body>own</body>")], "url string, html string")
    jobs.search_language_filter(results, pages, _fake(), ["eng_Latn"], path=str(tmp_path / "o"))
    back = spark.read.json(str(tmp_path / "o")).collect()
    assert [(r.link, r.predicted_lid) for r in back] == [("http://a/", "bpy_Beng")]


def test_stream_files_each_record_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    one = {"iso_code": "abk", "snippet": "own", "link": "http://a/"}
    (tmp_path / "in" / "1.json").write_text(json.dumps(one))
    pages = spark.createDataFrame([("http://p/", "<body>own page</body>")], "url string, html string")
    for expected, extra in ((1, None), (2, {"iso_code": "abk", "snippet": "own 2", "link": "http://b/"})):
        if extra:
            (tmp_path / "in" / "2.json").write_text(json.dumps(extra))
        tag = lambda batch: ingest.tagged_results(batch, _fake(), ["eng_Latn"])
        ingest.ingest(ingest.read_results(spark, str(tmp_path / "in")), tag, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        assert spark.read.schema("link string").json(str(tmp_path / "out")).count() == expected
    (tmp_path / "in" / "3.json").write_text(json.dumps({"iso_code": "abk", "snippet": "s", "link": "http://p/"}))
    tag = lambda batch: ingest.tagged_results(batch, _fake(), ["eng_Latn"], pages=pages)
    ingest.ingest(ingest.read_results(spark, str(tmp_path / "in")), tag, str(tmp_path / "out2"), str(tmp_path / "state2")).awaitTermination()
    assert spark.read.schema("link string").json(str(tmp_path / "out2")).first().link == "http://p/"


@pytest.mark.parametrize("name", ["seed_files", "read_identifier_map"])
def test_no_file_holds_all_entries(spark, tmp_path, monkeypatch, name):
    from linkloom.registry import QUERIES, roundtrips

    sf_dir = "/root/testdata/sf0.001"
    want = sorted(map(repr, QUERIES[name](spark, sf_dir).collect()))
    monkeypatch.setattr(roundtrips, "FILE_ENTRIES", 3)
    monkeypatch.setattr(roundtrips, "shared_path", lambda spark, what: str(tmp_path / what))
    assert sorted(map(repr, QUERIES[name](spark, sf_dir).collect())) == want
    sizes = [f.read_text().count('"link"' if name == "seed_files" else '"id"') for f in tmp_path.rglob("part-*.txt")]
    assert len(sizes) > 3 and max(sizes) < 20 and sum(sizes) > max(sizes)


def test_runs_are_appended_once(spark, tmp_path):
    """Repeated, died midway and run again, compacted, repeated after that: each record once."""
    from pyspark.sql import functions as F

    from linkloom.sinks import runs

    path, schema = str(tmp_path / "store"), "n long, predicted_lid string"
    rows = lambda a, b: spark.range(a, b).select(F.col("id").alias("n"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("l/"), F.col("id") % 3)).alias("predicted_lid"))
    numbers = lambda: sorted(r.n for r in runs.read_runs(spark, path, schema).collect())
    assert runs.read_runs(spark, path, schema).count() == 0 and runs.compact(spark, path, schema) is None
    assert runs.append_run(rows(0, 10), path, "a/1") and not runs.append_run(rows(0, 10), path, "a/1")
    # An attempt that wrote its files and no manifest.
    files.overwrite_by_label(rows(10, 20), f"{path}/data/lost", "predicted_lid")
    assert numbers() == list(range(10))
    assert runs.append_run(rows(10, 20), path, "b") and runs.append_run(rows(0, 0), path, "none") and numbers() == list(range(20))
    name = runs.compact(spark, path, schema)
    assert runs.is_committed(spark, path, name) and numbers() == list(range(20))
    assert not runs.append_run(rows(10, 20), path, "b") and numbers() == list(range(20))
    assert runs.append_run(rows(20, 25), path, "c") and numbers() == list(range(25))
    assert runs.compact(spark, path, schema) and numbers() == list(range(25))
    assert {r.predicted_lid for r in runs.read_runs(spark, path, schema).collect()} == {None, "l/1", "l/2"}


def test_texts_of_a_large_group_are_not_gathered_for_the_median(spark, tmp_path):
    from linkloom.operators.lookups import add_iso
    from linkloom.operators.sampling import median_sample

    text = "repeat(sha2(cast(id as string), 256), 1 + cast(id % 3 as int))"
    spark.range(4000).selectExpr("id AS ord", "'g' AS glottocode", f"{text} AS transcription").write.parquet(f"{tmp_path}/c")
    corpus = spark.read.parquet(f"{tmp_path}/c")
    mapping = corpus.groupBy("glottocode").agg({"transcription": "max"}).selectExpr("glottocode", "'x' AS iso_code")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50000")
    try:
        sample = median_sample(add_iso(corpus, mapping))
        plan = sample._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
        assert [r.ord for r in sample.orderBy("ord").collect()] == [1, 4]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
