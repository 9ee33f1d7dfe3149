import json

import pytest
from pyspark.sql import functions as F

from linkloom.sinks import nested

SITE_LINKS = "lid_label string, site_name string, site_url string, ord long, link string"
LANGUAGES = "lid_label string, language_name string, speakers string, listed int"


def documents(path):
    """Each label's files, one after the other by name."""
    found = {}
    for folder in sorted(p for p in path.iterdir() if p.is_dir()):
        text = "".join(f.read_text() for f in sorted(folder.glob("part-*")))
        found[folder.name.split("=", 1)[1]] = json.loads(text)
    return found


def wanted(rows):
    by_label = {}
    for label, name, url, ord_, link in rows:
        by_label.setdefault(label or "__HIVE_DEFAULT_PARTITION__", {}).setdefault((name, url), []).append((ord_ is None, ord_ or 0, link or "", link))
    out = {}
    for label, sites in by_label.items():
        order = sorted(sites, key=lambda s: (*min(x[:2] for x in sites[s]), s[1], s[0]))
        out[label] = [
            {"Site Name": s[0], "Site URL": s[1], "Info": "i", "confidence": "c", "Links": [x[3] for x in sorted(sites[s], key=lambda x: x[:3])]} for s in order
        ]
    return out


ROWS = (
    [("a_X", f"s{i % 7}", f"http://s{i % 7}", i * 37 % 1000, f"http://s{i % 7}/{i}") for i in range(400)]
    # One site holds most links of one label, some repeated; some without a place in the input.
    + [("b_X", "big", "http://big", i % 500, f'http://big/"{i % 300}\\ü\n]}}') for i in range(3000)]
    + [("b_X", "set", "http://set", None, f"http://set/{i:03}") for i in range(50)]
    + [(None, "n", "http://n", 1, "x"), ("", "n", "http://n", 2, "y"), ("c_X", "z", "http://z", 1, '"Links":['), ("c_X", "z", "http://z", 2, None)]
)
LANGS = [("a_X", "A \"q\"", "NaN", 1), ("b_X", None, "No data", 0), ("d_X", "D", "3", 0), ("a_X", "B", "NaN", 1)]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("nested") / "out"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    nested.write_nested(spark.createDataFrame(LANGS, LANGUAGES), spark.createDataFrame(ROWS, SITE_LINKS).repartition(5), str(path), "i", "c")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return path


def test_documents_load(written):
    found, sites = documents(written), wanted(ROWS)
    assert set(found) == {"a_X", "b_X", "c_X", "d_X", "__HIVE_DEFAULT_PARTITION__"}
    for label, document in found.items():
        assert document.pop("Sites") == sites.get(label, []), label
    assert found["a_X"] == {"Language Name": 'A "q"', "Number of Speakers": "NaN", "listed": 1}
    assert found["b_X"]["Language Name"] is None and found["c_X"] == {} and found["d_X"]["Language Name"] == "D"


def test_a_label_is_written_by_many_tasks(written):
    assert len(list((written / "lid_label=b_X").glob("part-*"))) > 3


def test_read_back_as_links(spark, written):
    languages, links = nested.read_nested(spark, str(written))
    got = [(r.lid_label, r.site_no, r.site_name, r.site_url, r.info, r.confidence, r.link_no, r.link) for r in links.collect()]
    want = []
    for label, sites in wanted(ROWS).items():
        label = None if label.startswith("__") else label
        for i, s in enumerate(sites, 1):
            want += [(label, i, s["Site Name"], s["Site URL"], "i", "c", j, link) for j, link in enumerate(s["Links"], 1)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    fields = {r.lid_label: json.loads(r.fields) for r in languages.collect()}
    assert fields["d_X"] == {"Language Name": "D", "Number of Speakers": "3", "listed": 0, "Sites": []} and fields["c_X"] == {"Sites": []}


def test_other_labels_stay_and_empty_tables(spark, written, tmp_path):
    path = str(tmp_path / "out")
    langs, links = spark.createDataFrame(LANGS, LANGUAGES), spark.createDataFrame(ROWS, SITE_LINKS)
    nested.write_nested(langs.filter("lid_label = 'd_X'"), links.filter("lid_label = 'c_X'"), path, "i", "c")
    nested.write_nested(langs.filter("lid_label = 'd_X'").withColumn("language_name", F.lit("E")), links.limit(0), path, "i", "c")
    found = documents(tmp_path / "out")
    assert found["d_X"]["Language Name"] == "E" and len(found["c_X"]["Sites"][0]["Links"]) == 2
    nested.write_nested(langs.limit(0), links.limit(0), str(tmp_path / "none"), "i", "c")
