import json
import random

import pytest

from linkloom.sources import dumps, seeds

COLUMNS = ["iso_code", "pos", "snippet", "title", "link", "engines", "category", "query"]


def result(chance):
    odd = ['}', '{', '"', "\\", '\\"', "]", "[", ": [{", '": [{', "\n", "ü\U0001F600", "a", " ", ",", "}}"]
    text = lambda: "".join(chance.choice(odd) for _ in range(chance.randint(0, 12)))
    made = {"snippet": text(), "title": text(), "link": text(), "engines": [text() for _ in range(chance.randint(0, 3))], "category": None}
    if chance.random() < 0.3:
        made["extra"] = {"a": [{"b": [{}]}, {"c": text()}]}
    return made


def rows_of(df):
    return sorted((tuple(map(str, r)) for r in df.select(COLUMNS).collect()))


def wanted(objects):
    rows = []
    for o in objects:
        for code, found in o.items():
            rows += [(code, i, r["snippet"], r["title"], r["link"], r["engines"], r["category"], None) for i, r in enumerate(found)]
    return sorted(tuple(map(str, r)) for r in rows)


@pytest.mark.parametrize("indent", [None, 4])
def test_one_object_is_read_by_many_tasks(spark, tmp_path, indent):
    chance = random.Random(5)
    keys = ["eng", "", ': [], ', 'k"ey', "back\\", "{", "fra", "ü"] + [f"none{i}" for i in range(300)] + ["last"]
    one = {k: [result(chance) for _ in range(0 if k.startswith("none") else chance.randint(0, 40))] for k in keys}
    one["eng"] += [result(chance) for _ in range(300)]
    (tmp_path / "a.json").write_text(json.dumps(one, indent=indent, ensure_ascii=indent is None) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 10
    got = rows_of(dumps.read_split_dump(spark, str(tmp_path)))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == wanted([one]) == rows_of(seeds.read_search_dump(spark, str(tmp_path)))


def test_several_files_objects_and_odd_ones(spark, tmp_path):
    chance = random.Random(6)
    some = [{"eng": [result(chance) for _ in range(3)], "fra": []}, {}, {"deu": [result(chance)]}, {"eng": [result(chance)]}]
    (tmp_path / "a.json").write_text("\n".join(json.dumps(o) for o in some[:3]))
    (tmp_path / "b.json").write_text(json.dumps(some[3]))
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json").write_text('{"x": {"link": "no list"}, "y": [["z", {"link": "too deep"}], 3, null, "s"], '
                                     '"k}y": [{"link": "l"}, {"link": "m"}], "w": {"a": [{"b": {"c": 1}}], "d": {"e": {}}}, "v": ["}", "{}", {"link": "n"}], "u": [null, {"link": "n"}], "t": ["a", "b", {"link": "n"}]}')
    last = {"snippet": None, "title": None, "link": "n", "engines": None, "category": None}
    assert rows_of(dumps.read_split_dump(spark, str(tmp_path))) == wanted([*some, {"v": [last]}, {"u": [last]}, {"t": [last]}])


def test_what_is_before_a_break_is_read(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"eng": [{"link": "a"}, {"link": "b}"}, {"link": "c')
    rows = dumps.read_split_dump(spark, str(tmp_path)).collect()
    assert sorted((r.iso_code, r.pos, r.link) for r in rows) == [("eng", 0, "a"), ("eng", 1, "b}")]
