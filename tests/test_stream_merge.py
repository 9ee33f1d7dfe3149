import json

import pytest
from pyspark.sql import functions as F

from linkloom.sources import seeds
from linkloom.streaming import ingest, merge

SCHEMA = "iso_code string, line_no long, pos int, link string"


def results(code, line, n, note=""):
    return [{"iso_code": code, "line_no": line, "pos": i, "link": f"{code}/{line}/{i}{note}"} for i in range(n)]


# A repeated code, a late line, a line in two batches, a repeated file, nulls.
BATCHES = [
    results("ace", 1, 3) + results("abk", 2, 2) + results("bpy", 9, 2),
    results("ace", 4, 2) + results("bpy", 3, 5) + results("abk", 2, 4)[2:],
    results("ace", 4, 2) + results("ace", 1, 3),
    [{"iso_code": None, "line_no": 7, "pos": 0, "link": "n"}, {"iso_code": "abk", "line_no": None, "pos": 0, "link": "n"},
     {"iso_code": "new", "line_no": 5, "pos": None, "link": "p"}],
]


@pytest.mark.parametrize("rule", ["last", "append"])
def test_batches_restarts_and_replays_equal_the_batch_form(spark, tmp_path, rule):
    where = lambda name: str(tmp_path / name)
    (tmp_path / "in").mkdir()
    for number, rows in enumerate(BATCHES):
        (tmp_path / "in" / f"{number}.json").write_text("\n".join(map(json.dumps, rows)))
        # A new start each time, from the checkpoint.
        merge.merge(ingest.read_results(spark, where("in"), SCHEMA), rule, where("out"), where("state")).awaitTermination()
        seen = [r for batch in BATCHES[: number + 1] for r in batch if r["iso_code"] and r["line_no"]]
        once = spark.createDataFrame([tuple(r.values()) for r in {tuple(r.items()): r for r in seen}.values()], SCHEMA)
        want = seeds.merge_last(once) if rule == "last" else once
        got = merge.merged(spark, where("out"), SCHEMA, rule)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), number
    # The same files once more, under other names.
    log = spark.read.schema(SCHEMA).parquet(where("out")).count()
    for number, rows in enumerate(BATCHES):
        (tmp_path / "in" / f"again{number}.json").write_text("\n".join(map(json.dumps, rows)))
    merge.merge(ingest.read_results(spark, where("in"), SCHEMA), rule, where("out"), where("state")).awaitTermination()
    assert sorted(map(repr, merge.merged(spark, where("out"), SCHEMA, rule).collect())) == sorted(map(repr, got.collect()))
    assert spark.read.schema(SCHEMA).parquet(where("out")).count() <= log + 3


def test_a_batch_run_again_replaces_its_folder(spark, tmp_path):
    """The commit of the last batch is lost: it is run again and gives each row once."""
    where = lambda name: str(tmp_path / name)
    (tmp_path / "in").mkdir()
    for number in range(2):
        (tmp_path / "in" / f"{number}.json").write_text("\n".join(map(json.dumps, BATCHES[number])))
        merge.merge(ingest.read_results(spark, where("in"), SCHEMA), "append", where("out"), where("state")).awaitTermination()
    want = sorted(map(repr, merge.merged(spark, where("out"), SCHEMA, "append").collect()))
    for name in ("1", ".1.crc"):
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    merge.merge(ingest.read_results(spark, where("in"), SCHEMA), "append", where("out"), where("state")).awaitTermination()
    assert sorted(map(repr, merge.merged(spark, where("out"), SCHEMA, "append").collect())) == want


def test_a_hot_code_is_many_keys(spark):
    rows = spark.range(4000).select(F.lit("hot").alias("iso_code"), F.lit(1).alias("line_no"), F.col("id").cast("int").alias("pos"))
    parts = rows.groupBy(F.pmod(F.xxhash64("line_no", "pos"), F.lit(merge.PARTS))).count().collect()
    assert len(parts) == merge.PARTS and max(p["count"] for p in parts) < 400
