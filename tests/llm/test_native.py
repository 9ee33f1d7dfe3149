"""The operators made of DataFrame functions alone: 2, 4, 7 and 9."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import check
from linkloom.llm import chat, exact_dedup, external_shuffle, mixing, queries

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, con, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    got = check.rows_of(found.columns, [tuple(r) for r in found.collect()])
    cursor = con.execute(queries.ORACLES[name])
    assert got == check.rows_of([d[0] for d in cursor.description], cursor.fetchall())


# Exact dedup.

COPIES = [
    (5, "a b", "x"),
    (2, "a  b ", "x"),  # most code points
    (1, "ab", "x"),
    (7, None, "x"),
    (8, "", "x"),
    (9, " \t\n", "x"),
    (3, "é" * 5, "x"),
    (None, "é" * 5, "x"),
    (4, "once", "x"),
    (6, "twice", "x"),
    (6, "twice", "x"),
]


def brute_copies(rows):
    groups = {}
    for i, t, _ in rows:
        t = t or ""
        key = t.translate({ord(c): None for c in exact_dedup.BLANKS})
        groups.setdefault(key, []).append((-len(t), i is None, i or 0, i))
    return {hashlib.sha256(k.encode()).hexdigest(): (min(v)[3], len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("heavy", [False, True])
def test_copies(spark, heavy, monkeypatch):
    # With PARTS this large every repeated digest is heavy; at 1 none but a table of one text is.
    monkeypatch.setattr(exact_dedup, "PARTS", 100 if heavy else 1)
    found = exact_dedup.mark_copies(docs(spark, COPIES)).collect()
    assert len(found) == len(COPIES)
    want = brute_copies(COPIES)
    for r in found:
        assert (r["keep_id"], r["group_size"]) == want[r["text_sha256"]]
    assert Counter(r["text_sha256"] for r in found if r["kept"]) == Counter(want.keys())
    assert sorted(map(str, (r["id"] for r in found))) == sorted(str(i) for i, _, _ in COPIES)


@pytest.mark.parametrize("heavy", [False, True])
def test_dropped_copies_keep_columns(spark, heavy, monkeypatch):
    monkeypatch.setattr(exact_dedup, "PARTS", 100 if heavy else 1)
    given = docs(spark, COPIES).withColumns({"kept": F.lit(1), "digest": F.lit("d"), "size": F.lit(2), "best": F.lit(3)})
    found = exact_dedup.drop_copies(given)
    assert found.columns == given.columns
    assert sorted(r["doc_id"] for r in found.collect()) == [2, 3, 4, 6, 9]


def test_no_copies_in_an_empty_table(spark):
    assert exact_dedup.mark_copies(docs(spark, [])).count() == 0
    assert exact_dedup.drop_copies(docs(spark, [])).count() == 0


def test_heavy_digests_are_found(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    heavy = exact_dedup.heavy_winners(exact_dedup.keyed(rows, carry=False)).collect()
    assert [(r["size"], r["best"]["id"]) for r in heavy] == [(1000, 0)]


# External shuffle.


def test_shards(spark):
    rows = [(i, "w" * (i % 50), "s") for i in range(500)] + [(1000, None, "s"), (None, "n", "s"), (3, "w" * 3, "s")]
    rows.append((2000, "long " * 50_000, "s"))
    given = docs(spark, rows).withColumn("shard", F.lit("own")).withColumn("slot", F.lit(1))
    found = external_shuffle.write_shards(given, shards=7, bucket_bytes=20_000).collect()
    assert sorted(map(repr, (tuple(r["row"]) for r in found))) == sorted(map(repr, map(tuple, given.collect())))
    sizes = Counter(r["shard"] for r in found)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(n))
    again = external_shuffle.write_shards(given, shards=7, bucket_bytes=20_000).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    other = external_shuffle.write_shards(given, shards=7, bucket_bytes=20_000, seed=5).collect()
    assert sorted(map(repr, found)) != sorted(map(repr, other))


def test_order_is_random(spark):
    found = external_shuffle.shuffled(docs(spark, [(i, "t", "s") for i in range(2000)]), shards=1, bucket_bytes=4000)
    at = {r["row"]["doc_id"]: r["slot"] for r in found.collect()}
    # The mean distance of a random permutation is a third of its length.
    mean = sum(abs(i - p) for i, p in at.items()) / len(at)
    assert 600 < mean < 730


def test_no_shards_of_an_empty_table(spark):
    assert external_shuffle.write_shards(docs(spark, [])).count() == 0


def test_shard_query(spark):
    found = queries.QUERIES["op4_external_shuffle"](spark, SF_DIR).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 8, zlib.crc32(data), "rows")
    sizes = Counter(r["shard"] for r in found)
    assert len(found) == sum(sizes.values()) and max(sizes.values()) - min(sizes.get(s, 0) for s in range(24)) <= 1


# Chat formatting.

TURNS = "conv_id long, turn long, role string, text string, example string"


def formatted(spark, rows):
    return chat.expand_prefixes(spark.createDataFrame([(*r, "other") for r in rows], TURNS))


def test_prefixes(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "A"), (1, 2, "user", "q"), (1, 3, "assistant", "B"), (1, 4, "user", "end")]
    found = {r["example"]: r for r in formatted(spark, rows).collect()}
    assert [found[i]["target_turn"] for i in range(3)] == [1, 3, None]
    assert [found[i]["last"] for i in range(3)] == [False, False, True]
    one = "<s>[INST] user [/INST]hi</s><s>[INST] assistant [/INST]A</s>"
    assert found[0]["text"] == one
    assert found[1]["text"].startswith(one) and found[2]["text"].startswith(found[1]["text"])
    for i, reply in ((0, "A"), (1, "B"), (2, "")):
        assert found[i]["text"][found[i]["loss_start"] : found[i]["loss_end"]] == reply


CONTROLS = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s>", "[\\/INST]", "<<s>", "[", "<", "", "\\", "[/INST", "s>", "é</s>é", " [/INST] ", "<s>[INST] x [/INST]y</s>"]


@pytest.mark.parametrize("text", CONTROLS)
def test_control_strings_come_back(spark, text):
    rows = [(1, 0, text, text), (1, 1, "assistant", text), (1, 2, "user", text)]
    found = formatted(spark, rows).select(
        "*",
        chat.read_turns(F.col("text")).alias("turns"),
        chat.read_loss(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss"),
    )
    last = found.where("last").first()
    assert [tuple(t) for t in last["turns"]] == [(r, t) for _, _, r, t in rows]
    assert found.where("target_turn is not null").first()["loss"] == text


def test_odd_turns(spark):
    rows = [(None, 0, "user", "u"), (2, None, None, None), (2, 0, "assistant", None), (2, 0, "assistant", None), (3, 0, "assistant", "x" * 300_000)]
    found = formatted(spark, rows).select("*", F.size(chat.read_turns(F.col("text"))).alias("n")).collect()
    assert sorted((str(r["conv_id"]), r["example"], r["n"]) for r in found) == [("2", 0, 2), ("2", 1, 3), ("3", 0, 1), ("None", 0, 1)]
    assert formatted(spark, []).count() == 0


# Mixing.


def corpus(spark, shares, words=20):
    rows, i = [], 0
    for s, n in shares.items():
        for _ in range(n):
            rows.append((i, " ".join(["w"] * words), s))
            i += 1
    return docs(spark, rows)


def test_weights_meet_the_repetition_limit(spark):
    given = corpus(spark, {"a": 800, "b": 100, "c": 100})
    found = mixing.mix_documents(given, max_repeats=2.0)
    n = Counter(r["source"] for r in found.collect())
    # Every document is read once, the small sources twice as often.
    assert n == {"a": 800, "b": 200, "c": 200}
    assert set(found.columns) == set(given.columns)


def test_weights_meet_the_entropy(spark):
    import math

    given = corpus(spark, {"a": 800, "b": 100, "c": 100})
    shares = mixing.source_shares(mixing.with_tokens(given, "doc_id", "text", "source", False))
    alpha, z, spend = mixing.find_exponent(shares, 0.9, 100.0, mixing.ALL)
    w = [p**alpha / z for p in (0.8, 0.1, 0.1)]
    assert sum(w) == pytest.approx(1) and spend == 20_000
    assert -sum(x * math.log(x) for x in w) == pytest.approx(0.9 * math.log(3), abs=1e-5)


def test_blocks_hold_all_sources(spark):
    taken = mixing.mix(corpus(spark, {"a": 800, "b": 400}), budget=24_000, entropy=1.0, max_repeats=9.0, block_tokens=4000)
    placed = mixing.with_slots(taken).collect()
    assert Counter(r["source"] for r in placed) == {"a": 600, "b": 600}
    for block in range(6):
        inside = [r for r in placed if r["block"] == block]
        assert Counter(r["source"] for r in inside) == {"a": 100, "b": 100}
        assert sorted(r["slot"] for r in inside) == list(range(200))
    # Two passes over b differ in order, and none repeats a document within a pass.
    passes = Counter((r["id"], r["pass"]) for r in placed)
    assert max(passes.values()) == 1


def test_documents_come_in_block_order(spark):
    given = corpus(spark, {"a": 300, "b": 100, "c": 50})
    options = {"max_repeats": 2.0, "block_tokens": 1000}
    placed = mixing.with_slots(mixing.mix(given, **options)).collect()
    assert max(r["block"] for r in placed) > 3
    want = [r["id"] for r in sorted(placed, key=lambda r: (r["block"], r["slot"]))]
    assert [r["doc_id"] for r in mixing.mix_documents(given, **options).collect()] == want


def test_no_task_numbers_all_documents_without_tokens(spark):
    rows = [(i, None, "none") for i in range(4000)] + [(5000 + i, "a b c", "s") for i in range(40)]
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        found = mixing.with_slots(mixing.mix(docs(spark, rows), budget=mixing.ALL, carry=False, seed=17), 17)
        found = found.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset(setting)
    key = lambda r: (hashlib.md5(f"17b:{r['pass']}:{r['id']}".encode()).hexdigest(), r["id"])
    assert [r["slot"] for r in sorted(found, key=key)] == list(range(4040))
    assert max(Counter(r["task"] for r in found).values()) < 0.5 * len(found)


def test_odd_sources(spark):
    rows = [(1, "a b", None), (2, None, None), (3, "", "empty"), (4, None, "empty"), (5, "x", "s"), (5, "x", "s")]
    given = docs(spark, rows).withColumns({"quota": F.lit(1), "of": F.lit(2), "pass": F.lit(3), "total": F.lit(4)})
    found = mixing.mix_documents(given, max_repeats=1.0)
    assert sorted(r["doc_id"] for r in found.collect()) == [1, 2, 3, 4, 5, 5]
    assert found.columns == given.columns
    assert mixing.mix_documents(docs(spark, [])).count() == 0
    assert mixing.mix_documents(docs(spark, [(1, None, "s")])).count() == 1
