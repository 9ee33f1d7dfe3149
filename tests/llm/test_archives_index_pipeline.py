"""Archive conversion, neighbour search and the pipeline against brute force."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkloom.llm import archives, multi_index, queries

SF_DIR = "/root/testdata/sf0.001"

# Archives.

PAGES = "page_id long, url string, html string, number string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "n", "d") for r in rows], PAGES)


def read_back(spark, given, **options):
    legacy = archives.write_arcs(given, **options)
    return archives.with_responses(archives.read_warcs(spark, archives.convert_arcs(spark, legacy)))


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [
    (1, "http://a.example/x y", "same"),
    (7, "https://a.example/\r\nb", "same"),
    (3, "http://b.example/", "same"),
    (4, "http://c.example/", None),
    (5, "http://d.example/", ""),
    (6, None, "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nHTTP/1.1 200 OK\r\n\r\n"),
    (8, "http://e.example/é", "http://x 0.0.0.0 20020101000000 text/html 5\nab\n" * 40),
    (9, "http://f.example/", "é" * 200_000),
    (-2, "", "X-Page-Id: 5\r\n"),
    (2**62 + 1, "no scheme", "z"),
]


@pytest.mark.parametrize("size", [1, 3000, 1 << 24])
def test_archives_round_trip(spark, size):
    found = {r["key"]: r for r in read_back(spark, pages(spark, ROWS).repartition(2), size=size).collect()}
    assert len(found) == len(ROWS)
    groups = defaultdict(list)
    for i, url, html in ROWS:
        groups[html or ""].append(i)
    for i, url, html in ROWS:
        first = max(groups[html or ""])
        r = found[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len((html or "").encode()), digest(html))
        assert (r["record_type"], r["refers_to"]) == (("response", None) if i == first else ("revisit", first))


def test_repeated_and_unnamed_pages(spark):
    rows = [(1, "http://a.example/", "x"), (1, "http://a.example/", "x"), (None, "http://a.example/", "x"), (None, "http://b.example/", "y")]
    found = read_back(spark, pages(spark, rows)).collect()
    assert Counter((r["key"], r["record_type"], r["refers_to"]) for r in found) == {
        (1, "response", None): 1,
        (1, "revisit", 1): 1,
        (None, "revisit", 1): 1,
        (None, "response", None): 1,
    }
    assert read_back(spark, pages(spark, [])).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    block = f"{version} 0 x\nfields\n".encode()
    data = f"filedesc://x.arc 1.2.3.4 20010203040506 text/plain {len(block)}\n".encode() + block + b"\n"
    data += archives.arc_record("http://a b/", "20010203040506", b"body\n\nmore", 5, version)
    data = data.replace(b"http://a%20b/", b"http://a b/")
    middle = "" if version == 1 else "0 - - 0 - "
    data += f"dns:a.example 1.2.3.4 2001 text/dns {middle}4\n1234\n".encode()
    data += f"http://cut/ 1.2.3.4 20010203040506 text/html {middle}400\nHTTP/1.0 200 OK\r\n\r\nshort".encode()
    info, page, dns, cut = archives.read_arc(data)
    assert (page.url, page.ip, page.date, page.cut) == ("http://a b/", "0.0.0.0", "20010203040506", False)
    assert page.block.endswith(b"body\n\nmore") and dns.block == b"1234" and cut.cut
    made = b"".join(archives.to_warc("x.arc", r) for r in (info, page, dns, cut))
    kinds = [(r.headers["WARC-Type"], r.headers["WARC-Date"], "WARC-Truncated" in r.headers) for r in archives.read_warc(made)]
    at = "2001-02-03T04:05:06Z"
    assert kinds == [("warcinfo", at, False), ("response", at, False), ("resource", archives.EPOCH, False), ("response", at, True)]
    ids = [r.headers["WARC-Record-ID"] for r in archives.read_warc(made)]
    assert len(set(ids)) == 4 and all(i.startswith("<urn:uuid:") for i in ids)
    assert list(archives.read_warc(made))[1].headers["WARC-Payload-Digest"] == f"sha1:{digest('body' + chr(10) * 2 + 'more')}"


def test_gzip_members_are_joined():
    parts = [b"one", b"two" * 1000]
    packed = b"".join(zlib.compress(p, wbits=31) for p in parts)
    assert archives.inflated(packed) == b"".join(parts) and archives.inflated(b"plain") == b"plain"


def test_archive_query(spark):
    given = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    last = {}
    for i in sorted(given):
        last[given[i] or ""] = i
    found = queries.QUERIES["op6_arc_to_warc"](spark, SF_DIR).collect()
    assert sorted(r["page_id"] for r in found) == sorted(given)
    for r in found:
        html = given[r["page_id"]] or ""
        assert (r["payload_bytes"], r["payload_digest"]) == (len(html.encode()), digest(html))
        assert r["refers_to"] == (None if last[html] == r["page_id"] else last[html])
        assert r["record_type"] == ("response" if last[html] == r["page_id"] else "revisit")


# Neighbours.

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_neighbours(rows, every, top):
    rows = {(i, tuple(v)): (i, np.array(v, dtype=float)) for i, v in rows}
    out = {}
    for i, v in rows.values():
        if i % every == 0:
            scored = []
            for j, w in rows.values():
                if j != i:
                    scored.append((-((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum()))), j))
            out[i] = [(j, -s) for s, j in sorted(scored)[:top]]
    return out


def search(spark, rows, **options):
    found = defaultdict(list)
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    for r in multi_index.search(frame, **options).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(found[r["query_id"]]) + 1
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    return found


def vectors(n, size=8, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(size=size).astype(np.float32).tolist()) for i in range(n)]


def test_small_tables_are_searched_whole(spark):
    rows = vectors(60)
    odd = [(100, None), (150, [0.0] * 8), (200, [1.0] * 7 + [None]), (250, [1.0] * 7 + [float("inf")]), (300, [1.0, 2.0])]
    assert {k: [j for j, _ in v] for k, v in search(spark, rows + odd).items()} == {
        k: [j for j, _ in v] for k, v in brute_neighbours(rows, 50, 5).items()
    }
    assert search(spark, rows[:1]) == {} and search(spark, []) == {}
    few = search(spark, rows[:3], every=1)
    assert {k: len(v) for k, v in few.items()} == {0: 2, 1: 2, 2: 2}


def test_equal_vectors_tie_by_id(spark):
    rows = vectors(40) + [(1000 + i, vectors(1)[0][1]) for i in range(300)] + [(0, vectors(1)[0][1])]
    found = search(spark, rows, every=50)
    want = brute_neighbours(rows, 50, 5)
    assert {k: [j for j, _ in v] for k, v in found.items()} == {k: [j for j, _ in v] for k, v in want.items()}
    assert [j for j, _ in found[1000]] == [0, 1001, 1002, 1003, 1004]
    assert len({s for _, s in found[1000]}) == 1


def test_scores_of_extreme_vectors(spark):
    """Components whose squares overflow or vanish, and rows that take no part."""
    rows = [(0, [1e200, 1e200]), (1, [1e-200, 1e-200]), (2, [3.0, 4.0]), (3, [1e-200, 0.0]), (4, [-1e300, 1e300])]
    odd = [(5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [0.0, 0.0]), (8, None), (9, [None, 1.0])]
    given = spark.createDataFrame([(i, v, "c") for i, v in rows + odd], "vec_id long, embedding array<double>, cell string")
    got = multi_index.search(given, every=1).orderBy("query_id", "rank").collect()
    assert len(got) == 5 * 4 and all(abs(r["score"]) <= 1 + 1e-12 for r in got)
    first = [(r["vec_id"], round(r["score"], 6)) for r in got if r["query_id"] == 0]
    assert first == [(1, 1.0), (2, round(7 / 5 / 2**0.5, 6)), (3, round(0.5**0.5, 6)), (4, 0.0)]


def test_recall_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK_ROWS", 50)
    monkeypatch.setattr(multi_index, "GROUP_QUERIES", 20)
    rows = vectors(4000, 16, 3)
    found, want = search(spark, rows), brute_neighbours(rows, 50, 5)
    assert set(found) == set(want)
    hits = sum(len({j for j, _ in found[k]} & {j for j, _ in want[k]}) for k in want)
    assert hits / (5 * len(want)) >= 0.9
    for k in found:
        truth = dict(brute_neighbours(rows, 50, len(rows))[k]) if k == 0 else {}
        assert all(truth[j] == s for j, s in found[k]) if truth else True


def test_cells_come_by_summed_distance():
    rng = np.random.default_rng(4)
    index = multi_index.MultiIndex(rng.normal(size=(500, 6)), 9)
    for left, right in zip(*index.halves(rng.normal(size=(20, 6)))):
        cells = list(index.walk(left, right))
        sums = [left[c // 9] + right[c % 9] for c in cells]
        assert sorted(cells) == list(range(81)) and sums == sorted(sums)


def test_neighbour_query(spark):
    given = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    want = brute_neighbours(given, 50, 5)
    found = defaultdict(set)
    for r in queries.QUERIES["op1_multi_index"](spark, SF_DIR).collect():
        found[r["query_id"]].add(r["vec_id"])
    assert sum(len(found[k] & {j for j, _ in want[k]}) for k in want) >= 0.9 * 5 * len(want)


# The pipeline.

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage gets and gives, over the small tables and some odd rows."""
    pick = random.Random(3)
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    words = "the cat and dog sat on a mat with his old friend near some river bank while".split()
    base = [" ".join(pick.choices(words, k=120)) for _ in range(3)]
    rows = [(10_000 + k, base[k % 3] + " end" * (k // 3 % 2), "en", "src1", 0) for k in range(12)]
    rows += [(20_000, None, "en", None, 0), (20_001, "", None, "src2", 0), (20_002, "12 34", "en", "src2", 0)]
    docs = given.unionByName(spark.createDataFrame(rows, DOCS))
    seen = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        seen.append(docs.collect())
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == given.columns
            docs = spark.createDataFrame(seen[-1], given.schema)
    return seen


def test_unknown_languages_go(stages):
    left = {r["doc_id"] for r in stages[1]}
    gone = {r["doc_id"] for r in stages[0]} - left
    assert gone == {20_000, 20_001, 20_002}


@pytest.mark.parametrize("words", [25, 4000])
def test_unseen_scripts_go_at_every_size(spark, words):
    pick = random.Random(words)
    known = {
        "en": "the cat and dog sat on a mat with his old friend near some river bank while it was raining in town".split(),
        "de": "der Hund und die Katze saßen auf dem alten Dach bei ihrem Freund während es in der Stadt regnete".split(),
    }
    rows = [(k, " ".join(pick.choices(known[g], k=words)), g, "s", 0) for k, g in enumerate(["en", "de"] * 20)]
    # Without a language these are not trained on.
    rows += [(100, "Η γάτα και ο σκύλος κάθισαν στο χαλί με τον παλιό φίλο του κοντά στην όχθη", None, "s", 0)]
    rows += [(101, "Кошка и собака сидели на ковре со своим старым другом у берега реки", None, "s", 0)]
    rows += [(102, "猫和狗坐在河边的垫子上和他的老朋友在一起读书写字", None, "s", 0), (103, "the old cat was near the river", None, "s", 0)]
    kept = corpus_pipeline.language_id(spark, spark.createDataFrame(rows, DOCS), SF_DIR)
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(40), 103]


def test_no_copies_stay(stages):
    key = lambda r: "".join(c for c in r["text"] if c not in " \t\n\x0b\x0c\r")
    best = {}
    for r in stages[1]:
        best[key(r)] = min(best.get(key(r), (1, 0)), (-len(r["text"]), r["doc_id"]))
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(i for _, i in best.values())


def test_no_near_copies_stay(stages):
    from tests.llm.test_documents import brute_components

    # The stage links from 0.80 on.
    want = brute_components([(r["doc_id"], r["text"]) for r in stages[2]], part=80)
    assert sorted(r["doc_id"] for r in stages[3]) == sorted({c for _, _, c in want})


def test_near_copies_from_80_percent_go(spark):
    from tests.llm.test_documents import shingles

    pick = random.Random(11)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for k in range(40):
        base = pick.choices(words, k=120)
        # Words changed at one end take one shingle each: similarities from 0.72 to 0.93.
        own = base[: -(4 + k % 16)] + pick.choices(words, k=4 + k % 16)
        rows += [(2 * k, " ".join(base), "en", "s", 0), (2 * k + 1, " ".join(own), "en", "s", 0)]
    sets = [shingles(t) for _, t, *_ in rows]
    near = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    between = [(a, b) for a, b in near if 100 * len(sets[a] & sets[b]) < 85 * len(sets[a] | sets[b])]
    assert len(between) > 5 and len(near) < 40
    kept = corpus_pipeline.remove_near_copies(spark, spark.createDataFrame(rows, DOCS), SF_DIR)
    # No text has two near copies, so the greater id of each pair goes.
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(range(80)) - {a for a, _ in near})


def test_all_documents_are_mixed(stages):
    before, after = Counter(r["doc_id"] for r in stages[3]), Counter(r["doc_id"] for r in stages[4])
    assert set(before) == set(after) and max(after.values()) <= 2
    assert {tuple(r) for r in stages[4]} == {tuple(r) for r in stages[3]}


def test_all_documents_are_packed(stages):
    from tests.llm.test_documents import check_packing

    check_packing([(r["doc_id"], r["text"]) for r in stages[4]], stages[5], 2048)


def test_pipeline_runs(spark):
    assert set(corpus_pipeline.run(spark, SF_DIR).columns) >= {"doc_id", "piece", "sequence_id", "offset"}


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0
