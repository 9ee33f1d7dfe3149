"""Conversation repair, tokenizer alignment and SentencePiece coding against brute force and the libraries."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import check
from linkloom.llm import alignment, conversation_repair as repair, queries, sentence_pieces

SF_DIR = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
TURNS = "conv_id long, turn long, role string, text string, conv string, fault string, digest string"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def texts(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


# Conversation repair.


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "c", "f", "d") for r in rows], TURNS)


def least_edits(rows):
    """(cost, audit, lines) by trying all edits, up to two rows inserted at each place."""
    seen, options = set(), []
    for role, text in rows:
        blank, again = not re.search(r"[^\x20\x09-\x0D]", text), (role, text) in seen
        seen.add((role, text))
        cut = 0 if re.search(r"[.!?][\x20\x09-\x0D]*$", text) else 3
        ways = [(4, "D", "", [])]
        if not blank and not again:
            ways.append((cut, "K", role[:1] or "-", [f"{role}:{text}"]))
            ways += [(cut + 3, "R", new[0], [f"{new}:{text}"]) for new in ("user", "assistant")]
        options.append(ways)
    added = [
        (3 * len(names), "I" * len(names), "".join(n[0] for n in names), [f"{n}:" for n in names])
        for names in [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    ]
    parts = [added]
    for ways in options:
        parts += [ways, added]
    best = None
    for way in itertools.product(*parts):
        if re.fullmatch("(s?(ua)+)?", "".join(w[2] for w in way)):
            found = (sum(w[0] for w in way), "".join(w[1] for w in way), [line for w in way for line in w[3]])
            best = found if best is None else min(best, found)
    return best


def random_rows(seed, convs, longest):
    pick = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(pick.randint(1, longest)):
            role = pick.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            text = pick.choice(["Yes.", "No", "Why?\t", " \n", "", None, "Yes.", f"t{turn}!"])
            rows.append((conv, pick.choice([turn, turn, turn, turn + 1, None]), role, text))
    return rows


def by_conversation(rows):
    plain = defaultdict(list)
    for conv, turn, role, text in rows:
        plain[conv].append((turn is not None, turn or 0, role if role is not None else " ", text if text is not None else " "))
    for conv, found in plain.items():
        found.sort(key=lambda r: (*r[:3], hashlib.sha256(r[3].encode()).hexdigest()))
    return plain


def test_repair_is_the_least_of_all_edits(spark):
    rows = random_rows(3, 120, 3) + [(None, 1, "assistant", "Hm."), (None, 2, "user", "Eh")]
    got = {r["conv_id"]: r for r in repair.audit(conversations(spark, rows)).collect()}
    plain = by_conversation(rows)
    assert set(got) == set(plain)
    for conv, found in plain.items():
        cost, audit, lines = least_edits([r[2:] for r in found])
        assert (got[conv]["cost"], got[conv]["audit"]) == (cost, audit), found
        assert got[conv]["repaired_sha256"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
        turns = [r[1] for r in found if r[0]]
        assert got[conv]["gaps"] == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        initials = [r[2][:1] for r in found]
        assert got[conv]["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def test_state_is_carried_over_batches_and_blocks(spark):
    """A giant conversation: same result in one block and in blocks of 7, read in batches of 10 rows."""
    rows = [(1, t // 2, random.Random(t).choice(["user", "assistant", "system"]), f"t{t % 40}.") for t in range(900)] + [(2, 1, "user", "a?")]
    given = conversations(spark, rows)
    whole = repair.audit(given).orderBy("conv_id").collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        assert repair.audit(given, size=7).orderBy("conv_id").collect() == whole
        edits = repair.repair(given, size=7).where("conv_id = 1").orderBy("place").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "".join(e["edit"] for e in edits) == whole[0]["audit"]
    left = [e for e in edits if e["edit"] != "D"]
    assert re.fullmatch("(s?(ua)+)?", "".join(e["role"][0] for e in left))
    assert hashlib.sha256("\n".join(f"{e['role']}:{e['text']}" for e in left).encode()).hexdigest() == whole[0]["repaired_sha256"]


def test_rows_without_conversations(spark):
    assert repair.audit(conversations(spark, [])).count() == 0
    one = repair.audit(conversations(spark, [(5, None, None, None)])).collect()
    assert [(r["audit"], r["cost"], r["blank"], r["gaps"]) for r in one] == [("D", 4, 1, 0)]


def test_repair_query_equals_sql(spark):
    assert check.compare(spark, check.connect(SF_DIR), "op11_conversation_repair", SF_DIR) is None


# SentencePiece.


def odd_texts(seed=4):
    pick = random.Random(seed)
    out = [None, "", " ", "  ", "\n", " a", "a ", "a  b", "▁", "a▁b", "<s> </s> <0x41> <unk>", "x" * 3000, "ab" * 900 + "=" * 900, "\x00a"]
    for letters in ("ab ", "aeinrst ", "  \n\t▁a", "éöüß中文字語 ", "\U0001f600\x00<> =", "the and ion ", "ab1 _-.,²½\n "):
        out += ["".join(pick.choice(letters) for _ in range(pick.randint(1, 60))) for _ in range(150)]
    return out


def test_ids_and_texts_are_the_library_s(spark, library, texts):
    given = odd_texts() + [t for _, t in texts]
    df = spark.createDataFrame([(i, t, [0]) for i, t in enumerate(given)], "n int, text string, ids array<int>")
    made = df.select("n", sentence_pieces.encode("text", PIECES).alias("made")).select("*", sentence_pieces.decode("made", PIECES).alias("back"))
    for row in made.collect():
        want = library.encode(given[row["n"]] or "")
        assert row["made"] == want and row["back"] == library.decode(want)


def test_pieces_join_to_exact_encodings(library):
    pick = random.Random(8)
    model = sentence_pieces.model(PIECES)
    pieces = list(model.ids)
    given = ["".join(pick.choice(pieces) for _ in range(pick.randint(1, 10))) for _ in range(1500)]
    ids, counts = model.encode(given)
    ends = np.cumsum(counts)
    assert [ids[e - c : e].tolist() for e, c in zip(ends, counts)] == library.encode(given)


def test_any_ids_decode_as_in_the_library(spark, library):
    pick = random.Random(9)
    odd = lambda: pick.choice([pick.randint(0, 31999), pick.randint(0, 3), 3 + pick.randint(128, 255), 28705, 3 + 0xE2, 3 + 0x96])
    lists = [[odd() for _ in range(pick.randint(0, 10))] for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in lists], "ids array<int>")
    for row in df.select("ids", sentence_pieces.decode("ids", PIECES).alias("text")).collect():
        assert row["text"] == library.decode(row["ids"]), row["ids"]
    odd_rows = spark.createDataFrame([([None, 40000, -1],), (None,), ([],)], "ids array<int>")
    assert [r[0] for r in odd_rows.select(sentence_pieces.decode("ids", PIECES)).collect()] == [" ⁇ " * 3, None, ""]


def test_sentence_piece_query(spark, library, texts):
    got = {r["doc_id"]: r for r in queries.op13_sentence_pieces(spark, SF_DIR).collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        ids = library.encode(text or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# Alignment.


def brute_alignment(rows, library):
    a_side = Tokenizer.from_file(BYTES)
    a_side.encode_special_tokens = True
    alphabet = alignment.byte_level_alphabet()
    named = {i: t for t, i in a_side.get_vocab().items()}
    held, made = Counter(), []
    for i, text in rows:
        a = a_side.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = library.encode(text) if text else []
        a_bytes = [bytes(alphabet[c] for c in named[x]) for x in a]
        b_bytes = [bytes([int(library.id_to_piece(x)[3:5], 16)]) if library.is_byte(x) else library.id_to_piece(x).replace("▁", " ").encode() for x in b]
        want = b" " + (text or "").encode()
        if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            a, b, a_bytes, b_bytes = [], [], [], []
        a_ends, b_ends = list(itertools.accumulate(map(len, a_bytes))), list(itertools.accumulate(map(len, b_bytes)))
        groups, start = [], 0
        for cut in sorted(set(a_ends) & set(b_ends)):
            groups.append(([x for x, e in zip(a, a_ends) if start < e <= cut], [x for x, e in zip(b, b_ends) if start < e <= cut]))
            start = cut
        links = Counter((x, y) for xs, ys in groups for x in xs for y in ys)
        held.update(links.keys())
        made.append((i, len(a), len(b), groups, links))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for i, n_a, n_b, groups, links in made:
        shown = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        best = sum(w for (x, y), w in links.items() if held[x, y] == most[x])
        out.append((i, n_a, n_b, len(groups), sum(links.values()), shown, best, sum(w * held[p] for p, w in links.items())))
    return sorted(out, key=repr)


def test_alignment_against_plain_python(spark, library, texts):
    rows = [(i, t[:1500] if t else t) for i, t in texts[:60]] + [(i, t) for i, t in enumerate(odd_texts()[:200])]
    rows += [(None, None), (7, "x"), (7, "x"), (None, "x"), (8, "<|endoftext|> x"), (9, "中文字\U0001f600 " + "=" * 300), (10, "   a 　 b\n \n c's")]
    df = spark.createDataFrame([(i, t, "p", 3) for i, t in rows], "doc_id long, text string, pairs string, block int").repartition(3)
    got = sorted((tuple(r) for r in alignment.align(df, BYTES, PIECES).collect()), key=repr)
    assert got == brute_alignment(rows, library)
    assert alignment.align(df.where("doc_id = -5"), BYTES, PIECES).count() == 0


def test_large_groups_are_joined_in_parts(monkeypatch):
    import pyarrow as pa

    pick = random.Random(2)
    docs = np.repeat(np.arange(4), 30)
    a = pa.table({"doc": docs, "id": [pick.randint(0, 9) for _ in docs]})
    b = pa.table({"doc": docs, "id": [pick.randint(0, 9) for _ in docs]})
    n = np.array([30] * 4)
    whole = alignment.linked_pairs(a, b, n, n, 100).sort_by([("doc", "ascending"), ("pair", "ascending")])
    monkeypatch.setattr(alignment, "PAIRS", 17)
    parts = alignment.linked_pairs(a, b, n, n, 100).sort_by([("doc", "ascending"), ("pair", "ascending")])
    assert parts.equals(whole) and sum(whole["links"].to_pylist()) == 4 * 30 * 30


def test_alignment_query(spark, library, texts):
    got = sorted((tuple(r) for r in queries.op12_tokenizer_alignment(spark, SF_DIR).collect()), key=repr)
    digests = [(*r[:5], hashlib.sha256(r[5].encode()).hexdigest() if r[5] else "", *r[6:]) for r in brute_alignment(texts, library)]
    assert got == sorted(digests, key=repr)


def test_stretches_are_encoded_once_by_both_tokenizers():
    both = alignment.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["one  two\nthree one", " one two ", "ab two two", "é\tone <s> two", "x"]
    whole = [both.b.encode(t) for t in texts], [both.a.encode(" " + t, add_special_tokens=False).ids for t in texts]
    asked, library = [], both.b

    class Counting:
        def encode(self, words, **options):
            asked.extend(words)
            return library.encode(words, **options)

    both.b = Counting()
    for _ in range(2):
        ids_a, ids_b = both.encode(texts)
        assert (ids_b.to_pylist(), ids_a.to_pylist()) == whole
    assert len(asked) == len(set(asked)) and sum(map(len, asked)) < sum(map(len, texts))


def test_models_with_pieces_across_words_are_not_cut():
    class Given:
        pieces = ["▁a", "b", "b▁a"]

        def normalize(self, text):
            return "▁" + text.replace(" ", "▁")

        def get_piece_size(self):
            return len(self.pieces)

        def id_to_piece(self, i):
            return self.pieces[i]

    assert not alignment.cuts_before_spaces(Given())
    Given.pieces = ["▁a", "b", "▁▁", "\n▁"]
    assert alignment.cuts_before_spaces(Given())
