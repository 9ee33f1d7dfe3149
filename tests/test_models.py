import math
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from linkloom.operators import lid, lm
from linkloom.plans import jobs
from linkloom.session import stored

TEXTS = [
    ("eng_Latn", 0, "the cat and the hat"), ("eng_Latn", 1, "then the dog\nran"), ("deu_Latn", 2, "der hund und die katze"),
    ("deu_Latn", 3, "das haus, der hof"), ("deu_Latn", 4, "ü\U0001F600ß"),
]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(TEXTS, "lid_label string, doc_id long, text string")


def brute_lid(texts, text, n=3, keep=False):
    counts = {}
    for label, _, t in texts:
        t = t.replace("\n", "")
        counts.setdefault(label, Counter()).update(t[i : i + n] for i in range(len(t) - n + 1))
    v = len(set().union(*counts.values()))
    t = text if keep else text.replace("\n", "")
    grams = [t[i : i + n] for i in range(len(t) - n + 1)]
    scores = {k: sum(math.log((c[g] + 1) / (sum(c.values()) + v)) for g in grams) for k, c in counts.items()}
    best = min(scores, key=lambda k: (-scores[k], k))
    return best, 1 / sum(math.exp(s - scores[best]) for s in scores.values())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6])
@pytest.mark.parametrize("keep", [False, True])
def test_both_predictors_equal_brute_force(spark, corpus, n, keep):
    asked = ["the dog", "die katze", "xyz", "zz", "", "der\nhund \U0001F600ß"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "k int, text string")
    profile = lid.fit_profile(corpus, n=n)
    by_arrow = lid.tag_language(df, lid.profile_predictor(profile), keep_newlines=keep)
    by_join = lid.tag_language(df.union(df), profile, keep_newlines=keep)
    for got in (by_arrow, by_join):
        rows = {r.k: r for r in got.collect()}
        for i, t in enumerate(asked):
            label, sure = brute_lid(TEXTS, t, n, keep)
            assert rows[i].predicted_lid == label and abs(rows[i].lid_confidence - sure) < 1e-9


def test_model_beyond_the_bound_is_joined(spark, corpus, monkeypatch):
    monkeypatch.setattr(lid, "MODEL_ROWS", 3)
    predictor = lid.fit_predictor(corpus)
    assert not callable(predictor)
    df = spark.createDataFrame([("the dog",), ("die katze",), (None,)], "text string")
    got = {r.text: r.predicted_lid for r in lid.tag_language(df, predictor).collect()}
    assert got == {"the dog": "eng_Latn", "die katze": "deu_Latn"}


def test_missing_text_is_not_tagged(spark, corpus):
    df = spark.createDataFrame([(None,), ("the",), ("",)], "text string")
    assert lid.tag_language(df, lid.fit_predictor(corpus)).count() == 2
    assert lid.tag_language(df, lid.fit_predictor(corpus), drop_empty=True).count() == 1


def test_batches_are_scored_in_parts(corpus, monkeypatch):
    model = lid.load_model(lid.fit_profile(corpus))
    texts = ["the dog and the cat", "", "der hund", "x" * 50, "das haus \U0001F600ß" * 9]
    whole = model.score(texts)
    monkeypatch.setattr(lid, "SCORED_CELLS", 5)
    assert abs(model.score(texts) - whole).max() < 1e-9


def test_pages_are_parsed_for_either_text(spark, corpus):
    links = spark.createDataFrame([("eng_Latn", "http://a/")], "lid_label string, link string")
    html = "<body><nav>the cat and the hat</nav><article>der hund und die katze</article></body>"
    pages = spark.createDataFrame([("http://a/", html)], "url string, html string")
    predictor = lid.fit_predictor(corpus)
    found = [lid.language_filter(links, pages, predictor, [], save_text=True, source=s).first().text for s in ("main", "stripped")]
    assert found == ["der hund und die katze", "the cat and the hat der hund und die katze"]


def test_cut_beyond_any_text(spark):
    df = spark.createDataFrame([("abc", 2**40), ("abc", 2)], "text string, room long")
    assert [r.t for r in df.select(lm.cut_to("text", F.col("room")).alias("t")).collect()] == ["abc", "ab"]


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_label_as_one_sentence(spark, order):
    texts = [("a", 1, "ab c"), ("a", 2, " "), ("a", 5, "d"), ("a", 900, "e"), ("a", 901, "fghijk"), ("b", 3, "xy"), ("c", 4, "")]
    df = spark.createDataFrame(texts, "lid_label string, doc_id long, text string")
    joined = {}
    for label, _, text in texts:
        joined[label] = joined.get(label, "") + text
    want = brute_counts([(k, 0, t) for k, t in joined.items() if t.strip()], order)
    rows = lm.ngram_counts(df, order, sentence_is="label").select("lid_label", "n", lm.shown("gram").alias("g"), "cnt").collect()
    assert {(r.lid_label, r.n, r.g): r.cnt for r in rows} == want


def test_raw_labels_and_tag_stripped_text(spark):
    fake = F.pandas_udf(lambda s: pd.DataFrame({"label": ["__label__bpy_Beng" if "a" in t else "junk" for t in s], "confidence": [0.9] * len(s)}), lid.PREDICTION)
    df = spark.createDataFrame([("a",), ("b",)], "text string")
    got = lid.tag_language(df, lambda c: fake(c), raw_labels=True)
    assert {r.text: r.predicted_lid for r in got.collect()} == {"a": "bpy_Beng", "b": None}


def test_save_text_is_optional(spark, corpus):
    links = spark.createDataFrame([("eng_Latn", "http://a/")], "lid_label string, link string")
    pages = spark.createDataFrame([("http://a/", "<body>the cat and the hat</body>")], "url string, html string")
    predictor = lid.fit_predictor(corpus)
    assert lid.filter_links(links, pages, predictor, 0.7).first().text == "the cat and the hat"
    assert "text" not in lid.filter_links(links, pages, predictor, 0.7, save_text=False).columns


def test_truncation_cuts_the_crossing_document(spark):
    df = spark.createDataFrame([("a", 1, "abc"), ("a", 2, "defg"), ("a", 3, "x"), ("b", 1, "12345")], "lid_label string, doc_id long, text string")
    got = {(r.lid_label, r.doc_id): r.text for r in lm.truncate_to_shortest(df).collect()}
    assert got == {("a", 1): "abc", ("a", 2): "de", ("b", 1): "12345"}


def brute_counts(texts, order):
    out = Counter()
    for label, _, t in texts:
        s = ["<s>", *[c for c in t if not c.isspace()], "</s>"]
        for n in range(1, order + 1):
            out.update((label, n, " ".join(s[i : i + n])) for i in range(len(s) - n + 1))
    return out


def test_counts_equal_brute_force(spark, corpus):
    rows = lm.ngram_counts(corpus, 4).select("lid_label", "n", lm.shown("gram").alias("g"), "cnt").collect()
    assert {(r.lid_label, r.n, r.g): r.cnt for r in rows} == brute_counts(TEXTS, 4)


@pytest.fixture(scope="module")
def model(corpus):
    return stored(lm.kn_model(stored(lm.ngram_counts(corpus, 3)), 3))


def _probability(table, label, history, token, order):
    """Longest match with backoff, as the model is meant to be read."""
    history = history[-(order - 1) :] if order > 1 else []
    gram = " ".join([*history, token])
    if (label, gram) in table and table[label, gram][0] is not None:
        return table[label, gram][0]
    if not history:
        return table[label, "<unk>"][0]
    backoff = table.get((label, " ".join(history)), (None, 0.0))[1]
    return backoff + _probability(table, label, history[1:], token, order)


def _table(model):
    return {(r.lid_label, r.g): (r.log10_prob, r.log10_backoff) for r in model.select("*", lm.shown("gram").alias("g")).collect()}


def test_probabilities_sum_to_one(model):
    table = _table(model)
    for label in ("eng_Latn", "deu_Latn"):
        words = [g for (l, g) in table if l == label and " " not in g and g != "<s>"]
        for history in ([], ["<s>"], ["t", "h"], ["e", "r"], ["q", "q"], ["<s>", "d"]):
            total = sum(10 ** _probability(table, label, history, w, 3) for w in words)
            assert abs(total - 1) < 1e-6, (label, history, total)


def test_unigrams_by_hand(spark):
    # "aab": adjusted counts are distinct left neighbours, a: {<s>, a}, b: {a}, </s>: {b}.
    df = spark.createDataFrame([("l", 0, "aab")], "lid_label string, doc_id long, text string")
    table = _table(lm.kn_model(stored(lm.ngram_counts(df, 2)), 2))
    # No n-gram of order 1 has an adjusted count of 3, so the discounts fall back to 0.5, 1, 1.5.
    free = (1.0 + 0.5 + 0.5) / 4
    assert abs(10 ** table["l", "a"][0] - ((2 - 1.0) / 4 + free / 4)) < 1e-12
    assert abs(10 ** table["l", "<unk>"][0] - free / 4) < 1e-12


def test_scores_equal_backoff_by_hand(spark, model):
    table = _table(model)
    asked = [("eng_Latn", 10, "the zebra"), ("deu_Latn", 11, "hut"), ("eng_Latn", 12, ""), ("deu_Latn", 13, "ω\U0001F600ψ q")]
    df = spark.createDataFrame(asked, "lid_label string, doc_id long, text string")
    got = {r.doc_id: r for r in lm.score_documents(df, model, 3).collect()}
    for label, doc, text in asked:
        s = ["<s>", *[c for c in text if not c.isspace()], "</s>"]
        want = sum(_probability(table, label, s[:i], s[i], 3) for i in range(1, len(s)))
        assert got[doc].n_tokens == len(s) - 1 and abs(got[doc].log10_prob - want) < 1e-9, text
        assert abs(got[doc].perplexity - 10 ** (-want / (len(s) - 1))) < 1e-6


def test_model_job_writes_arpa(spark, corpus, tmp_path):
    jobs.build_language_models(corpus, None, 2, str(tmp_path))
    files = sorted((tmp_path / "lid_label=eng_Latn").glob("*.txt"))
    lines = "".join(f.read_text() for f in files).split("\n")
    assert lines[0] == "\\data\\" and lines[1].startswith("ngram 1=") and "\\2-grams:" in lines and "\\end\\" in lines
    n = int(lines[1].split("=")[1])
    start = lines.index("\\1-grams:")
    assert all(len(x.split("\t")) in (2, 3) for x in lines[start + 1 : start + 1 + n]) and lines[start + 1 + n] == ""


def test_truncation_keeps_repeated_and_null_keys(spark):
    rows = [("a", 1, "abc")] * 3 + [("a", None, "xyz")] + [(None, 5, "0123456789"), (None, 6, "tail"), ("b", 7, "q" * 30)]
    found = lm.truncate_to_shortest(spark.createDataFrame(rows, "lid_label string, doc_id bigint, text string")).collect()
    got = sorted(((r.lid_label, r.doc_id, r.text) for r in found), key=repr)
    # Label a is the shortest with 12 characters.
    want = [*rows[:5], (None, 6, "ta"), ("b", 7, "q" * 12)]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("order", [2, 5])
def test_scores_of_random_texts_in_small_batches(spark, order):
    chance = random.Random(order)
    text = lambda letters, n: "".join(chance.choice(letters) for _ in range(n))
    learnt = [(l, i, text(a, chance.randint(0, 60))) for l, a in (("l", "aab c"), ("m", "bcd\U0001F600")) for i in range(12)]
    model = stored(lm.kn_model(stored(lm.ngram_counts(spark.createDataFrame(learnt, "lid_label string, doc_id long, text string"), order)), order))
    table = _table(model)
    asked = [(chance.choice("lm"), 2**60 + i, text("abcdq\U0001F600", chance.randint(0, 40))) for i in range(40)]
    # Repeated texts, no text, no label, a label without a model, an id of null.
    asked += [(l, d + 100, t) for l, d, t in asked[:9]] + [("l", None, "abc"), ("l", 1, None), (None, 2, "abc"), ("zz", 3, "abc")]
    df = spark.createDataFrame(asked, "lid_label string, doc_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    scored = lm.score_documents(df, model, order)
    got = {r.doc_id: r for r in scored.collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got) == {d for l, d, t in asked if l in ("l", "m") and t is not None}
    for label, doc, t in asked:
        if doc in got:
            s = ["<s>", *[c for c in t if not c.isspace()], "</s>"]
            want = sum(_probability(table, label, s[max(0, i - order + 1) : i], s[i], order) for i in range(1, len(s)))
            assert got[doc].n_tokens == len(s) - 1 and abs(got[doc].log10_prob - want) < 1e-8, (label, t)


def test_windows_move_once(spark, model):
    df = spark.createDataFrame([("eng_Latn", 10, "the zebra")], "lid_label string, doc_id long, text string")
    plan = lm.score_documents(df, model, 3)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    # The stream of windows and n-grams, apart from distinct ends of histories and the sums of documents.
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(block" in line]
    assert len(moved) == 1 and "Join" not in plan[: plan.index(moved[0])]


def test_memory_of_scoring_does_not_grow_with_the_batch(corpus, monkeypatch):
    import tracemalloc

    model = lid.load_model(lid.fit_profile(corpus))
    texts = ["the dog and the cat " * 100] * 1000
    whole = model.score(texts[:1])
    tracemalloc.start()
    scores = model.score(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6 and abs(scores - whole).max() < 1e-6
    monkeypatch.setattr(lid, "SCORED_CHARS", 7)
    mixed = ["the dog and the cat", "", "th", "the", "der hund das haus"]
    apart = [model.score([t])[0] for t in mixed]
    monkeypatch.undo()
    assert abs(model.score(mixed) - apart).max() < 1e-9


def test_arpa_lines_have_no_negative_zero(spark):
    rows = [("a", 1, "x", -4e-8, -3e-9), ("a", 1, "y", -6e-8, 0.0), ("a", 1, "z", -0.1234567, -1.0)]
    model = spark.createDataFrame(rows, "lid_label string, n int, gram string, log10_prob double, log10_backoff double")
    lines = [r.line for r in lm.arpa_lines(model, 2).filter("section = 1 AND part = 1").orderBy("line").collect()]
    assert lines == ["-0.0000001\ty\t0.0000000", "-0.1234567\tz\t-1.0000000", "0.0000000\tx\t0.0000000"]


def test_pages_of_one_url_are_judged_together(spark, corpus):
    """By hand: the gains of all pages are shared, each page counts with its own length."""
    profile = lid.fit_profile(corpus)
    model = lid.load_model(profile)
    pages = {"u": ["the cat", "the cat", "der hund und"], "v": ["das haus"], "w": ["the hat", "the hat"]}
    texts = spark.createDataFrame([(k, t) for k, ts in pages.items() for t in ts], "link string, text string")

    def by_hand(ts):
        scores = [model.score([t])[0] for t in ts]
        base = [max(len(t) - profile.n + 1, 0) * model.unseen for t in ts]
        gain = sum(s - b for s, b in zip(scores, base))
        flat = [x for b in base for x in (gain + b).tolist()]
        return model.labels[flat.index(max(flat)) % len(model.labels)], 1 / sum(math.exp(x - max(flat)) for x in flat)

    for predictor in (profile, lid.profile_predictor(profile)):
        found, kept = lid.tag_pages(texts, predictor)
        got = {r.link: (r.predicted_lid, r.lid_confidence) for r in found.collect()}
        assert found.count() == 3 and kept.count() == 6
        for link, ts in pages.items():
            label, sure = by_hand(ts)
            assert got[link] == (label, pytest.approx(sure, abs=1e-9))
    links = spark.createDataFrame([("eng_Latn", "w"), ("deu_Latn", "v")], "lid_label string, link string")
    assert lid.filter_links(links, texts, lid.profile_predictor(profile), 0.4, save_text=False).count() == 2
    assert lid.filter_links(links, texts, lid.profile_predictor(profile), 0.4).count() == 3


def test_join_scoring_holds_no_grams(spark, corpus):
    """Gains are grouped by text and label alone; grams of a text are never gathered in a hash table."""
    profile = lid.fit_profile(corpus)
    found = lid.tag_language(spark.createDataFrame([("the cat the cat",), ("der hund",)], "text string"), profile)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert grouped and not any("gram#" in line.split("Aggregate [")[1].split("]")[0] for line in grouped)
    assert {r.text: r.predicted_lid for r in found.collect()} == {"the cat the cat": "eng_Latn", "der hund": "deu_Latn"}
