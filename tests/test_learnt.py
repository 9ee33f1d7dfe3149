import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from linkloom.operators import learnt, lid
from linkloom.registry.base import text_table

SF = "/root/testdata/sf0.01"


def dense_fit(x, y, n_labels, penalty, steps=40):
    """Newton's method on the whole matrix: mean loss plus penalty / 2 times the squared weights, intercepts free."""
    rows, width = x.shape
    held = np.hstack([x, np.ones((rows, 1))])
    size = n_labels * (width + 1)
    target = np.eye(n_labels)[y]
    weights = np.zeros((n_labels, width + 1))
    charge = np.tile(np.r_[np.full(width, penalty), 0.0], n_labels)
    for _ in range(steps):
        scores = held @ weights.T
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = ((p - target).T @ held / rows).ravel() + charge * weights.ravel()
        bend = np.zeros((size, size))
        for a in range(n_labels):
            for b in range(n_labels):
                w = p[:, a] * ((a == b) - p[:, b])
                bend[a * (width + 1) : (a + 1) * (width + 1), b * (width + 1) : (b + 1) * (width + 1)] = held.T @ (held * w[:, None]) / rows
        # Adding one number to all intercepts changes nothing: the least such step is taken.
        weights -= np.linalg.lstsq(bend + np.diag(charge), slope, rcond=None)[0].reshape(weights.shape)
    return weights[:, :-1], weights[:, -1] - weights[:, -1].mean()


def test_weights_equal_a_dense_solver(spark):
    rng = np.random.default_rng(3)
    words = {"aaa_Latn": ["ab", "abc", "bca"], "bbb_Latn": ["bd", "dab", "bbc"], "ccc_Latn": ["cd", "cda", "adc"]}
    rows = [(k, " ".join(rng.choice(words[k] + ["ab", "cd"], 6))) for k in words for _ in range(40)]
    df = spark.createDataFrame(rows, "lid_label string, text string")
    model = learnt.fit_learnt(df, sizes=(1, 2), features=16, penalty=0.01, rounds=500, tolerance=1e-12, piece=None)
    assert model.labels == tuple(words)
    marked = learnt.hashed(df, F.col("text"), (1, 2), 16).select("lid_label", vector_to_array("__x").alias("x")).collect()
    x, y = np.array([r.x for r in marked]), np.array([model.labels.index(r.lid_label) for r in marked])
    assert np.allclose(np.linalg.norm(x, axis=1), 1)
    weights, starts = dense_fit(x, y, 3, 0.01)
    assert np.allclose(model.weights.coefficientMatrix.toArray(), weights, atol=1e-4)
    assert np.allclose(model.weights.interceptVector.toArray(), starts, atol=1e-4)
    tagged = lid.tag_language(df, model).select("predicted_lid", "lid_confidence").collect()
    scores = x @ weights.T + starts
    p = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    assert [r.predicted_lid for r in tagged] == [model.labels[i] for i in p.argmax(axis=1)]
    assert np.allclose([r.lid_confidence for r in tagged], p.max(axis=1), atol=1e-4)


def test_held_out_accuracy_is_that_of_the_profile_or_better(spark):
    """Pieces of 25 characters of unseen documents."""
    texts = text_table(spark, SF).where("lid_label IS NOT NULL AND text IS NOT NULL AND length(text) > 40")
    train, rest = texts.where("crc32(CAST(doc_id AS STRING)) % 4 != 2"), texts.where("crc32(CAST(doc_id AS STRING)) % 4 = 2")
    asked = rest.select("lid_label", F.substring("text", 11, 25).alias("text"))

    def accuracy(predictor):
        tagged = lid.tag_language(asked, predictor)
        return tagged.agg(F.avg((F.col("predicted_lid") == F.col("lid_label")).cast("double"))).first()[0]

    fitted, counted = accuracy(learnt.fit_learnt(train)), accuracy(lid.fit_predictor(train))
    print("learnt", fitted, "profile", counted)
    assert fitted >= counted and fitted > 0.9


def test_nulls_empty_texts_one_label_and_none(spark):
    df = spark.createDataFrame(
        [("a_Latn", "one two"), ("b_Latn", "drei vier"), (None, "x"), ("a_Latn", None), ("b_Latn", "")], "lid_label string, text string"
    )
    got = lid.tag_language(df.withColumn("label", F.lit(1)), learnt.fit_learnt(df), raw_labels=False)
    rows = {r.text: r for r in got.collect()}
    assert set(rows) == {"one two", "drei vier", "x", ""} and rows["one two"].label == 1
    assert rows["one two"].predicted_lid == "a_Latn" and rows["drei vier"].predicted_lid == "b_Latn"
    assert all(0 < r.lid_confidence <= 1 for r in rows.values())
    alone = lid.tag_language(df, learnt.fit_learnt(df.where("lid_label = 'a_Latn'"))).collect()
    assert {(r.predicted_lid, r.lid_confidence) for r in alone} == {("a_Latn", 1.0)}
    with pytest.raises(ValueError):
        learnt.fit_learnt(df.limit(0))


def test_the_weight_table_is_bounded():
    assert learnt.places_for(4) == learnt.FEATURES
    assert learnt.places_for(4000) * 4000 <= learnt.WEIGHT_CELLS < learnt.places_for(4000) * 8000


def test_filters_take_a_learnt_model(spark):
    model = learnt.fit_learnt(text_table(spark, "/root/testdata/sf0.001"))
    results = spark.createDataFrame([("the quick brown fox and the", 1)], "snippet string, pos int")
    assert lid.snippet_language_filter(results, model, ["zzz_Latn"]).count() == 1


ODD = ["", "a", "ab", "\x00 x\U0001F600y\U0001F600", "Grüße, žluťoučký kůň", "東京都に住む人", "la la la la", "x" * 95, "\uffff\ufdd0!"]


@pytest.mark.parametrize("features", [16, 1 << 14])
def test_blocks_hold_the_vectors_that_spark_makes(spark, features):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i long, text string")
    rows = learnt.hashed(df, F.col("text"), (1, 2, 3), features).select("i", vector_to_array("__x").alias("x")).orderBy("i").collect()
    made, owner, sums, squares = learnt.block(ODD, (1, 2, 3), features, None)
    x = np.array([r.x for r in rows])
    assert owner.tolist() == list(range(len(ODD))) and np.allclose(made.sums(np.eye(len(ODD)), features), x)
    assert np.allclose(sums, x.sum(axis=0)) and np.allclose(squares, (x * x).sum(axis=0))
    table = np.pad(np.random.default_rng(1).normal(size=(3, features)), ((0, 0), (0, 1)))
    assert np.allclose(made.scores(table), table[:, :-1] @ x.T)
    pieces, owner, _, _ = learnt.block(ODD, (1, 2, 3), features, 3)
    cut = [t[at : at + 3] for t in ODD for at in range(0, max(len(t), 1), 3)]
    assert np.allclose(pieces.scores(table), learnt.block(cut, (1, 2, 3), features, None)[0].scores(table)) and len(owner) == len(cut)


def test_texts_longer_than_a_chunk_are_scored_and_coded_whole(spark, monkeypatch):
    text = " ".join(ODD) * 3
    table = np.pad(np.random.default_rng(2).normal(size=(2, 512)), ((0, 0), (0, 1)))
    whole = learnt.block([text], (1, 2, 3), 512, None)[0].scores(table)
    rows = spark.createDataFrame([("b", text), ("a", "short"), ("b", "")], "lid_label string, text string").coalesce(1)
    monkeypatch.setattr(learnt, "CHUNK", 64)
    assert np.allclose(learnt._scores([text], table, (1, 2, 3), 512), whole)
    moments = learnt.coded(rows, ("a", "b"), (1, 2, 3), 512, 40).filter("moments IS NOT NULL").select("moments").collect()
    total = sum(np.frombuffer(r.moments) for r in moments)
    assert total[1024:].tolist() == [1, -(-len(text) // 40) + 1]


def test_examples_are_stored_in_three_bytes_a_character(spark):
    """Vectors of their n-grams took about thirty, and each round reads them."""
    texts = text_table(spark, SF).where("lid_label IS NOT NULL AND text IS NOT NULL")
    held = learnt.coded(texts.coalesce(1), ("deu_Latn", "eng_Latn", "fra_Latn", "spa_Latn"), learnt.SIZES, learnt.FEATURES, learnt.PIECE)
    n_bytes = held.agg(*[F.sum(F.length(c)) for c in ("runs", "places", "rows", "norms", "labels")]).first()
    n_chars = texts.agg(F.sum(F.length("text"))).first()[0]
    assert sum(n_bytes) < 3.2 * n_chars


def words(n, seed=5):
    """Texts of words that come again and again, and of some that come once."""
    rng = np.random.default_rng(seed)
    known = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(300)]
    once = ["".join(rng.choice(list("abcdefgß東"), 7)) for _ in range(n)]
    return [" ".join([*rng.choice(known, int(rng.integers(0, 120))), once[i]]) for i in range(n)] + ["", "a"]


def test_runs_that_often_stand_together_have_one_number():
    """Each round looks at every number: there was one for each character."""
    texts = words(400)
    made, _, sums, squares = learnt.block(texts, (1, 2, 3), 1 << 14, 40)
    assert len(made.ids) < 0.5 * sum(map(len, texts))
    alone, _, _, _ = learnt.block(texts, (1, 2, 3), 1 << 14, 40, again=False)
    assert len(alone.ids) == sum(map(len, texts)) and not alone.pairs
    table = np.pad(np.random.default_rng(1).normal(size=(3, 1 << 14)), ((0, 0), (0, 1)))
    assert np.array_equal(made.norms, alone.norms) and np.allclose(made.scores(table), alone.scores(table))
    shares = np.random.default_rng(2).normal(size=(2, len(made.norms)))
    assert np.allclose(made.sums(shares, 1 << 14), alone.sums(shares, 1 << 14))
    assert np.allclose(sums, alone.sums(np.ones((1, len(made.norms))), 1 << 14))


def test_kept_blocks_give_the_slopes_of_the_vectors(spark, monkeypatch):
    monkeypatch.setattr(learnt, "CHUNK", 500)
    texts = [*ODD, *words(40)]
    labels = ("a", "b", "c")
    rows = spark.createDataFrame([(labels[i % 3], t) for i, t in enumerate(texts)], "lid_label string, text string").repartition(2)
    kept = learnt.coded(rows, labels, (1, 2, 3), 256, 40).filter("labels IS NOT NULL").collect()
    assert len(kept) > 3
    table = np.pad(np.random.default_rng(1).normal(size=(3, 256)), ((0, 0), (0, 1)))
    starts = np.array([0.5, 0.1, -0.4])
    got = sum(learnt._slopes(row, table, starts, 3) for row in kept)
    cut = [(i % 3, t[at : at + 40]) for i, t in enumerate(texts) for at in range(0, max(len(t), 1), 40)]
    df = spark.createDataFrame([(t,) for _, t in cut], "text string").coalesce(1)
    x = np.array([r.x for r in learnt.hashed(df, F.col("text"), (1, 2, 3), 256).select(vector_to_array("__x").alias("x")).collect()])
    y = np.array([k for k, _ in cut])
    scores = x @ table[:, :-1].T + starts
    p = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    assert np.isclose(got[0], -np.log(p[np.arange(len(y)), y]).sum())
    off = (p - np.eye(3)[y])[:, :2]
    assert np.allclose(got[1:3], off.sum(axis=0)) and np.allclose(got[3:], (off.T @ x).reshape(-1))


def test_examples_are_kept_in_less_than_two_bytes_a_character_and_let_go(spark):
    texts = words(2000)
    rows = spark.createDataFrame([("a" if i % 2 else "b", t) for i, t in enumerate(texts)], "lid_label string, text string").coalesce(1)
    held = learnt.coded(rows, ("a", "b"), learnt.SIZES, learnt.FEATURES, learnt.PIECE)
    n_bytes = held.drop("moments").agg(*[F.sum(F.length(c)) for c in held.columns if c != "moments"]).first()
    assert sum(n_bytes) < 2 * sum(map(len, texts))
    persisted = spark.sparkContext._jsc.getPersistentRDDs
    before = set(persisted())
    learnt.fit_learnt(rows, rounds=2)
    assert set(persisted()) == before


def test_sums_of_many_tasks_are_merged_in_slices(spark, monkeypatch):
    rows = spark.createDataFrame([("a" if i % 2 else "b", t) for i, t in enumerate(words(60))], "lid_label string, text string").repartition(4)
    whole = learnt.fit_learnt(rows, rounds=5)
    monkeypatch.setattr(learnt, "SENT_BYTES", 0)
    monkeypatch.setattr(learnt, "SLICE", 1000)
    cut = learnt.fit_learnt(rows, rounds=5)
    assert np.allclose(whole.weights.coefficientMatrix.toArray(), cut.weights.coefficientMatrix.toArray())


def test_no_texts_but_empty_ones(spark):
    rows = spark.createDataFrame([("a", ""), ("a", ""), ("b", "")], "lid_label string, text string").coalesce(1)
    model = learnt.fit_learnt(rows)
    assert [r.predicted_lid for r in lid.tag_language(rows, model).collect()] == ["a"] * 3
