import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.operators import grams


def brute(rows, n, places):
    found = Counter()
    for key, text in rows:
        if text is not None:
            found.update((key, text[i : i + n]) for i in range(min(places(text), len(text))))
    return found


@pytest.mark.parametrize("n", [1, 3, 5, 9])
@pytest.mark.parametrize("chunk", [7, 1 << 20])
def test_runs_equal_brute_force(spark, monkeypatch, n, chunk):
    """Any characters, null keys and texts, texts longer than a chunk, and alphabets that no number holds ``n`` times."""
    monkeypatch.setattr(grams, "CHUNK", chunk)
    rng = random.Random(n)
    wide = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)] + ["\0", "\n", "é", "\U0001F600"]
    rows = [(rng.choice(["a", "b", None]), "".join(rng.choices(wide, k=rng.randrange(60)))) for _ in range(100)]
    rows += [("a", "abcabcab"), ("a", None), (None, "abc"), ("b", ""), ("b", "".join(wide))]
    df = spark.createDataFrame(rows, "k string, t string").repartition(3)
    for places, told in ((lambda t: len(t), F.length("t")), (lambda t: len(t) - n + 1, F.length("t") - (n - 1)), (lambda t: 2, F.lit(2))):
        got = {(r.k, r.gram): r.cnt for r in grams.count_runs(df, "k", F.col("t"), n, told).collect()}
        assert got == brute(rows, n, places)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_a_text_beyond_a_chunk_is_counted_in_parts(monkeypatch, n):
    """A slice gives a row for each distinct run of ``CHUNK`` places and not for each place."""
    monkeypatch.setattr(grams, "CHUNK", 8)
    rows = [(0, "ab" * 500), (1, ""), (1, "é\U0001F600é"), (0, "ba")]
    texts, owners = [t for _, t in rows], np.array([k for k, _ in rows])
    found, parts = Counter(), 0
    for keys, runs, counts in grams._slice_runs(texts, owners, np.array([len(t) for t in texts]), n):
        parts += len(counts)
        assert counts.sum() <= 8
        for key, run, count in zip(keys.tolist(), runs.to_pylist(), counts.tolist()):
            found[key, run] += count
    assert found == brute(rows, n, len) and parts < 300
