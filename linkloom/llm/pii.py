"""Personal data by weak supervision.

Base spans (email, ip, card, phone) follow fixed patterns and checks and always stay. The method adds spans of
further kinds. Candidates come from looser patterns; labelers of three sorts vote on each, base spans
included, for, against or not at all: regular expressions and checksums look at its form, gazetteers
at its words, context labelers at the words beside it. Expectation-maximisation over the counts of
vote patterns estimates how reliable each labeler is and how likely each pattern marks personal data
(a two-class model with one table of votes for each labeler, and a prior for each kind). A logistic
classifier on the span's own features is then fitted to these probabilities and has the last word
on candidates, so it can also judge spans on which few labelers vote.

Both models see counts only: at most kinds * 3 ** labelers vote patterns and the product of the feature
sizes, whatever the number of documents, and all documents are counted. Texts are read once, whole.

Positions are code points, ends exclusive. Defined cases: a null text counts as empty; repeated rows and ids are
judged row by row; added spans never overlap base ones, nor each other within a kind; an empty table
gives an empty result and a table without candidates adds nothing; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linkloom.session import stored

BASE = ("email", "ip", "card", "phone")
ADDED = ("account", "local_phone", "name", "secret", "spoken_email")
KINDS = BASE + ADDED
# An added span needs this probability.
LEAST = 0.9

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, and runs are never given back.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.(-])(?:\([0-9]{2,5}\)|0[0-9]{1,4}|[0-9]{3})[ ./-][0-9]{3,4}[ .-][0-9]{3,5}(?![0-9])")
SECRET = re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9]{24,}")
NAME = re.compile(r"(?<![A-Za-z])(?:[A-Z][a-z]{0,11}\.? ){1,2}[A-Z][a-z]+")
SPOKEN = re.compile(
    r"(?i)[a-z0-9][a-z0-9._-]{0,40} ?(?:\[at\]|\(at\)) ?[a-z0-9-]{1,40} ?(?:\.|\[dot\]|\(dot\)| dot ) ?[a-z]{2,10}(?![a-z])"
)

# Word lists of the gazetteer labelers.
TITLES = "mr mrs ms dr prof herr frau monsieur madame mme sr sra don señor señora".split()
GIVEN = (
    "james mary john patricia robert jennifer michael linda david elizabeth william barbara thomas sarah anna"
    " peter paul maria jean pierre marie claude jacques sophie hans klaus ursula juan carlos carmen luis pedro"
).split()
ENDINGS = "com org net edu gov io de fr es uk eu info".split()
# Words that speak for or against a kind when they stand beside a span.
CUES = {
    "email": "mail email e-mail contact kontakt correo courriel write",
    "spoken_email": "mail email e-mail contact kontakt correo courriel write",
    "ip": "ip address host server client login",
    "card": "card visa mastercard amex credit kreditkarte carte tarjeta",
    "account": "card account konto compte cuenta iban customer kunde",
    "phone": "tel phone call fax mobile telefon téléphone teléfono",
    "local_phone": "tel phone call fax mobile telefon téléphone teléfono",
    "name": "name dear contact signed regards liebe cher estimado author",
    "secret": "token key secret password passwd pwd api bearer auth credential",
}
AGAINST = "version isbn page order no fig section chapter year total art build row".split()
_AGAINST = re.compile(r"(?:^|[^a-z])(?:" + "|".join(AGAINST) + r")[ .:#=\"']*$")
_BEFORE = {k: re.compile(r"(?:^|[^a-zà-ÿ])(?:" + "|".join(map(re.escape, v.split())) + r")\W{0,6}(?:is|ist|est|es)?\W{0,4}$") for k, v in CUES.items()}
_AFTER = {k: re.compile(r"^\W{0,4}(?:" + "|".join(map(re.escape, v.split())) + r")(?![a-zà-ÿ])") for k, v in CUES.items()}
BESIDE = 28

# Votes on a span: form, checksum, gazetteer, words before, words after, plainness.
LABELERS = 6
# Sizes of the span features: kind, length, share of digits, distinct characters, separators, mixed case, cue.
SIZES = (len(KINDS), 5, 4, 4, 3, 2, 3)
STARTS = tuple(int(x) for x in np.cumsum((0, *SIZES))[:-1])


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the email pattern, found from each @: a local part runs back over its
    characters as far as the last match, and no other @ can be in it."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def small_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """Base spans by kind and place, and runs of 12 to 19 digits that are no card."""
    spans = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(map(small_part, m[0].split("."))):
            spans.append(("ip", *m.span()))
    long_runs = []
    for m in CARD.finditer(text):
        if m.end() - m.start() < 12:
            continue
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
        elif 12 <= len(digits) <= 19:
            long_runs.append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                spans.append(("phone", *m.span()))
    return spans, long_runs


def candidates(text: str, long_runs: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    for a, b in long_runs:
        yield "account", a, b
    for m in LOCAL_PHONE.finditer(text):
        yield "local_phone", *m.span()
    for m in NAME.finditer(text):
        words = m[0].lower().replace(".", "").split(" ")
        if words[0] in TITLES or words[0] in GIVEN:
            yield "name", *m.span()
    for m in SECRET.finditer(text):
        if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]):
            yield "secret", *m.span()
    if "(at)" in text.lower() or "[at]" in text.lower():
        for m in SPOKEN.finditer(text):
            yield "spoken_email", *m.span()


def votes(kind: str, span: str, before: str, after: str) -> str:
    """One of ``+``, ``-`` and ``0`` from each labeler."""
    digits = re.sub("[^0-9]", "", span)
    form = checksum = gazetteer = plain = "0"
    if kind in ("card", "account"):
        form = "+" if len(digits) == 16 else "-"
        checksum = "+" if luhn(digits) else "-"
    elif kind in ("phone", "local_phone"):
        form = "+" if re.search(r"[ ().-]", span) else "0"
        gazetteer = "+" if span.startswith(("(", "0", "+")) else "0"
        checksum = "+" if 9 <= len(digits) <= 13 else "-"
    elif kind == "secret":
        form = "+" if re.fullmatch("[0-9a-f]+|[0-9A-F]+", span) else "0"
        checksum = "+" if len(span) in (32, 40, 64, 128) else "0"
    elif kind in ("email", "spoken_email"):
        form = "+" if re.search(r"[A-Za-z]{2,}$", span) else "-"
        gazetteer = "+" if re.split("[^a-z]+", span.lower())[-1] in ENDINGS else "0"
    elif kind == "ip":
        form = "+" if not re.search(r"(?:^|\.)0[0-9]", span) else "-"
        gazetteer = "+" if not span.startswith(("0.", "127.", "255.")) else "-"
    elif kind == "name":
        words = span.lower().replace(".", "").split(" ")
        form = "+" if len(words[-1]) > 2 else "-"
        gazetteer = "+" if words[0] in TITLES or len(words) > 2 and words[1] in GIVEN else "0"
    if len(digits) >= 8:
        plain = "-" if len(set(digits)) < 3 or digits in "01234567890123456789" else "0"
    left = before.lower()
    cue = "-" if _AGAINST.search(left) else "+" if _BEFORE[kind].search(left) else "0"
    follows = "+" if _AFTER[kind].search(after.lower()) else "0"
    return form + checksum + gazetteer + cue + follows + plain


def features(kind: str, span: str, vote: str) -> list[int]:
    """The active feature of each sort, numbered through."""
    n = len(span)
    digits = sum("0" <= c <= "9" for c in span)
    values = (
        KINDS.index(kind),
        min(n // 10, 4),
        min(digits * 4 // n, 3),
        min(len(set(span)) // 4, 3),
        min(sum(not c.isalnum() for c in span), 4) // 2,
        int(span != span.lower() and span != span.upper()),
        "0+-".index(vote[3]),
    )
    return [s + v for s, v in zip(STARTS, values)]


def read_text(text: str) -> tuple[list[tuple[str, int, int]], list[tuple]]:
    """Base spans, and all candidates as (kind, start, end, votes, features); base ones are candidates too."""
    spans, long_runs = base_spans(text)
    spans.sort(key=lambda s: (BASE.index(s[0]), s[1]))
    found, taken = [], sorted((a, b) for _, a, b in spans)
    starts = [a for a, _ in taken]
    last: dict[str, int] = {}
    for kind, a, b in [*spans, *candidates(text, long_runs)]:
        if kind in ADDED:
            i = np.searchsorted(starts, b) if starts else 0
            if any(y > a for _, y in taken[max(0, i - 4) : i]) or last.get(kind, 0) > a:
                continue
            last[kind] = b
        span = text[a:b]
        vote = votes(kind, span, text[max(0, a - BESIDE) : a], text[b : b + BESIDE])
        found.append((kind, a, b, vote, features(kind, span, vote)))
    return spans, found


def label_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``base`` and ``candidates`` of each row, stored."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ("kind", "start", "end", "votes", "features")
        for rows in batches:
            base, others = [], []
            for text in rows["text"]:
                spans, found = read_text(text or "")
                base.append([dict(zip(names, s)) for s in spans])
                others.append([dict(zip(names, f)) for f in found])
            yield pd.DataFrame({"id": rows["id"].array, "base": base, "candidates": others})

    # The id travels as text, as a null beside numbers would make them inexact on the way.
    rows = docs.select(docs[id].cast("string").alias("id"), docs[text].alias("text"))
    span = "kind: string, start: int, end: int"
    schema = f"id string, base array<struct<{span}>>, candidates array<struct<{span}, votes: string, features: array<int>>>"
    found = rows.mapInPandas(read, schema)
    return stored(found.withColumn("id", F.col("id").cast(docs.schema[id].dataType)), "spans")


def estimate(counts: dict[tuple[str, str], int], rounds: int = 100) -> dict[tuple[str, str], float]:
    """Probability that a span of a kind with these votes is personal data, by expectation-maximisation."""
    keys = sorted(counts)
    n = np.array([counts[k] for k in keys], dtype=float)
    kind = np.array([KINDS.index(k) for k, _ in keys])
    cast = np.array([["-0+".index(v) for v in vote] for _, vote in keys])
    # Base spans passed a check, so they start sure; the rest start from the balance of votes.
    base = kind < len(BASE)
    p = np.where(base, 0.95, 1 / (1 + np.exp(-(cast - 1.0).sum(axis=1))))
    for _ in range(rounds):
        prior = np.full(len(KINDS), 0.5)
        for k in set(kind.tolist()):
            own = kind == k
            prior[k] = ((n * p)[own].sum() + 1) / (n[own].sum() + 2)
        odds = np.log(prior[kind] / (1 - prior[kind]))
        for j in range(cast.shape[1]):
            # Chance of each vote in either class; one pseudo-count keeps it off zero.
            yes = np.bincount(cast[:, j], n * p, 3) + 1
            no = np.bincount(cast[:, j], n * (1 - p), 3) + 1
            odds += np.log(yes / yes.sum() / (no / no.sum()))[cast[:, j]]
        p = np.where(base, np.maximum(1 / (1 + np.exp(-odds)), 0.95), 1 / (1 + np.exp(-np.clip(odds, -50, 50))))
    return {k: float(x) for k, x in zip(keys, p)}


def fit(rows: list[tuple[list[int], float, float]], rounds: int = 30) -> np.ndarray:
    """Weights of the logistic classifier, the last one the constant, by Newton's method.

    ``rows``: active features, number of spans, sum of their probabilities.
    """
    width = sum(SIZES) + 1
    x = np.zeros((len(rows), width))
    for i, (active, _, _) in enumerate(rows):
        x[i, active] = 1
    x[:, -1] = 1
    n, y = (np.array([r[k] for r in rows], dtype=float) for k in (1, 2))
    w = np.zeros(width)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - n * p) - w
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(width)
        step = np.linalg.solve(bend, slope)
        w += step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
    return w


def train(spark: SparkSession, labelled: DataFrame) -> np.ndarray | None:
    """The classifier's weights; None without candidates."""
    each = labelled.select(F.inline("candidates"))
    counted = each.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()
    if not counted:
        return None
    sure = estimate({(r["kind"], r["votes"]): r["n"] for r in counted})
    # At most one row for each kind and pattern of votes.
    known = spark.createDataFrame([(*k, p) for k, p in sorted(sure.items())], "kind string, votes string, p double")
    weighed = each.join(F.broadcast(known), ["kind", "votes"]).groupBy("features")
    rows = weighed.agg(F.count("*").alias("n"), F.sum("p").alias("p")).orderBy(F.col("features").cast("string"))
    return fit([(r["features"], r["n"], r["p"]) for r in rows.collect()])


def find_spans(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """``id``, ``base`` and ``spans`` of each row: arrays of (kind, start, end), by kind and start."""
    labelled = label_spans(docs, id, text)
    weights = train(docs.sparkSession, labelled)
    span = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    if weights is None:
        return labelled.select("id", "base", F.col("base").alias("spans"))
    table = F.array(*[F.lit(float(w)) for w in weights[:-1]])

    def accepted(c: Column) -> Column:
        total = F.aggregate(c["features"], F.lit(float(weights[-1])), lambda a, i: a + F.get(table, i))
        return ~c["kind"].isin(*BASE) & (total >= float(np.log(least / (1 - least))))

    # The names of added kinds are in order and stand after the base.
    added = F.sort_array(F.transform(F.filter("candidates", accepted), span))
    return labelled.select("id", "base", F.concat("base", added).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
