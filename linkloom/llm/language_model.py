"""Language identification by prediction by partial matching (PPM).

For each language a context tree over the last ``ORDER`` bytes is counted. A byte is coded in the
longest context that the language knows; a byte unseen there costs an escape (method C: as
many escape counts as distinct bytes) and is coded in the next shorter context, without the
bytes already ruled out, down to a uniform code over what is left of the 256 bytes. The
statistics are frozen after training, so the cost of a byte depends on the context found and
the byte alone, and the whole cost table is worked out once, with exact exclusion. A text's code
length is the sum of its bytes' costs; the language with the least is predicted, and the score
is its share of the probability, 2 ** -length, among all languages.

Training takes a bounded sample, ``TRAIN_BYTES`` for each language, of whole texts in hash order;
contexts met fewer than ``LEAST_COUNT`` times are dropped. Languages are modelled in groups of ``GROUP``, with a table of
``TABLE_CELLS`` costs at most for each group, so what a language knows does not depend on how
many there are. A batch of texts is scored by one group after the other, with one group's table in
memory at a time. Every text is scored whole.

Defined cases: a null text or one without a letter is ``und`` with score 0; rows with null
language or text are never trained on; repeated rows are scored alike; ties go to the language
first in order; without any training row all texts are ``und``; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, MapType

from linkloom.functions import local
from linkloom.session import row_count_within, stored

# Longest context in bytes.
ORDER = 4
# Bytes of text that a language is trained on at most, beyond the last whole text.
TRAIN_BYTES = 3_000_000
LEAST_COUNT = 4
# Languages in a group, and costs in its table: contexts x byte classes x languages, four bytes each.
GROUP = 4
TABLE_CELLS = 12_000_000
# Languages up to which their totals are sent to all tasks.
SENT_LANGUAGES = 10_000
# Bytes scored at a time.
CHUNK = 1 << 18
# Costs are whole numbers of this part of a bit, so that sums are exact in any order.
FINE = 4096

UNKNOWN = "und"


def training_sample(docs: DataFrame, text: str, label: str, id: str, train_bytes: int) -> DataFrame:
    """Whole texts of each language in hash order until ``train_bytes`` are reached."""
    rows = docs.where(docs[text].isNotNull() & docs[label].isNotNull()).select(
        docs[label].alias("lang"), F.xxhash64(docs[id], docs[text]).alias("key"), docs[text].alias("text")
    )
    # A first cut by hash range, sized from the totals, keeps large languages out of one task.
    rows = rows.withColumn("size", F.octet_length("text").cast("long"))
    totals = rows.groupBy("lang").agg(F.sum("size").alias("total"), F.max("size").alias("most"))
    totals = stored(totals, "language_totals")
    sent = F.broadcast(totals) if row_count_within(totals, SENT_LANGUAGES) is not None else totals
    share = (F.lit(4.0 * train_bytes) + F.col("most")) / F.col("total")
    cut = rows.join(sent, "lang").where(F.pmod("key", F.lit(1 << 20)) <= share * (1 << 20))
    before = F.sum("size").over(
        Window.partitionBy("lang").orderBy("key", "text").rowsBetween(Window.unboundedPreceding, -1)
    )
    return cut.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < train_bytes).select("lang", "text")


def count_contexts(texts: list[bytes], order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length up to ``order``: packed (context, byte) strings and their counts.

    A string of k context bytes and the next byte is a number of k + 1 digits; contexts do not
    reach back over the start of a text.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.uint64)
    into = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found, packed = [], np.zeros(len(data), dtype=np.uint64)
    for k in range(order + 1):
        # Nearest byte first: digit k from the end is the byte k places back.
        back = data[: len(data) - k] if k else data
        packed[k:] |= back << np.uint64(8 * k)
        found.append(np.unique(packed[into >= k], return_counts=True))
    return found


class Model:
    """Costs in bits: ``child`` leads from a context to the one a byte longer, ``cost`` has a row for each context."""

    def __init__(self, langs: list[str], classes: np.ndarray, child: np.ndarray, cost: np.ndarray, order: int):
        self.langs, self.classes, self.child, self.cost, self.order = langs, classes, child, cost, order

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        total = np.zeros((len(texts), len(self.langs)))
        group, size = [], 0
        for i, text in enumerate(texts):
            for at in range(0, len(text), CHUNK):
                # A piece brings the bytes before it as context.
                lead = min(at, self.order)
                group.append((i, lead, text[at - lead : at + CHUNK]))
                size += len(group[-1][2])
                if size >= CHUNK:
                    self._add(total, group)
                    group, size = [], 0
        self._add(total, group)
        return total

    def unmet_bits(self) -> dict[str, float]:
        """Bits of a byte that training never met, after another one, under each language."""
        return {g: float(self.cost[i, 0, -2]) / FINE for i, g in enumerate(self.langs)}

    def _add(self, total: np.ndarray, group: list[tuple[int, int, bytes]]) -> None:
        if not group:
            return
        width = self.child.shape[1]
        # One byte class that no context has parts the pieces.
        gap = width - 1
        joined = self.classes[np.frombuffer(b"\0".join(p for _, _, p in group), dtype=np.uint8)]
        ends = np.cumsum([len(p) + 1 for _, _, p in group]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        joined[ends[:-1]] = gap
        owner = np.array([i for i, _, _ in group])
        since = starts + np.array([lead for _, lead, _ in group])
        till = starts + np.array([len(p) for _, _, p in group])
        child = self.child.ravel()
        node = np.zeros(len(joined), dtype=np.int32)
        live = np.arange(len(joined), dtype=np.int32)[1:]
        for back in range(1, self.order + 1):
            step = child[node[live] * width + joined[live - back]]
            known = step >= 0
            live = live[known]
            node[live] = step[known]
            live = live[live > back]
        row = node * width + joined
        for lang in range(len(self.langs)):
            summed = np.zeros(len(row) + 1, dtype=np.int64)
            np.cumsum(self.cost[lang].ravel()[row], out=summed[1:])
            np.add.at(total[:, lang], owner, (summed[till] - summed[since]) / FINE)


def build(counts: dict[str, list[tuple[np.ndarray, np.ndarray]]], order: int, least: int, cells: int) -> Model:
    """The cost table of all languages over the union of their contexts."""
    langs = sorted(counts)
    seen = np.unique(np.concatenate([counts[g][0][0] for g in langs])).astype(np.int64)
    # Bytes met in training have a class each; all others share one, and one parts texts.
    classes = np.full(256, len(seen), dtype=np.int32)
    classes[seen] = np.arange(len(seen))
    width = len(seen) + 2
    room = max(cells // (width * len(langs)), 1)
    # Contexts by length: those met often enough in some language, whose shorter form is there too.
    kept: list[np.ndarray] = [np.zeros(1, dtype=np.uint64)]
    for k in range(1, order + 1):
        times: dict[int, int] = {}
        for g in langs:
            grams, n = counts[g][k]
            at, first = np.unique(grams >> np.uint64(8), return_index=True)
            sums = np.add.reduceat(n, first)
            for context, c in zip(at[sums >= least].tolist(), sums[sums >= least].tolist()):
                times[context] = max(times.get(context, 0), c)
        mask = np.uint64((1 << (8 * (k - 1))) - 1)
        contexts = np.array(sorted(times), dtype=np.uint64)
        contexts = contexts[np.isin(contexts & mask, kept[-1])] if k > 1 else contexts
        left = room - sum(map(len, kept))
        if len(contexts) > left:
            weight = np.array([times[c] for c in contexts.tolist()])
            contexts = np.sort(contexts[np.argsort(-weight, kind="stable")[: max(left, 0)]])
        kept.append(contexts)
    starts = np.cumsum([0] + [len(c) for c in kept])
    nodes = int(starts[-1])
    child = np.full((nodes, width), -1, dtype=np.int32)
    parent = np.zeros(nodes, dtype=np.int64)
    for k in range(1, order + 1):
        mask = np.uint64((1 << (8 * (k - 1))) - 1)
        up = starts[k - 1] + np.searchsorted(kept[k - 1], kept[k] & mask)
        own = np.arange(starts[k], starts[k + 1])
        parent[own] = up
        child[up, classes[(kept[k] >> np.uint64(8 * (k - 1))).astype(np.int64)]] = own
    cost = np.zeros((len(langs), nodes, width), dtype=np.int32)
    for number, g in enumerate(langs):
        table = np.zeros((nodes, len(seen)), dtype=np.float64)
        for k in range(order + 1):
            grams, n = counts[g][k]
            at = np.searchsorted(kept[k], grams >> np.uint64(8))
            at = np.minimum(at, max(len(kept[k]) - 1, 0))
            there = kept[k][at] == grams >> np.uint64(8) if len(kept[k]) else np.zeros(len(grams), bool)
            table[starts[k] + at[there], classes[(grams[there] & np.uint64(255)).astype(np.int64)]] = n[there]
        for block in range(0, nodes, 4096):
            own = np.arange(block, min(block + 4096, nodes))
            cost[number, own, : len(seen) + 1] = np.rint(_costs(table, parent, own, order) * FINE)
    return Model(langs, classes, child, cost, order)


def _costs(table: np.ndarray, parent: np.ndarray, nodes: np.ndarray, order: int) -> np.ndarray:
    """Bits of each byte class, the last for any byte never met, in each of ``nodes``."""
    known = table.shape[1]
    bits = np.zeros((len(nodes), known + 1))
    open_ = np.ones((len(nodes), known), dtype=bool)  # not yet coded or ruled out
    spent = np.zeros(len(nodes))  # bits of escapes so far
    at, done = nodes.copy(), np.zeros(len(nodes), dtype=bool)
    for _ in range(order + 1):
        n = np.where(open_ & ~done[:, None], table[at], 0.0)
        met = n > 0
        total, kinds = n.sum(axis=1), met.sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            own = spent[:, None] - np.log2(n / (total + kinds)[:, None])
            escape = -np.log2(kinds / (total + kinds))
        bits[:, :known][met] = own[met]
        spent = np.where(total > 0, spent + escape, spent)
        open_ &= ~met
        done |= at == 0
        at = parent[at]
    rest = spent + np.log2(np.maximum(256 - (known - open_.sum(axis=1)), 1))
    bits[:, :known] = np.where(open_, rest[:, None], bits[:, :known])
    bits[:, known] = rest
    return bits


class Models:
    """Models of all languages in groups, each sent to the tasks by itself."""

    def __init__(self, groups: list, unmet: dict[str, float]):
        self.groups, self.unmet = groups, unmet

    def unmet_bits(self) -> dict[str, float]:
        """Bits of a byte that training never met, under each language."""
        return self.unmet

    def code_lengths(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Languages, and the bits of each text under each."""
        langs, bits = [], []
        for sent in self.groups:
            group = sent.value
            langs += group.langs
            bits.append(group.code_lengths(texts))
            if len(self.groups) > 1:
                # The next batch reads it from the executor's disk again: one group is in memory at a time.
                vars(sent).pop("_value", None)
        return langs, np.concatenate(bits, axis=1)


def train(
    docs: DataFrame,
    text: str = "text",
    label: str = "lang",
    id: str = "doc_id",
    order: int = ORDER,
    train_bytes: int = TRAIN_BYTES,
    least: int = LEAST_COUNT,
    cells: int = TABLE_CELLS,
    group: int = GROUP,
) -> Models | None:
    """Fit on the bounded sample: tasks count the contexts of each language; the driver makes one group's table at a time."""

    def counted(rows: pd.DataFrame) -> pd.DataFrame:
        found = count_contexts([t.encode() for t in sorted(rows["text"])], order)
        out = []
        for k, (grams, n) in enumerate(found):
            # Beyond the unigrams, contexts under the least count are never kept.
            if k:
                _, first, inverse = np.unique(grams >> np.uint64(8), return_index=True, return_inverse=True)
                enough = np.add.reduceat(n, first)[inverse] >= least if len(grams) else np.zeros(0, bool)
                grams, n = grams[enough], n[enough]
            out.append((rows["lang"].iloc[0], k, grams.tobytes(), n.astype(np.int64).tobytes()))
        return pd.DataFrame(out, columns=["lang", "k", "grams", "n"])

    sample = stored(training_sample(docs, text, label, id, train_bytes), "language_sample")
    found = stored(sample.groupBy("lang").applyInPandas(counted, "lang string, k int, grams binary, n binary"), "language_counts")
    groups, unmet, counts = [], {}, {}

    def close() -> None:
        made = build(counts, order, least, cells)
        unmet.update(made.unmet_bits())
        groups.append(docs.sparkSession.sparkContext.broadcast(made))
        vars(groups[-1]).pop("_value", None)
        counts.clear()

    for row in found.orderBy("lang", "k").toLocalIterator():
        if row["lang"] not in counts and len(counts) == group:
            close()
        pair = np.frombuffer(row["grams"], dtype=np.uint64), np.frombuffer(row["n"], dtype=np.int64)
        counts.setdefault(row["lang"], []).append(pair)
    if counts:
        close()
    return Models(groups, unmet) if groups else None


def text_slices(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts in runs of about ``CHUNK`` bytes, one text at least: a batch is never held as Python strings at once."""
    yield from local.text_slices(texts, CHUNK)


def has_letter(text: Column) -> Column:
    return F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False))


def predict(docs: DataFrame, model: Models | None, text: str = "text", with_ranges: bool = False) -> DataFrame:
    """All columns of ``docs`` in ``row``, ``lang_pred``, ``score`` and ``bits_per_byte``; on request the text's letters by range."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    if model is None:
        nothing = (F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("bits_per_byte"))
        ranges = [F.create_map().cast("map<int,bigint>").alias("ranges")] * with_ranges
        return docs.select(row, *nothing, *ranges)

    schema = "lang string, score double, bits double" + ", ranges map<int,bigint>" * with_ranges

    # Ranges are counted by the same worker: one of their own holds its memory beside it.
    @F.arrow_udf(schema)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.concat_arrays([judged_slice(some) for some in text_slices(texts)])

    def judged_slice(texts: list[str | None]) -> pa.StructArray:
        data = [t.encode() if t is not None else b"" for t in texts]
        langs, bits = model.code_lengths(data)
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(data)), best]
        share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
        sizes = np.maximum([len(t) for t in data], 1)
        found = {"lang": pa.array([langs[i] for i in best], pa.string()), "score": pa.array(share), "bits": pa.array(least / sizes)}
        if with_ranges:
            found["ranges"] = pa.array([_range_counts(t or "") for t in texts], RANGES)
        return pa.StructArray.from_arrays(list(found.values()), names=list(found))

    # A projected call would be copied into later filters, and each text scored there once more.
    judged = local.work_out(docs.select(row, docs[text].alias("text"), has_letter(docs[text]).alias("lettered")), "judged", judge("text"))
    return judged.select(
        "row",
        F.when(F.col("lettered"), F.col("judged.lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("lettered"), F.col("judged.score")).otherwise(0.0).alias("score"),
        F.when(F.col("lettered"), F.col("judged.bits")).otherwise(0.0).alias("bits_per_byte"),
        *[F.col("judged.ranges")] * with_ranges,
    )


# A range of code points is a language's own from this share of its training letters on, whatever their number.
OWN_SHARE = 0.001
# Share of a text's letters in its language's own ranges below which the text is in none of the languages.
KNOWN_SHARE = 0.5


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _range_counts(text: str) -> list[tuple[int, int]]:
    """Letters of a text by range: 128 code points below U+3000, 8,192 above, so that each large script has few."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = points[_letters()[points]]
    ranges, n = np.unique(np.where(points < 0x3000, points >> 7, 0x1000 + (points >> 13)), return_counts=True)
    return list(zip(ranges.tolist(), n.tolist()))


RANGES = pa.map_(pa.int32(), pa.int64())


@F.arrow_udf(MapType(IntegerType(), LongType()))
def letter_ranges(texts: pa.Array) -> pa.Array:
    return pa.concat_arrays([pa.array([_range_counts(t or "") for t in some], RANGES) for some in text_slices(texts)])


def own_ranges(docs: DataFrame, text: str = "text", label: str = "lang") -> DataFrame:
    """(lang, own): the ranges that hold letters of a language, of all training rows. Less than 250 for each language."""
    rows = docs.where(docs[text].isNotNull() & docs[label].isNotNull())
    counts = (
        rows.select(docs[label].alias("lang"), F.explode(letter_ranges(docs[text])).alias("range", "n"))
        .groupBy("lang", "range")
        .agg(F.sum("n").alias("n"))
    )
    totals = counts.groupBy("lang").agg(
        F.sum("n").alias("all"), F.collect_list(F.struct("range", "n")).alias("counts")
    )
    own = F.filter("counts", lambda c: c["n"] >= OWN_SHARE * F.col("all"))
    return totals.select("lang", F.transform(own, lambda c: c["range"]).alias("own"))


def in_known_language(docs: DataFrame, training: DataFrame, model: Models | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in one of the model's languages.

    Texts that are ``und`` go, and those with less than ``KNOWN_SHARE`` of their letters in the ranges of the language
    predicted, as texts in a script that no training text has. Neither depends on how much text there is.
    """
    judged = predict(docs, model, text, with_ranges=True)
    own = stored(own_ranges(training, text), "own_ranges")
    counts = F.map_entries("ranges")
    add = lambda total, c: total + c["value"]
    number = lambda entries: F.aggregate(entries, F.lit(0).cast("bigint"), add)
    known = F.filter(counts, lambda c: F.array_contains("own", c["key"]))
    return (
        judged.where(F.col("lang_pred") != UNKNOWN)
        .join(own, F.col("lang_pred") == F.col("lang"))
        .where(number(known) >= KNOWN_SHARE * number(counts))
        .select("row.*")
    )


def held_out(id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Documents that training never reads: crc32 of the id as text, modulo ``folds``."""
    return F.coalesce(F.pmod(F.crc32(id.cast("string")), F.lit(folds)) == fold, F.lit(False))
