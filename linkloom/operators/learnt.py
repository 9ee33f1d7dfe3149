"""Language identification learnt from examples: logistic regression on hashed character n-grams.

Runs of characters are hashed to ``features`` places, each text's counts are scaled to length one, and the weights are
fitted by gradients that tasks sum and Spark merges in slices. Examples are kept once on the executors' disks as numbers of
the runs that start at their characters, and of runs that often stand side by side: somewhat more than a byte a character.
Every round reads them from there; what an executor loses is coded again. The weight table is bounded whatever the corpus;
its size is an argument.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from linkloom.functions.local import text_slices
from linkloom.functions.text import char_ngrams

SIZES = (1, 2, 3)
# Places for n-grams, and the most cells (labels times places) of a weight table.
FEATURES = 1 << 14
WEIGHT_CELLS = 8_000_000
PENALTY = 1e-6
ROUNDS = 60
# Characters of a training example: texts are learnt in pieces, so that short texts are known too.
PIECE = 40
# Bytes of text coded at a time, and characters in a row of a block.
CHUNK = 1 << 18
WIDTH = 40
# Chunks in a block that is kept, rows whose counts are made at a time, and how often a pair must stand to be numbered.
BLOCK = 4
SOME = 1 << 10
OFTEN = 4
# Steps that a direction is made of, and rounds over which the loss must fall.
STEPS = 10
RECENT = 20
# Numbers of a slice of a task's sums, and bytes of all tasks' sums that go to the driver as they are.
SLICE = 1 << 13
SENT_BYTES = 32 << 20
# Bytes that a process keeps rather than handing them back (the most that glibc takes for this).
ROOM = 31 << 20
# Tasks of a round for each core.
TASKS = 3

ANSWER = "struct<label: string, confidence: double>"


@dataclass(frozen=True)
class Weights:
    """One row of coefficients and one intercept per label."""

    coefficientMatrix: DenseMatrix
    interceptVector: DenseVector


@dataclass(frozen=True)
class LearntModel:
    """Fitted weights (one row per label, one column per place), labels in their order, and how texts are read."""

    weights: Weights
    labels: tuple[str, ...]
    sizes: tuple[int, ...]
    features: int

    def __call__(self, text: Column) -> Column:
        """Label and confidence, row by row."""
        table = np.pad(self.weights.coefficientMatrix.toArray(), ((0, 0), (0, 1)))
        shared = SparkSession.active().sparkContext.broadcast((table, self.weights.interceptVector.toArray()))
        labels, sizes, features = self.labels, self.sizes, self.features

        def answers(texts: pa.Array) -> pa.Array:
            held, starts = shared.value
            _keep_room()
            names, sure = [], []
            for part in text_slices(texts, CHUNK):
                p = _chances(_scores([t for t in part if t is not None], held, sizes, features) + starts[:, None])[0]
                found = iter(zip(p.argmax(axis=0).tolist(), p.max(axis=0).tolist()))
                for t in part:
                    at, chance = next(found) if t is not None else (None, None)
                    names.append(None if at is None else labels[at])
                    sure.append(chance)
            return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(sure, pa.float64())], names=["label", "confidence"])

        answers.__annotations__ = {"texts": pa.Array, "return": pa.Array}
        return F.arrow_udf(answers, ANSWER)(text)


def hashed(df: DataFrame, text: Column, sizes: tuple[int, ...], features: int) -> DataFrame:
    """``df`` with ``__x``: counts of the text's n-grams by hashed place, scaled to length one; an empty text has none.

    What examples mean, as Spark's vectors; ``block`` has the same in less room.
    """
    grams = df.withColumn("__grams", F.concat(*[char_ngrams(text, n) for n in sizes]))
    counted = HashingTF(inputCol="__grams", outputCol="__tf", numFeatures=features).transform(grams)
    return Normalizer(inputCol="__tf", outputCol="__x", p=2.0).transform(counted).drop("__grams", "__tf")


@dataclass(frozen=True)
class Block:
    """Examples as rows of ``WIDTH`` characters, each row the numbers of the runs that start there.

    Two numbers that often stand side by side have a number of their own, and so have two of these: ``pairs`` has the two
    that each stands for, numbered after the runs. ``places`` has the hashed places of the n-grams that a run begins
    with, the number of all places for one that its text is too short for. Rows are in the order of how many numbers they have,
    the longest first; ``ids`` has the first number of each row, then the second of each that has two, and so on for each of ``slots``.
    ``rows`` has each row's example.
    """

    ids: np.ndarray
    slots: np.ndarray
    pairs: tuple[np.ndarray, ...]
    places: np.ndarray
    rows: np.ndarray
    norms: np.ndarray

    def scores(self, table: np.ndarray) -> np.ndarray:
        """For each row of weights the score of each example; the last weight of a row is zero."""
        totals = []
        taken = np.empty(len(self.rows), dtype=complex)
        by_id = []
        for weights in _twos(table):
            own, at = np.empty(self.held, dtype=weights.dtype), len(self.places)
            own[:at] = sum(weights[spots] for spots in self.places.T)
            for one, two in self.pairs:
                own[at : at + len(one)] = own[one] + own[two]
                at += len(one)
            by_id.append(own)
            totals.append(np.zeros(len(self.rows), dtype=weights.dtype))
        for n, ids in self._columns():
            for own, total in zip(by_id, totals):
                total[:n] += own.take(ids, out=taken.view(own.dtype)[:n], mode="clip")
        out = np.empty((len(table), len(self.norms)))
        for k, total in enumerate(_ones(totals)):
            out[k] = np.bincount(self.rows, total, len(self.norms))
        return out / self.norms

    def sums(self, shares: np.ndarray, features: int) -> np.ndarray:
        """For each row of ``shares`` the sum of the examples' vectors, each times its share."""
        dealt = [share[self.rows] for share in _twos(shares / self.norms)]
        by_id = [np.zeros(self.held, dtype=share.dtype) for share in dealt]
        for n, ids in self._columns():
            for own, share in zip(by_id, dealt):
                np.add.at(own, ids, share[:n])
        out = np.empty((len(shares), features))
        for k, own in enumerate(_ones(by_id)):
            for one, two in reversed(self.pairs):
                own, made = np.split(own, [len(own) - len(one)])
                own = own + np.bincount(one, made, len(own)) + np.bincount(two, made, len(own))
            out[k] = sum(np.bincount(spots, own, features + 1) for spots in self.places.T)[:features]
        return out

    @property
    def held(self) -> int:
        return len(self.places) + sum(pairs.shape[1] for pairs in self.pairs)

    def _columns(self) -> Iterator[tuple[int, np.ndarray]]:
        """For each of ``slots`` how many rows have a number there, and these."""
        at = 0
        for n in self.slots.tolist():
            yield n, self.ids[at : at + n].astype(np.intp)
            at += n


def _twos(rows: np.ndarray) -> list[np.ndarray]:
    """Two rows at a time as one of complex numbers, so that a look-up or a sum serves both; the last of an odd number as it is."""
    out = [np.empty(rows.shape[1], dtype=complex) for _ in range(len(rows) // 2)]
    for k, pair in enumerate(out):
        pair.real, pair.imag = rows[2 * k], rows[2 * k + 1]
    return [*out, *rows[2 * len(out) :]]


def _ones(rows: list[np.ndarray]) -> list[np.ndarray]:
    """The rows that ``_twos`` was given."""
    return [np.ascontiguousarray(part) for row in rows for part in ((row.real, row.imag) if np.iscomplexobj(row) else (row,))]


def block(texts: list[str], sizes: tuple[int, ...], features: int, piece: int | None, again: bool = True) -> tuple[Block, np.ndarray, np.ndarray, np.ndarray]:
    """The examples of ``texts``, the text of each, and the sums of their vectors and of the squares of these.

    For examples that are not read ``again`` no pairs are looked for, and no sums are made.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    pieces = np.maximum(-(-lengths // piece), 1) if piece else np.ones(len(texts), dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), pieces)
    if piece:
        place = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        lengths = np.minimum(lengths[owner] - place * piece, piece)
    ends = np.cumsum(lengths)
    rows = np.maximum(-(-lengths // WIDTH), 1)
    example = np.repeat(np.arange(len(lengths)), rows)
    at = np.arange(len(example)) - np.repeat(np.cumsum(rows) - rows, rows)
    filled = np.clip(lengths[example] - at * WIDTH, 0, WIDTH)
    grid, places = _runs(points, (ends - lengths)[example] + at * WIDTH, ends[example], sizes, features)
    squares, second = _squares(grid, places, example, len(lengths), features, again)
    ids, slots, pairs, order = _laid_out(grid, filled, len(places), again)
    made = Block(ids, slots, pairs, places, example[order], np.sqrt(np.maximum(squares, 1)))
    return made, owner, made.sums(np.ones((1, len(lengths))), features)[0] if again else second, second


def _runs(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: tuple[int, ...], features: int) -> tuple[np.ndarray, np.ndarray]:
    """For rows of characters the numbers of the runs that start there, and the hashed places of each run's n-grams.

    A row begins at its place of ``starts``; runs go on beyond it, up to the end of its example. Cells after that have a
    run without characters.
    """
    longest = max(sizes)
    kinds, chars = _numbered(points, int(points.max(initial=0)) + 1)
    of_kind = np.zeros(kinds + 1, dtype="<u4")
    of_kind[chars + 1] = points
    cells = starts[:, None] + np.arange(WIDTH + longest - 1)
    held = np.append(chars + 1, 0).take(cells, mode="clip")
    held[cells >= ends[:, None]] = 0
    # Characters are numbered from one, zero stands after the end of an example.
    runs, bound = held[:, :WIDTH], kinds + 1
    for i in range(1, longest):
        if bound * (kinds + 1) >= 1 << 62:
            values, runs = _encoded(runs)
            bound = len(values)
        runs, bound = runs * (kinds + 1) + held[:, i : WIDTH + i], bound * (kinds + 1)
    values, runs = _encoded(runs)
    spots = np.empty(len(values), dtype=np.int64)
    spots[runs] = np.arange(runs.size).reshape(runs.shape)
    row, column = np.divmod(spots, WIDTH)
    own = held[row[:, None], column[:, None] + np.arange(longest)]
    letters = of_kind[own]
    size = np.where(own > 0, 1 + (letters > 0x7F).astype(np.int64) + (letters > 0x7FF) + (letters > 0xFFFF), 0)
    data = np.frombuffer(letters[own > 0].tobytes().decode("utf-32-le").encode(), dtype=np.uint8)
    first = np.cumsum(size.sum(axis=1)) - size.sum(axis=1)
    places = np.full((len(values), len(sizes)), features, dtype=np.int32)
    for j, n in enumerate(sizes):
        fit = np.flatnonzero(own[:, n - 1] > 0)
        places[fit, j] = _places(data, first[fit], first[fit] + size[fit, :n].sum(axis=1), n, features)
    return runs, places


def _squares(grid: np.ndarray, places: np.ndarray, example: np.ndarray, n_examples: int, features: int, sums: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each example the sum of the squares of its counts by place; by place, if ``sums``, that of the squares of the vectors."""
    out, second = np.zeros(n_examples, dtype=np.int64), np.zeros(features)
    # Rows are looked at some at a time, all of an example together.
    whole = np.flatnonzero(np.diff(example, prepend=-1))
    starts = whole[np.unique(np.searchsorted(whole, np.arange(0, len(example), SOME), side="right")) - 1] if len(whole) else whole
    for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(example)]):
        own = example[start:stop]
        base, n = int(own[0]), int(own[-1] - own[0]) + 1
        if n == stop - start:
            cells = np.empty((n, places.shape[1] * WIDTH), dtype=np.uint16 if features < 1 << 16 else np.int32)
        else:
            bits = features.bit_length()
            cells = np.empty((stop - start, places.shape[1] * WIDTH), dtype=np.int32 if n << bits < 1 << 31 else np.int64)
        for j, spots in enumerate(places.T.astype(cells.dtype)):
            spots.take(grid[start:stop], out=cells[:, j * WIDTH : (j + 1) * WIDTH], mode="clip")
        if n == stop - start:
            cells.sort(axis=1)
            new = np.ones(cells.shape, dtype=bool)
            np.not_equal(cells[:, 1:], cells[:, :-1], out=new[:, 1:])
            first = np.flatnonzero(new)
            place, kinds = cells.reshape(-1)[first], np.count_nonzero(new, axis=1)
        else:
            cells |= (own - base).astype(cells.dtype)[:, None] << bits
            cells = np.sort(cells, axis=None)
            first = np.flatnonzero(np.diff(cells, prepend=-1))
            place = cells[first]
            kinds = np.bincount(place >> bits, minlength=n)
            place = place & ((1 << bits) - 1)
        counts = np.diff(first, append=cells.size)
        counts[place == features] = 0
        counts *= counts
        out[base : base + n] = np.add.reduceat(counts, np.cumsum(kinds) - kinds)
        if sums:
            second += np.bincount(place, counts * np.repeat(1 / np.maximum(out[base : base + n], 1), kinds), features + 1)[:features]
    return out, second


def _laid_out(grid: np.ndarray, filled: np.ndarray, held: int, pair: bool) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...], np.ndarray]:
    """``ids``, ``slots`` and ``pairs`` of a block, and the order of its rows, of which ``filled`` cells hold a run each."""
    cells = np.where(np.arange(WIDTH) < filled[:, None], grid, -1)
    pairs, left = [], []
    while pair and cells.shape[1] % 2 == 0:
        one, two = cells[:, ::2], cells[:, 1::2]
        both = (one >= 0) & (two >= 0)
        values, numbers = _encoded(one[both].astype(np.int64) * held + two[both])
        often = np.bincount(numbers, minlength=len(values)) >= OFTEN
        named = np.where(often, held + np.cumsum(often) - 1, -1)
        above = np.full(one.shape, -1, dtype=cells.dtype)
        above[both] = named[numbers]
        pairs.append(np.stack(np.divmod(values[often], held)))
        left.append(np.where(np.repeat(above < 0, 2, axis=1), cells, -1))
        cells, held = above, held + int(often.sum())
    every = np.concatenate([*left, cells], axis=1)
    there = every >= 0
    counts = np.count_nonzero(there, axis=1)
    flat, first = every[there], np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    slots = len(counts) - np.cumsum(np.bincount(counts, minlength=1))[:-1]
    first = first[order]
    ids = np.concatenate([flat[:0], *[flat[first[:n] + j] for j, n in enumerate(slots.tolist())]])
    return ids, slots, tuple(pairs), order


def _encoded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ``values``, and the number of each of all."""
    found = pa.array(np.ascontiguousarray(values).reshape(-1)).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy().reshape(values.shape)


def _numbered(values: np.ndarray, bound: int) -> tuple[int, np.ndarray]:
    """How many different ``values`` there are, all below ``bound``, and their numbers in order."""
    if bound <= max(8 * len(values), 1 << 16):
        seen = np.zeros(bound, dtype=bool)
        seen[values] = True
        return int(seen.sum()), (np.cumsum(seen) - 1)[values]
    kinds, numbers = np.unique(values, return_inverse=True)
    return len(kinds), numbers


def _places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int, features: int) -> np.ndarray:
    """Where ``HashingTF`` puts the n-grams that are the bytes from ``starts`` to ``ends``: 32-bit Murmur3, seed 42."""

    def turned(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint32(by)) | (x >> np.uint32(32 - by))

    size = ends - starts
    spots = starts[:, None] + np.arange(4 * n)
    held = np.where(spots < ends[:, None], data[np.minimum(spots, max(len(data) - 1, 0))], 0).astype(np.uint8)
    words = held.view("<u4").astype(np.uint32)
    h = np.full(len(starts), 42, dtype=np.uint32)
    for i in range(n):
        mixed = h ^ turned(words[:, i] * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        # Bytes after the last whole word are mixed in without the turn; none change nothing.
        h = np.where(size >= 4 * i + 4, turned(mixed, 13) * np.uint32(5) + np.uint32(0xE6546B64), mixed)
    h ^= size.astype(np.uint32)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (h ^ (h >> np.uint32(16))).view(np.int32) % np.int32(features)


def _scores(texts: list[str], table: np.ndarray, sizes: tuple[int, ...], features: int) -> np.ndarray:
    """Scores of whole texts; one longer than ``CHUNK`` is counted slice by slice."""
    if not texts:
        return np.zeros((len(table), 0))
    if len(texts) > 1 or len(texts[0]) <= CHUNK:
        return block(texts, sizes, features, None)[0].scores(table)
    counts, text = np.zeros(features), texts[0]
    for n in sizes:
        # Each size by itself, so that the grams that start in a slice run on into the next one.
        for at in range(0, len(text) - n + 1, CHUNK):
            part = block([text[at : at + CHUNK + n - 1]], (n,), features, None)[0]
            counts += part.sums(part.norms[None, :], features)[0]
    length = np.linalg.norm(counts)
    return (table[:, :features] @ (counts / (length or 1.0)))[:, None]


def _chances(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chances of the labels (rows) for each example, and the logarithm of the mass of its scores."""
    top = scores.max(axis=0)
    p = np.exp(scores - top)
    mass = p.sum(axis=0)
    return p / mass, top + np.log(mass)


def places_for(n_labels: int, features: int = FEATURES, cells: int = WEIGHT_CELLS) -> int:
    """``features``, halved until the weight table is within ``cells``."""
    while features > 1 and features * n_labels > cells:
        features //= 2
    return features


def coded(rows: DataFrame, labels: tuple[str, ...], sizes: tuple[int, ...], features: int, piece: int | None) -> DataFrame:
    """The examples of ``rows`` (lid_label, text) in blocks; and a row of ``moments`` for each task that made some: sums of
    the vectors, of their squares, and of the examples by label."""
    number = {name: k for k, name in enumerate(labels)}
    size = BLOCK * CHUNK
    step = -(-size // piece) * piece if piece else None

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _keep_room()
        moments = np.zeros(2 * features + len(labels))
        for batch in batches:
            names, start = batch.column(0), 0
            for texts in text_slices(batch.column(1), size):
                marks = np.array([number[x] for x in names.slice(start, len(texts)).to_pylist()], dtype=np.int32)
                start += len(texts)
                # A text longer than a block comes alone.
                reach = max(map(len, texts), default=0)
                for at in range(0, max(reach, 1) if texts else 0, step or reach + 1):
                    made, owner, sums, squares = block([t[at : at + step] for t in texts] if step else texts, sizes, features, piece)
                    own = marks[owner]
                    moments += np.concatenate([sums, squares, np.bincount(own, minlength=len(labels))])
                    shape = [len(own), len(made.rows), len(made.places), len(made.pairs), *[pairs.shape[1] for pairs in made.pairs], *made.slots]
                    pairs = np.concatenate([made.ids[:0], *[pairs.reshape(-1) for pairs in made.pairs]])
                    numbers = (made.ids, pairs, made.places, made.rows, np.rint(made.norms * made.norms), own)
                    yield record(np.array(shape, dtype=np.int64).tobytes(), *[_packed(x) for x in numbers], None)
        if moments.any():
            yield record(*[None] * 7, moments.tobytes())

    def record(*parts: bytes | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in parts], names=columns)

    columns = ["shape", "runs", "pairs", "places", "rows", "norms", "labels", "moments"]
    return rows.select("lid_label", "text").mapInArrow(blocks, ", ".join(f"{name} binary" for name in columns))


def _keep_room() -> None:
    """The C library hands freed memory back after each step, and the system clears it for the next one, unless a larger piece was freed before."""
    np.empty(ROOM, dtype=np.uint8)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from zero on, in as many bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _numbers(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"u{len(data) // n}" if n else np.uint8)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return _numbers(data, n).astype(np.intp)


def _read(row: Row, n_sizes: int) -> tuple[Block, np.ndarray]:
    n, n_rows, n_runs, levels, *rest = np.frombuffer(row.shape, dtype=np.int64).tolist()
    held, slots = rest[:levels], np.array(rest[levels:], dtype=np.int64)
    pairs = np.split(_unpacked(row.pairs, 2 * sum(held)), 2 * np.cumsum(held)[:-1]) if held else []
    made = Block(
        _numbers(row.runs, int(slots.sum())),
        slots,
        tuple(part.reshape(2, -1) for part in pairs),
        _unpacked(row.places, n_runs * n_sizes).reshape(-1, n_sizes),
        _unpacked(row.rows, n_rows),
        np.sqrt(_unpacked(row.norms, n)),
    )
    return made, _unpacked(row.labels, n)


def _slopes(row: Row, table: np.ndarray, starts: np.ndarray, n_sizes: int) -> np.ndarray:
    """Summed loss, slopes of the intercepts and of the weights, in a row; those of the last label follow from the others'."""
    held, labels = _read(row, n_sizes)
    # Scores above that of the last label.
    scores = np.zeros((len(table), len(labels)))
    scores[:-1] = held.scores(table[:-1] - table[-1]) + (starts[:-1] - starts[-1])[:, None]
    p, mass = _chances(scores)
    every = np.arange(len(labels))
    loss = (mass - scores[labels, every]).sum()
    p[labels, every] -= 1
    return np.concatenate([[loss], p[:-1].sum(axis=1), held.sums(p[:-1], table.shape[1] - 1).reshape(-1)])


def _merged(rows: RDD, size: int, part: Callable[[Row], np.ndarray]) -> np.ndarray:
    """The sum of the ``size`` numbers that ``part`` makes of each row; tasks send slices of their sums, which are added up slice by slice."""

    def added(held: Iterator[Row]) -> Iterator[tuple[int, np.ndarray]]:
        _keep_room()
        total = np.zeros(size)
        for row in held:
            total += part(row)
        for at in range(0, size, SLICE):
            yield at, total[at : at + SLICE]

    parts = rows.mapPartitions(added)
    if rows.getNumPartitions() * size * 8 > SENT_BYTES:
        parts = parts.reduceByKey(lambda one, two: one + two)
    out = np.zeros(size)
    for at, sums in parts.collect():
        out[at : at + SLICE] += sums
    return out


def fit_weights(examples: DataFrame, n_labels: int, n_sizes: int, features: int, penalty: float, rounds: int, tolerance: float) -> Weights:
    """Weights of the least mean loss and penalty over coded examples, from none on; the intercepts start at the labels' shares.

    Steps are taken in places of mean zero and deviation one, the penalty is that of the weights themselves.
    """
    sc = examples.sparkSession.sparkContext
    # Kept as Python's own bytes: reading them from files, or as Spark's rows, takes longer than the sums of a round.
    held = examples.rdd.map(lambda row: Row(*row.__fields__)(*[x and bytes(x) for x in row])).persist(StorageLevel.DISK_ONLY)
    try:
        moments = _merged(held, 2 * features + n_labels, lambda row: 0 if row.moments is None else np.frombuffer(row.moments))
        # A task's sums are sent once for all its blocks.
        blocks = held.coalesce(max(TASKS * sc.defaultParallelism, 1))
        return _fitted(blocks, moments, n_labels, n_sizes, features, penalty, rounds, tolerance)
    finally:
        held.unpersist()


def _fitted(blocks: RDD, moments: np.ndarray, n_labels: int, n_sizes: int, features: int, penalty: float, rounds: int, tolerance: float) -> Weights:
    """``fit_weights`` on kept ``blocks``, given the sums of their moments."""
    sc = blocks.context
    by_label = moments[2 * features :]
    total = by_label.sum()
    mean, square = moments[:features] / total, moments[features : 2 * features] / total
    spread = np.maximum(square - mean * mean, 0.0)
    varied = spread > 1e-12 * square
    scale = np.where(varied, 1 / np.sqrt(np.where(varied, spread, 1.0)), 0.0)
    cells = n_labels * features

    def unscaled(point: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weights = point[:cells].reshape(n_labels, features) * scale
        return weights, point[cells:] - weights @ mean

    def loss(point: np.ndarray) -> tuple[float, np.ndarray]:
        weights, starts = unscaled(point)
        shared = sc.broadcast((np.pad(weights, ((0, 0), (0, 1))), starts))
        got = _merged(blocks, 1 + (n_labels - 1) * (1 + features), lambda row: 0 if row.runs is None else _slopes(row, *shared.value, n_sizes)) / total
        shared.destroy()
        by_start = np.append(got[1:n_labels], -got[1:n_labels].sum())
        slopes = got[n_labels:].reshape(n_labels - 1, features)
        slopes = np.vstack([slopes, -slopes.sum(axis=0)])
        slopes = (slopes - np.outer(by_start, mean) + penalty * weights) * scale
        return got[0] + penalty / 2 * (weights * weights).sum(), np.concatenate([slopes.reshape(-1), by_start])

    start = np.zeros(cells + n_labels)
    if n_labels > 1:
        start[cells:] = np.log(by_label / total)
        start = least(loss, start, rounds, tolerance)
    weights, starts = unscaled(start)
    return Weights(DenseMatrix(n_labels, features, weights.ravel(order="F")), DenseVector(starts - starts.mean()))


def least(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], point: np.ndarray, rounds: int, tolerance: float) -> np.ndarray:
    """Where ``loss`` (value and slopes) is least, by limited-memory BFGS.

    It ends when the slopes are small beside the loss, or the loss has fallen over the last rounds by less than
    ``tolerance`` of the first loss.
    """
    value, slopes = loss(point)
    first, values, steps = value, [value], []
    for _ in range(rounds):
        if np.linalg.norm(slopes) <= max(tolerance * abs(value), 1e-8):
            break
        way, shares = slopes.copy(), []
        for s, y in reversed(steps):
            shares.append(s @ way / (s @ y))
            way -= shares[-1] * y
        if steps:
            s, y = steps[-1]
            way *= s @ y / (y @ y)
        for (s, y), share in zip(steps, reversed(shares)):
            way += (share - y @ way / (s @ y)) * s
        way = -way
        fall = slopes @ way
        # The step is doubled or halved until the loss falls enough and its slope has flattened.
        step, low, high = 1.0 if steps else 1 / np.linalg.norm(slopes), 0.0, np.inf
        for _ in range(20):
            new_value, new_slopes = loss(point + step * way)
            if not new_value <= value + 1e-4 * step * fall:
                high = step
            elif new_slopes @ way < 0.9 * fall:
                low = step
            else:
                break
            step = (low + high) / 2 if high < np.inf else 2 * low
        if not new_value < value:
            break
        moved, bent = step * way, new_slopes - slopes
        point, value, slopes = point + moved, new_value, new_slopes
        if moved @ bent > 0:
            steps = [*steps, (moved, bent)][-STEPS:]
        values = [*values, value][-RECENT:]
        if max(values) - value <= tolerance * abs(first):
            break
    return point


def fit_learnt(
    training: DataFrame,
    label: str = "lid_label",
    text: str = "text",
    sizes: tuple[int, ...] = SIZES,
    features: int = FEATURES,
    penalty: float = PENALTY,
    rounds: int = ROUNDS,
    tolerance: float = 1e-5,
    piece: int | None = PIECE,
    keep_newlines: bool = False,
) -> LearntModel:
    """Fit on all rows with a label and a text. At least one such row is needed.

    ``penalty`` is half the weight of the squared weights beside the mean loss; with any above zero the fit has one
    solution. A corpus of one label gives a model that is sure of it. Whole texts are learnt, in examples of ``piece``
    characters each; None takes a text as one example.
    """
    from linkloom.operators.lid import readable

    rows = training.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(label).alias("lid_label"), readable(text, keep_newlines).alias("text"))
    labels = tuple(sorted(row.lid_label for row in rows.select("lid_label").distinct().collect()))
    if not labels:
        raise ValueError("no row with a label and a text to learn from")
    places = places_for(len(labels), features)
    examples = coded(rows, labels, sizes, places, piece)
    return LearntModel(fit_weights(examples, len(labels), len(sizes), places, penalty, rounds, tolerance), labels, tuple(sizes), places)
