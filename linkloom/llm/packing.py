"""Best-fit packing with large-item matching.

Documents become token ids with an end mark; only those longer than a sequence are cut. How
pieces share sequences depends on their lengths alone, so the plan is made for the histogram of lengths,
``capacity`` counts at most, whatever the number of documents: pieces above a third of the
capacity are matched greedily, each with the longest that still fits, at most two to a sequence;
shorter ones, longest first, go where the least room that is enough is left. Runs of
sequences with equal contents are planned at once. The plan says which ranks of a
length go where; it has at most a few entries for each pair of lengths that can share a sequence,
far below ``capacity ** 2``, and is sent to all tasks.

A piece's rank among those of its length is its number in its task plus the numbers of earlier tasks, so
pieces are never sorted or gathered by length. The token ids are written once, by the task that makes
them, and stay where they are; ``sequences`` brings them together.

Words are looked up in a store of at most ``WORDS`` entries that each worker fills with the tokenizer.

Defined cases: a null text counts as empty and gives one piece, the end mark; repeated rows and ids
are packed one by one; ties in length are in order of tasks and rows; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import bisect
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from linkloom.session import shared_path

CAPACITY = 2048
END = 0
# Words that a worker remembers; it starts anew beyond that.
WORDS = 2_000_000
# Bytes of text looked up at a time; a text is cut at white space only.
BLOCK = 1 << 18
BLANKS = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
# Longer words, in bytes, have keys of another kind.
LONG = 200
MIX = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], dtype=np.uint64)
# How the vocabulary marks tokens that end a word.
WORD_END = "</w>"
# Small Latin letters, and ASCII marks without the apostrophe, which can belong to the letters after it.
# Any other word fills the third group.
LATIN = re.compile("(?:([a-zß-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)|([^ ]+))(?: |$)")
# Bytes of text whose pieces are sent on at a time.
CHUNK = 1 << 21

# The id travels as text, as a null beside numbers would make them inexact on the way.
PIECES = "id string, piece int, start long, length int, ids binary, part int, row long, place long"


class Words:
    """Token ids of white-space-free strings, each encoded once.

    The tokenizer drops white space and no token spans it, so a text's ids are those of its words. Letters A-Z
    are made small first, as the tokenizer does, unless a special token may occur. A word of Latin letters,
    alone or before ASCII marks, is for the tokenizer one run of letters and one of marks; many such runs
    are encoded at once, without the steps that leave them as they are (normal form, lower case, splitting),
    and each ends at a token with the vocabulary's end mark. All other words go through the whole tokenizer.

    Words are known by a 64-bit hash, in arrays: all words of a block of text are hashed and looked up together.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.runs, self.ascii_runs = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=False)
        self.runs.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), to_bytes])
        # ASCII letters stand for their own bytes.
        self.ascii_runs.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.blank = np.zeros(256, dtype=bool)
        self.blank[[b[0] for b in BLANKS]] = True
        base = 0x9E3779B97F4A7C15
        self.power, self.back = (
            np.concatenate([np.ones(1, dtype=np.uint64), np.cumprod(np.full(BLOCK, b, dtype=np.uint64))])
            for b in (base, pow(base, -1, 1 << 64))
        )
        self.marks: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.marks.clear()
        self.keys, self.places = np.zeros(1 << 16, dtype=np.uint64), np.zeros(1 << 16, dtype=np.int32)
        self.count = self.filled = 0
        self.starts, self.sizes = np.zeros(1 << 15, dtype=np.int32), np.zeros(1 << 15, dtype=np.int32)
        self.own, self.flat = np.zeros(1 << 15, dtype=np.uint64), np.zeros(1 << 17, dtype="<u4")

    def words_of(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and key of each word; a word's key depends on its bytes alone."""
        letters = np.frombuffer(data, dtype=np.uint8)
        inside = np.zeros(len(letters) + 2, dtype=np.int8)
        inside[1:-1] = ~self.blank[letters]
        edge = np.diff(inside)
        first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        summed = np.zeros(len(letters) + 1, dtype=np.uint64)
        np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * self.power[: len(letters)], out=summed[1:])
        key = (summed[end] - summed[first]) * self.back[first] + (end - first).astype(np.uint64) * MIX[2]
        key = (key ^ (key >> np.uint64(32))) * MIX[0]
        key = (key ^ (key >> np.uint64(29))) * MIX[1]
        key ^= key >> np.uint64(32)
        # Sums over long words are weak keys.
        for i in np.flatnonzero(end - first > LONG):
            key[i] = xxhash.xxh3_64_intdigest(data[first[i] : end[i]])
        return first, end, np.maximum(key, np.uint64(1))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each known word, or -1: open addressing, all words a step at a time."""
        mask = np.uint64(len(self.keys) - 1)
        found, left, slot = np.full(len(keys), -1, dtype=np.int32), np.arange(len(keys)), keys & mask
        while len(left):
            there = self.keys[slot]
            hit = there == keys
            found[left[hit]] = self.places[slot[hit]]
            on = ~hit & (there != 0)
            left, keys, slot = left[on], keys[on], (slot[on] + np.uint64(1)) & mask
        return found

    def _enter(self, keys: np.ndarray, places: np.ndarray) -> None:
        mask = np.uint64(len(self.keys) - 1)
        slot = keys & mask
        while len(keys):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[free]
            won = self.keys[slot] == keys
            self.places[slot[won]] = places[won]
            keys, places, slot = keys[~won], places[~won], (slot[~won] + np.uint64(1)) & mask

    def _add(self, keys: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        """New words, none of them known, with their ids one after the other."""
        n, m = self.count + len(keys), self.filled + len(flat)
        while n > len(self.own):
            self.own, self.starts, self.sizes = (np.concatenate([a, np.zeros_like(a)]) for a in (self.own, self.starts, self.sizes))
        while m > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.own[self.count : n], self.sizes[self.count : n] = keys, sizes
        self.starts[self.count : n] = self.filled + np.cumsum(sizes) - sizes
        self.flat[self.filled : m] = flat
        if 2 * n > len(self.keys):
            size = 1 << (4 * n).bit_length()
            self.keys, self.places = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int32)
            self._enter(self.own[:n], np.arange(n, dtype=np.int32))
        else:
            self._enter(keys, np.arange(self.count, n, dtype=np.int32))
        self.count, self.filled = n, m

    def gather(self, at: np.ndarray) -> np.ndarray:
        """The ids of known words, one after the other."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]

    def _whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers from the whole tokenizer."""
        found = [f.ids for f in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.array([len(f) for f in found], dtype=np.int64)
        return np.array([i for f in found for i in f], dtype="<u4"), sizes

    def learn(self, words: list[bytes], keys: np.ndarray) -> None:
        """Words that are not known yet, each once."""
        joined = b" ".join(words)
        found = LATIN.findall(joined.decode().lower())
        special = {i for i, word in enumerate(words) if b"<|" in word} if b"<|" in joined else ()
        runs: dict[str, int] = {}
        of = [runs.setdefault(run, len(runs)) if run and i not in special else -1 for i, (run, _, _) in enumerate(found)]
        of = np.array(of, dtype=np.int64)
        named = list(runs)
        _, _, own = self.words_of(" ".join(named).encode())
        new = np.flatnonzero(self.find(own) < 0).tolist()
        ascii_ = [i for i in new if named[i].isascii()]
        other = [i for i in new if not named[i].isascii()]
        for which, tokenizer in ((ascii_, self.ascii_runs), (other, self.runs)):
            if which:
                texts = [" ".join([named[i] for i in which[k : k + 256]]) for k in range(0, len(which), 256)]
                encoded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
                flat = np.concatenate([np.array(f.ids, dtype="<u4") for f in encoded])
                self._add(own[which], flat, np.diff(np.flatnonzero(self.ends[flat]), prepend=-1))
        # Words that are a run are known by now, and so is a run that was met within another word.
        unknown = self.find(keys) < 0
        odd = np.flatnonzero(unknown & (of < 0))
        if len(odd):
            self._add(keys[odd], *self._whole([words[i].decode() for i in odd.tolist()]))
        pairs = np.flatnonzero(unknown & (of >= 0))
        if len(pairs):
            marks = [found[i][1] for i in pairs.tolist()]
            unmet = sorted(set(marks) - self.marks.keys() - {""})
            if unmet:
                # Marks have keys of their own kind, so that they never stand for words.
                self.marks |= {m: self.count + k for k, m in enumerate(unmet)}
                self._add(np.array([xxhash.xxh3_64_intdigest(m, seed=1) for m in unmet], dtype=np.uint64), *self._whole(unmet))
            parts = np.stack([self.find(own)[of[pairs]], [self.marks.get(m, -1) for m in marks]], axis=1)
            sizes = self.sizes[parts[:, 0]] + np.where(parts[:, 1] >= 0, self.sizes[parts[:, 1]], 0)
            self._add(keys[pairs], self.gather(parts[parts >= 0]), sizes)

    def block(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of a block of text, the start of each word, and the number of ids before each word and after the last."""
        first, end, keys = self.words_of(data)
        at = self.find(keys)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            if self.count + len(missing) > WORDS:
                self.clear()
                missing = np.arange(len(keys))
            new, place = np.unique(keys[missing], return_index=True)
            place = missing[place]
            self.learn([data[a:b] for a, b in zip(first[place].tolist(), end[place].tolist())], new)
            at = self.find(keys)
        return self.gather(at), first, np.concatenate([[0], np.cumsum(self.sizes[at])])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, little-endian, the end mark last."""
        mark, out = END.to_bytes(4, "little"), []
        held, size = [], 0

        def emptied() -> None:
            if held:
                ids, first, upto = self.block(b"\n".join(held))
                data = ids.tobytes()
                ends = np.searchsorted(first, np.cumsum([len(t) + 1 for t in held]))
                cuts = (4 * upto[np.concatenate([[0], ends])]).tolist()
                out.extend(data[a:b] + mark for a, b in zip(cuts, cuts[1:]))
                held.clear()

        for text in texts:
            text = text if b"<|" in text else text.lower()
            if size + len(text) + 1 > BLOCK:
                emptied()
                size = 0
            if len(text) > BLOCK:
                parts = (self.block(p)[0] if len(p) <= BLOCK else self._whole([p.decode()])[0] for p in blocks(text))
                out.append(b"".join(p.tobytes() for p in parts) + mark)
            else:
                held.append(text)
                size += len(text) + 1
        emptied()
        return out


def blocks(text: bytes) -> Iterator[bytes]:
    """A long text in parts of up to ``BLOCK`` bytes that end at white space; a longer word is a part alone."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > BLOCK:
            end = max(text.rfind(blank, at, at + BLOCK) for blank in BLANKS) + 1
            if end <= at:
                end = min((k for k in (text.find(blank, at) for blank in BLANKS) if k >= 0), default=len(text))
        yield text[at:end]
        at = end


_WORDS: dict[str, Words] = {}


def _cutter(path: str, capacity: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if path not in _WORDS:
            _WORDS[path] = Words(path)
        part, row = TaskContext.get().partitionId(), 0
        met = np.zeros(capacity + 1, dtype=np.int64)
        for rows in batches:
            texts = [t.encode() if t is not None else b"" for t in rows["text"]]
            sizes = np.cumsum([len(t) for t in texts])
            first = 0
            while first < len(texts):
                till = bisect.bisect_right(sizes, (sizes[first - 1] if first else 0) + CHUNK, first + 1)
                ids = _WORDS[path].encode(texts[first:till])
                lengths = np.array([len(own) // 4 for own in ids], dtype=np.int64)
                pieces = -(-lengths // capacity)
                owner = np.repeat(np.arange(len(lengths)), pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(lengths[owner] - start, capacity)
                # The number of each piece among those of its length.
                order = np.argsort(length, kind="stable")
                into = np.arange(len(order)) - np.searchsorted(length[order], length[order])
                place = np.empty(len(order), dtype=np.int64)
                place[order] = into
                place += met[length]
                met += np.bincount(length, minlength=capacity + 1)
                yield pd.DataFrame(
                    {
                        "id": rows["id"].iloc[first:till].take(owner).array,
                        "piece": piece.astype(np.int32),
                        "start": start,
                        "length": length.astype(np.int32),
                        "ids": [ids[i][4 * a : 4 * (a + n)] for i, a, n in zip(owner.tolist(), start.tolist(), length.tolist())],
                        "part": np.int32(part),
                        "row": row + owner,
                        "place": place,
                    }
                )
                row += till - first
                first = till

    return cut


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces with their ids (little-endian, 32 bits), ``part`` and ``row`` of the document, stored."""
    rows = docs.select(docs[id].cast("string").alias("id"), docs[text].alias("text"))
    made = rows.mapInPandas(_cutter(path, capacity), PIECES)
    made = made.withColumn("id", F.col("id").cast(docs.schema[id].dataType))
    target = shared_path(docs.sparkSession, "pieces")
    made.write.option("compression", "zstd").parquet(target)
    return docs.sparkSession.read.schema(made.schema).parquet(target)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, first sequence, pieces to a sequence, offset) for runs of pieces."""
    entries: list[tuple[int, int, int, int, int, int]] = []
    given = {n: 0 for n in counts}
    left = {n: c for n, c in counts.items() if c}
    # Runs of sequences (first, how many) by the room they have, and the rooms in order.
    runs: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    opened = 0

    def put(length: int, pieces: int, first: int, each: int, offset: int) -> None:
        entries.append((length, given[length], pieces, first, each, offset))
        given[length] += pieces
        left[length] -= pieces
        if not left[length]:
            del left[length]

    def leave(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in runs:
                bisect.insort(rooms, room)
                runs[room] = []
            runs[room].append((first, n))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        if a not in left:
            large.pop()
            continue
        fits = [b for b in large[: bisect.bisect_right(large, capacity - a)] if left.get(b, 0) > (b == a)]
        if not fits:
            n = left[a]
            put(a, n, opened, 1, 0)
            leave(capacity - a, opened, n)
        elif fits[-1] == a:
            n = left[a] // 2
            put(a, 2 * n, opened, 2, 0)
            leave(capacity - 2 * a, opened, n)
        else:
            b = fits[-1]
            n = min(left[a], left[b])
            put(a, n, opened, 1, 0)
            put(b, n, opened, 1, a)
            leave(capacity - a - b, opened, n)
        opened += n
    for a in sorted(left, reverse=True):
        while a in left:
            i = bisect.bisect_left(rooms, a)
            if i < len(rooms):
                room = rooms[i]
                first, n = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[i]
            else:
                each = capacity // a
                room, first, n = capacity, opened, -(-left[a] // each)
                opened += n
            each = room // a
            whole = min(left[a] // each, n)
            if whole:
                put(a, whole * each, first, each, capacity - room)
                leave(room - each * a, first, whole)
            rest = left.get(a, 0) if whole < n else 0
            if rest:
                put(a, rest, first + whole, rest, capacity - room)
                leave(room - rest * a, first + whole, 1)
                whole += 1
            leave(room, first + whole, n - whole)
    return entries


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` of each piece, beside its columns without the ids."""
    spark = pieces.sparkSession
    light = pieces.select(*[c for c in pieces.columns if c != "ids"])
    numbers = light.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in numbers.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    entries = spark.createDataFrame(
        plan(counts, capacity),
        "of int, first_rank long, ranks long, first_sequence long, each long, first_offset long",
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = numbers.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = light.join(earlier, ["length", "part"]).withColumn("rank", F.col("earlier") + F.col("place"))
    here = (
        (F.col("length") == F.col("of"))
        & (F.col("rank") >= F.col("first_rank"))
        & (F.col("rank") < F.col("first_rank") + F.col("ranks"))
    )
    into = F.col("rank") - F.col("first_rank")
    return (
        ranked.join(F.broadcast(entries), here)
        .withColumn("sequence_id", F.col("first_sequence") + F.expr("(rank - first_rank) div each"))
        .withColumn("offset", F.col("first_offset") + F.pmod(into, F.col("each")) * F.col("length"))
        .select("id", "part", "row", "piece", "start", "length", "sequence_id", "offset")
    )


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """``sequence_id``, ``ids`` (binary, as in the pieces) and ``length``: the packed sequences."""
    keys = ["part", "row", "piece"]
    found = placed.select(*keys, "sequence_id", "offset").join(pieces.select(*keys, "ids"), keys)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = found.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return whole.select("sequence_id", ids.alias("ids")).withColumn("length", F.expr("octet_length(ids) div 4"))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece with the checksum of its ids and its place: the packing without the ids themselves."""
    pieces = cut_pieces(docs, path, capacity, id, text)
    keys = ["part", "row", "piece"]
    sums = pieces.select(*keys, F.crc32("ids").alias("ids_crc32"))
    return place_pieces(pieces, capacity).join(sums, keys).select(
        F.col("id").alias("doc_id"),
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "sequence_id",
        "offset",
    )
