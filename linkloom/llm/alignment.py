"""Alignment of two tokenizers over the bytes of a text, with corpus-wide counts of linked ids.

Tokenizer A (byte-level BPE, ``tokenizers``) reads a space and the text, B (SentencePiece) the text, to which it adds the
space itself, so both cut the same bytes. Places where a token of A and one of B end together cut the text into groups; every
token of A in a group is linked with every one of B in it. The count of a pair of ids is the number of documents
that hold it linked.

All of it is Arrow columns: id lists are flattened with their parent indices, ends are cumulative sums of token lengths, common
ends are marks of both on the same bytes, and pairs are joined on their group
after equal ids in a group were counted, so that a group is never written out token by token; a group with many
different ids is joined in parts of ``PAIRS``. Documents are worked on in blocks of about ``BLOCK`` characters. A block
keeps each document's distinct pairs and sends out one partial count for each pair in it (``Table.group_by``); Spark
adds these up, and the counts come back to the blocks that asked for them, never to all. The only table sent
to all tasks has one row for each id of A.

Defined cases: texts that are null, empty or not what both tokenizers spell (one that holds U+2581, say) have no tokens; rows that
repeat are documents of their own; an empty table gives an empty result; only the key and the text are read, so
further columns have no effect.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from linkloom.llm.sentence_pieces import lists
from linkloom.session import stored

# Characters of text encoded at a time, and kept together as a block.
SLICE = 1 << 19
BLOCK = 1 << 23
# Pairs of ids that are joined at a time within groups.
PAIRS = 1 << 22
# A cuts before a space that stands between two characters that are no white space, whatever these are.
STRETCH_RE = re.compile(r"(?<=\S)(?= \S)")
# A piece of B that reaches over such a place.
ACROSS_RE = re.compile("[^\\s▁]▁")
# Stretches a worker remembers; it starts anew beyond that.
WORDS = 300_000
LONGEST_WORD = 64


def byte_level_alphabet() -> dict[str, int]:
    """Character of each byte in byte-level vocabularies: visible Latin-1 stands for itself, the rest follows from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{chr(b): b for b in visible}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Pieces:
    """Byte strings by number, gathered side by side."""

    def __init__(self, texts: list[bytes]):
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def joined(self, numbers: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The strings one after the other, and where each starts (and the last ends)."""
        sizes = self.lengths[numbers]
        reach = np.concatenate(([0], np.cumsum(sizes)))
        return self.bytes[np.repeat(self.starts[numbers] - reach[:-1], sizes) + np.arange(reach[-1])].tobytes(), reach


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        # A task has one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_level_alphabet()
        vocabulary = self.a.get_vocab()
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            # Added tokens are not byte-level; they never come out of a text.
            spelled[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else b""
        self.pieces_a = Pieces(spelled)
        self.size_a, self.size_b = len(spelled), self.b.get_piece_size()
        self.pieces_b = Pieces([piece_bytes(self.b, i) for i in range(self.size_b)])
        self.cuts_b = cuts_before_spaces(self.b)
        self.forget()
        # Decimal ids with the mark that follows inside a side and at its end, those of B behind those of A.
        marks = [(range(self.size_a), ",|"), (range(self.size_b), ",;")]
        self.decimals = Pieces([f"{i}{mark}".encode() for ids, pair in marks for mark in pair for i in ids])

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.stores = [Store(), Store()]

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of A and of B. Texts are cut where both always cut, and the ids of a stretch are remembered."""
        parts = [STRETCH_RE.split(" " + t) for t in texts]
        words = list(chain.from_iterable(parts))
        if len(self.places) > WORDS:
            self.forget()
        at = list(map(self.places.get, words))
        new = list({w for w, place in zip(words, at) if place is None})
        if new:
            first = len(self.stores[0].first) - 1
            self.places.update(zip(new, range(first, first + len(new))))
            at = map(self.places.__getitem__, words)
            self.stores[0].add([made.ids for made in self.a.encode_batch_fast(new, add_special_tokens=False)])
            if self.cuts_b:
                # B puts the space in front itself.
                self.stores[1].add(self.b.encode([w[1:] for w in new], num_threads=1))
        at = np.fromiter(at, dtype=np.int64, count=len(words))
        ends = np.cumsum([len(p) for p in parts])
        ids_a = self.stores[0].lists_at(at, ends)
        ids_b = self.stores[1].lists_at(at, ends) if self.cuts_b else self.encode_b(texts)
        for word in new:
            if len(word) > LONGEST_WORD:
                del self.places[word]
        if max(len(store.found) for store in self.stores) > 16 * WORDS:
            self.forget()
        return ids_a, ids_b

    def encode_b(self, texts: list[str]) -> pa.ListArray:
        found = self.b.encode(texts, num_threads=1)
        sizes = np.array([len(ids) for ids in found], dtype=np.int64)
        return lists(np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(sizes.sum())), sizes)


class Store:
    """Ids of stretches by number, gathered side by side."""

    def __init__(self):
        self.found = array("i")
        self.first = array("q", [0])

    def add(self, ids: list[list[int]]) -> None:
        for some in ids:
            self.found.extend(some)
            self.first.append(len(self.found))

    def lists_at(self, at: np.ndarray, ends: np.ndarray) -> pa.ListArray:
        """One list for each run of the numbers ``at``, which ends at the place in ``ends``."""
        first, found = np.frombuffer(self.first, dtype=np.int64), np.frombuffer(self.found, dtype=np.int32)
        sizes = first[at + 1] - first[at]
        reach = np.concatenate(([0], np.cumsum(sizes)))
        flat = found[np.repeat(first[at] - reach[:-1], sizes) + np.arange(reach[-1])] if len(at) else np.zeros(0, dtype=np.int32)
        return lists(flat, np.diff(reach[ends], prepend=0) if len(ends) else np.zeros(0, dtype=np.int64))


def cuts_before_spaces(given) -> bool:
    """Whether a SentencePiece model leaves texts as they are and has no piece across the borders of stretches."""
    if given.normalize(" a  b \n▁ﬁ") != "▁▁a▁▁b▁\n▁ﬁ":
        return False
    return not any(ACROSS_RE.search(given.id_to_piece(i)) for i in range(given.get_piece_size()))


def piece_bytes(given, i: int) -> bytes:
    """Bytes that id ``i`` of a SentencePiece model stands for; none for ids that no text has."""
    piece = given.id_to_piece(i)
    if given.is_byte(i):
        return bytes([int(piece[3:5], 16)])
    return b"" if given.is_control(i) or given.is_unknown(i) else piece.replace("▁", " ").encode()


@lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def spells(ids: pa.ListArray, pieces: Pieces, wanted: list[bytes]) -> np.ndarray:
    """Whether the tokens of each list spell the wanted bytes."""
    joined, reach = pieces.joined(ids.values.to_numpy())
    cuts = reach[ids.offsets.to_numpy()].tolist()
    return np.array([joined[a:b] == w for a, b, w in zip(cuts, cuts[1:], wanted)], dtype=bool)


def token_table(ids: pa.ListArray, pieces: Pieces) -> pa.Table:
    """One row per token: document, id, end of its bytes among those of all documents."""
    flat = pc.list_flatten(ids)
    reach = np.cumsum(pieces.lengths[flat.to_numpy()])
    return pa.table({"doc": pc.list_parent_indices(ids), "id": flat, "reach": pa.array(reach)})


def cut_groups(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Number of A and of B tokens of each group, in the order of the text."""
    ends_a, ends_b = a["reach"].to_numpy(), b["reach"].to_numpy()
    size = int(ends_a[-1]) + 1 if len(ends_a) else 0
    at_a, at_b = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
    at_a[ends_a], at_b[ends_b] = True, True
    # Both sides spell the same bytes, and ends rise, so the n-th common end is the n-th of each.
    cut_a, cut_b = np.flatnonzero(at_b[ends_a]), np.flatnonzero(at_a[ends_b])
    return np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)


def linked_pairs(a: pa.Table, b: pa.Table, n_a: np.ndarray, n_b: np.ndarray, size_b: int) -> pa.Table:
    """Distinct (document, pair of ids) with the number of links."""
    group_a, group_b = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
    single = (n_a == 1) & (n_b == 1)
    alone_a, alone_b = single[group_a], single[group_b]
    parts = [
        pa.table(
            {
                "doc": a["doc"].filter(pa.array(alone_a)),
                "pair": pa.array(a["id"].to_numpy()[alone_a].astype(np.int64) * size_b + b["id"].to_numpy()[alone_b]),
                "links": pa.array(np.ones(int(single.sum()), dtype=np.int64)),
            }
        )
    ]

    def counted(tokens: pa.Table, group: np.ndarray, alone: np.ndarray) -> pa.Table:
        some = tokens.select(["doc", "id"]).append_column("group", pa.array(group)).filter(pa.array(~alone))
        return some.group_by(["group", "doc", "id"], use_threads=False).aggregate([([], "count_all")]).sort_by("group")

    left, right = counted(a, group_a, alone_a), counted(b, group_b, alone_b)
    # Rows of the left side meet as many of the right as its group has there.
    meets = np.bincount(right["group"].to_numpy(), minlength=len(n_a))[left["group"].to_numpy()] if len(left) else np.zeros(0)
    share = np.cumsum(meets) // PAIRS
    for part in range(int(share[-1]) + 1 if len(share) else 0):
        span = np.searchsorted(share, [part, part + 1])
        some = left.slice(span[0], span[1] - span[0])
        met = some.join(right.select(["group", "id", "count_all"]), "group", join_type="inner", right_suffix="_b", use_threads=False)
        pair = pc.add(pc.multiply(met["id"].cast(pa.int64()), size_b), met["id_b"].cast(pa.int64()))
        part_table = pa.table({"doc": met["doc"], "pair": pair, "links": pc.multiply(met["count_all"], met["count_all_b"])})
        parts.append(summed(part_table, ["doc", "pair"], "links"))
    return summed(pa.concat_tables(parts), ["doc", "pair"], "links").sort_by("doc")


def summed(table: pa.Table, keys: list[str], value: str) -> pa.Table:
    found = table.group_by(keys, use_threads=False).aggregate([(value, "sum")])
    return found.rename_columns([*keys, value])


def group_texts(both: Tokenizers, a: pa.Table, b: pa.Table, n_a: np.ndarray, n_b: np.ndarray, n_docs: int) -> list[bytes]:
    """Groups of each document as ``a1,a2|b1;a3|b2,b3``."""
    ends_a, ends_b = np.cumsum(n_a), np.cumsum(n_b)
    marked_a, marked_b = a["id"].to_numpy().astype(np.int64), b["id"].to_numpy().astype(np.int64)
    marked_a[ends_a - 1] += both.size_a
    marked_b[ends_b - 1] += both.size_b
    # A's tokens of a group stand before B's.
    order = np.empty(len(marked_a) + len(marked_b), dtype=np.int64)
    order[np.arange(len(marked_a)) + np.repeat(ends_b - n_b, n_a)] = marked_a
    order[np.arange(len(marked_b)) + np.repeat(ends_a, n_b)] = marked_b + 2 * both.size_a
    joined, reach = both.decimals.joined(order)
    tokens = np.bincount(a["doc"].to_numpy(), minlength=n_docs) + np.bincount(b["doc"].to_numpy(), minlength=n_docs)
    cuts = reach[np.concatenate(([0], np.cumsum(tokens)))].tolist()
    return [joined[x : y - 1] if y > x else b"" for x, y in zip(cuts, cuts[1:])]


def align_slice(both: Tokenizers, texts: list[str | None], digest: bool) -> tuple[dict[str, pa.Array], pa.Table]:
    """Figures of each text, and its distinct pairs with ``doc`` as its place in the list."""
    held = [i for i, t in enumerate(texts) if t]
    ids_a, ids_b = both.encode([texts[i] for i in held])
    wanted = [b" " + texts[i].encode() for i in held]
    good = spells(ids_a, both.pieces_a, wanted) & spells(ids_b, both.pieces_b, wanted)
    none = pa.array([], pa.list_(pa.int32()))
    places = np.array(held, dtype=np.int64)[good]
    sizes = np.zeros(len(texts), dtype=np.int64)
    sizes[places] = 1
    # Lists of all texts, empty where there are no tokens, so that documents keep their places.
    at = pa.array(np.where(sizes > 0, np.cumsum(sizes) - 1, -1))
    at = pc.if_else(pc.less(at, 0), pa.scalar(None, pa.int64()), at)
    ids_a, ids_b = (
        filled(pc.take(pc.filter(ids, pa.array(good)) if len(held) else none, at)) for ids in (ids_a, ids_b)
    )
    a, b = token_table(ids_a, both.pieces_a), token_table(ids_b, both.pieces_b)
    n_a, n_b = cut_groups(a, b)
    group_doc = a["doc"].to_numpy()[np.cumsum(n_a) - 1] if len(n_a) else np.zeros(0, dtype=np.int64)
    links = np.zeros(len(texts), dtype=np.int64)
    np.add.at(links, group_doc, n_a * n_b)
    spelled = group_texts(both, a, b, n_a, n_b, len(texts))
    if digest:
        spelled = [hashlib.sha256(s).hexdigest() if s else "" for s in spelled]
    figures = {
        "n_a": pa.array(np.diff(ids_a.offsets.to_numpy()).astype(np.int64)),
        "n_b": pa.array(np.diff(ids_b.offsets.to_numpy()).astype(np.int64)),
        "n_groups": pa.array(np.bincount(group_doc, minlength=len(texts)).astype(np.int64)),
        "n_links": pa.array(links),
        "groups": pa.array(spelled, type=pa.string()) if digest else pa.array(spelled, type=pa.binary()).cast(pa.string()),
    }
    return figures, linked_pairs(a, b, n_a, n_b, both.size_b)


def filled(found: pa.ListArray) -> pa.ListArray:
    """The lists, side by side from the first value on, null ones empty."""
    sizes = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False)
    return lists(found.flatten().to_numpy(), sizes)


def slices(texts: list[str | None]) -> Iterator[tuple[int, int, int]]:
    """First, last + 1 and characters of runs of texts, one text at least."""
    start = chars = 0
    for i, text in enumerate(texts):
        if i > start and chars >= SLICE:
            yield start, i, chars
            start, chars = i, 0
        chars += len(text or "")
    if start < len(texts):
        yield start, len(texts), chars


def blocks_of(docs: DataFrame, key: str, text: str, path_a: str, path_b: str, digest: bool) -> DataFrame:
    """Per document a row with its pairs; per block a row without place with the pairs in it and how many documents hold each."""
    kind = docs.schema[key].dataType
    key_type = to_arrow_type(kind)
    long, many = T.LongType(), T.ArrayType(T.LongType())
    schema = T.StructType(
        [
            T.StructField("is_block", T.BooleanType()),
            T.StructField("block", long),
            T.StructField("key", kind),
            *[T.StructField(n, long) for n in ("n_a", "n_b", "n_groups", "n_links")],
            T.StructField("groups", T.StringType()),
            T.StructField("pairs", many),
            T.StructField("counts", many),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(path_a, path_b)
        block, chars, held = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, stop, size in slices(texts):
                figures, pairs = align_slice(both, texts[start:stop], digest)
                sizes = np.bincount(pairs["doc"].to_numpy(), minlength=stop - start)
                n = stop - start
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.zeros(n, dtype=bool)),
                        pa.array(np.full(n, block)),
                        batch.column(0).slice(start, n),
                        *figures.values(),
                        lists(pairs["pair"].to_numpy(), sizes),
                        lists(pairs["links"].to_numpy(), sizes),
                    ],
                    names=schema.names,
                )
                own = pairs.group_by("pair", use_threads=False).aggregate([([], "count_all")])
                held.append(own.rename_columns(["pair", "docs"]))
                chars += size
                if chars >= BLOCK:
                    yield block_row(block, held)
                    block, chars, held = block + 1, 0, []
        if held:
            yield block_row(block, held)

    def block_row(block: int, held: list[pa.Table]) -> pa.RecordBatch:
        own = summed(pa.concat_tables(held), ["pair"], "docs")
        n = np.array([len(own)])
        values = [pa.array([True]), pa.array([block]), pa.nulls(1, key_type), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string())]
        return pa.RecordBatch.from_arrays(
            [*values, lists(own["pair"].to_numpy(), n), lists(own["docs"].to_numpy(), n)], names=schema.names
        )

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(work, schema)


def pair_counts(pairs: DataFrame, size_b: int) -> DataFrame:
    """``pair``, ``docs`` that hold it, and whether no other pair of its A id is held by more."""
    counts = stored(pairs.groupBy("pair").agg(F.sum("docs").alias("docs")), "pair_counts")
    a = F.expr(f"pair div {size_b}")
    # One row for each id of A, so its size is bounded by the vocabulary.
    best = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))
    return counts.withColumn("a", a).join(F.broadcast(best), "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``, ``n_best``, ``count_sum``.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``, or the SHA-256 of that with ``digest`` (empty without tokens). ``n_best`` counts the links
    whose pair no other pair of the same A id outnumbers, ``count_sum`` adds up the counts of all links.
    """
    made = stored(blocks_of(docs, key, text, path_a, path_b, digest), "alignment", ("is_block",))
    held = made.where("is_block").select("block", F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("docs"))).alias("p"))
    held = held.select("block", "p.pair", "p.docs")
    counts = pair_counts(held.select("pair", "docs"), tokenizers(path_a, path_b).size_b)
    answers = held.select("block", "pair").join(counts, "pair").select(F.col("block").alias("asked_by"), "pair", "docs", "best")
    kept = ["key", "n_a", "n_b", "n_groups", "n_links", "groups"]
    rows = made.where("NOT is_block").select("block", *kept, "pairs", "counts")
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        pairs, counts = as_lists(rows["pairs"]), as_lists(rows["counts"])
        links = pa.table({"doc": pc.list_parent_indices(pairs), "pair": pc.list_flatten(pairs), "links": pc.list_flatten(counts)})
        met = links.join(answers.select(["pair", "docs", "best"]), "pair", join_type="inner", use_threads=False)
        totals = pa.table(
            {
                "doc": met["doc"],
                "n_best": pc.multiply(met["links"], met["best"].cast(pa.int64())),
                "count_sum": pc.multiply(met["links"], met["docs"]),
            }
        ).group_by("doc", use_threads=False).aggregate([("n_best", "sum"), ("count_sum", "sum")])
        at = totals["doc"].to_numpy()
        out = rows.select(kept)
        for name in ("n_best", "count_sum"):
            values = np.zeros(len(rows), dtype=np.int64)
            values[at] = totals[f"{name}_sum"].to_numpy()
            out = out.append_column(name, pa.array(values))
        return out

    return rows.groupBy("block").cogroup(answers.groupBy("asked_by")).applyInArrow(score, schema).withColumnRenamed("key", key)


def as_lists(column: pa.ChunkedArray) -> pa.ListArray:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)
