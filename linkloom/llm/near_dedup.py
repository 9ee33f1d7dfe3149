"""Near-dedup by fast similarity sketching, banding and exact verification.

A text's set holds its distinct five-word shingles. Its sketch has ``SIZE`` coordinates, filled in
rounds: in round i below ``SIZE`` each element falls into one hashed bin with a value in
[i, i + 1), in round i from ``SIZE`` on each element falls into bin i - ``SIZE``; a bin keeps its
least value, and the rounds end when all bins are filled, after 2 * ``SIZE`` at most. Coordinates
of two sets agree with a chance equal to their similarity, concentrated as if independent.

``BANDS`` bands of ``ROWS`` coordinates name buckets. Equal sets are first made one; buckets with
the same members are looked at once. Inside a bucket every pair that is not yet connected there is
checked on the full sets, by a search that takes found sets out of the bucket, and only the links to
the least member of each group found leave the task, so a bucket of m sets gives fewer than m rows.
A bucket with more than ``BLOCK`` shingles is split into blocks, and pairs of blocks are dealt to
tasks, so that no task holds more than two blocks. At similarity 0.85 a pair
shares no bucket with a chance of 7e-7. For another least similarity give ``part`` with ``bands`` and
``rows`` that fit it: at 0.80, 36 bands of 5 miss a pair with a chance of 6e-7.

Nodes of the graph are the sets, by a 128-bit digest, so null and repeated ids do no harm.

Defined cases: words are runs of characters other than space and U+0009 to U+000D, A-Z in lower
case; fewer than five words make one shingle; null and empty texts have no
shingles and are linked with nothing, each its own component; a null id never names a component if
another id is in it; rows repeated in id and text are in one component; an empty table gives an empty
result; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from linkloom.llm.components import components
from linkloom.session import stored

WORDS = 5
ROWS, BANDS = 6, 30
SIZE = ROWS * BANDS
# Linked when PART * union <= 100 * intersection, unless another part is given.
PART = 85
# Shingles in a block of a large bucket.
BLOCK = 1 << 19
# Shingles sketched at a time.
CHUNK = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    # bytes.lower and bytes.split know exactly A-Z and the six blank bytes.
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(words) - WORDS + 1
    state = np.zeros(n, dtype=np.uint64)
    for k in range(WORDS):
        state = mixed(state * _MIX + hashes[k : k + n])
    return np.unique(state)


def sketches(sets: list[np.ndarray], size: int = SIZE) -> np.ndarray:
    """A row of ``size`` coordinates for each non-empty set; 64-bit values that name round and hash."""
    counts = np.array([len(s) for s in sets], dtype=np.int64)
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), counts)
    full = np.full(len(sets) * size, np.iinfo(np.uint64).max, dtype=np.uint64)
    empty = np.ones(len(full), dtype=bool)
    for i in range(2 * size):
        hashed = mixed(elements + np.uint64(int(_MIX) * (i + 1) & 0xFFFFFFFFFFFFFFFF))
        if i < size:
            bins = ((hashed >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        else:
            bins = np.full(len(hashed), i - size, dtype=np.uint64)
        at = owner * size + bins.astype(np.int64)
        # Bins filled in an earlier round hold lesser values.
        free = empty[at]
        value = (np.uint64(i) << np.uint64(48)) | (mixed(hashed) >> np.uint64(16))
        np.minimum.at(full, at[free], value[free])
        empty[at[free]] = False
        left = empty.reshape(len(sets), size).any(axis=1)
        if not left.any():
            break
        keep = left[owner]
        elements, owner = elements[keep], owner[keep]
    return full.reshape(len(sets), size)


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band."""
    n, size = sketch.shape
    parts = sketch.reshape(n, size // rows, rows)
    key = np.broadcast_to(np.arange(size // rows, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(rows):
        key = mixed(key * _MIX + parts[:, :, k])
    return key


def _digest(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def _groups(texts: pd.Series) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Sets by places, about ``CHUNK`` shingles at a time."""
    places, sets, held = [], [], 0
    for i, text in enumerate(texts):
        own = shingle_set(text)
        places.append(i)
        sets.append(own)
        held += len(own)
        if held >= CHUNK:
            yield places, sets
            places, sets, held = [], [], 0
    yield places, sets


SKETCHED = T.StructType(
    [
        T.StructField("node", T.BinaryType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def _sketcher(n_bands: int, rows: int):
    @F.pandas_udf(SKETCHED)
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            nodes, sizes, bands = [], [], []
            for _, sets in _groups(texts):
                filled = [s for s in sets if len(s)]
                keys = iter(band_keys(sketches(filled, n_bands * rows), rows).view(np.int64) if filled else ())
                for own in sets:
                    nodes.append(_digest(own) if len(own) else None)
                    sizes.append(len(own))
                    bands.append(next(keys) if len(own) else None)
            yield pd.DataFrame({"node": nodes, "n_shingles": sizes, "bands": bands})

    return sketch


def _full_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The set of each text that is the one asked for."""
    for rows in batches:
        sets = [(node, shingle_set(text)) for node, text in zip(rows["node"], rows["text"])]
        found = [(node, own.tobytes()) for node, own in sets if _digest(own) == node]
        yield pd.DataFrame(found, columns=["node", "shingles"])


def links_of(nodes: list[bytes], sets: list[np.ndarray], part: int = PART) -> list[tuple[bytes, bytes]]:
    """Links from the least node of each connected group to its others, by full sets."""
    order = sorted({n: i for i, n in enumerate(nodes)}.items())
    nodes, sets = [n for n, _ in order], [sets[i] for _, i in order]
    if len(nodes) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        union = len(sets[0]) + len(sets[1]) - both
        return [(nodes[0], nodes[1])] if 100 * both >= part * union else []
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    values, cells = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(values), dtype=np.int64)
    # The sets not found yet, one after the other.
    left, owner = np.arange(len(nodes)), np.repeat(np.arange(len(nodes)), sizes)
    starts = np.cumsum(sizes) - sizes
    ends = starts + sizes
    found = []
    while len(left):
        head, waiting = left[0], [left[0]]
        left = left[1:]
        while waiting and len(left):
            at = waiting.pop()
            own = cells[starts[at] : ends[at]]
            near = left[(100 * np.minimum(sizes[left], sizes[at]) >= part * np.maximum(sizes[left], sizes[at]))]
            if not len(near):
                continue
            mark[own] = 1
            if len(near) * 8 > len(nodes):
                both = np.add.reduceat(mark[cells], starts)[near]
            else:
                both = np.array([mark[cells[starts[x] : ends[x]]].sum() for x in near])
            mark[own] = 0
            new = near[100 * both >= part * (sizes[near] + sizes[at] - both)]
            if len(new):
                found += [(nodes[head], nodes[x]) for x in new]
                waiting += new.tolist()
                left = left[~np.isin(left, new)]
    return found


def _verifier(part: int):
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Links of each task (bucket and pair of blocks); rows come sorted by it."""
        key, nodes, sets = None, [], []
        for rows in batches:
            out = []
            tasks = zip(rows["bucket"], rows["i"], rows["j"])
            for task, node, own in zip(tasks, rows["node"], rows["shingles"]):
                if task != key:
                    if len(nodes) > 1:
                        out += links_of(nodes, sets, part)
                    key, nodes, sets = task, [], []
                nodes.append(node)
                sets.append(np.frombuffer(own, dtype=np.uint64))
            yield pd.DataFrame(out, columns=["a", "b"])
        if len(nodes) > 1:
            yield pd.DataFrame(links_of(nodes, sets, part), columns=["a", "b"])

    return verify


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``id``, ``key`` (64-bit hash of id and text) and ``text``."""
    return docs.select(docs[id].alias("id"), F.xxhash64(docs[id], docs[text]).alias("key"), docs[text].alias("text"))


def sketched(docs: DataFrame, id: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``id``, ``key``, ``node``, ``n_shingles`` and ``bands`` of each row, stored."""
    made = _rows(docs, id, text).withColumn("made", _sketcher(bands, rows)("text"))
    return stored(made.select("id", "key", "made.*"), "sketches")


def verified_links(docs: DataFrame, light: DataFrame, id: str, text: str, block: int = BLOCK, part: int = PART) -> DataFrame:
    """Links (a, b) between nodes, enough of them to connect whatever is connected in a bucket."""
    named = light.where("node is not null")
    # One row stands for all with the same set.
    one = F.min_by(F.struct("id", "key", "n_shingles", "bands"), F.struct("key", "id"))
    classes = stored(named.groupBy("node").agg(one.alias("one")).select("node", "one.*"), "classes")
    members = classes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(
        F.count("*").alias("members"),
        F.sum("n_shingles").alias("held"),
        F.bit_xor(F.xxhash64("node")).alias("mark"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("mark2"),
    )
    # Of buckets with the same members one is enough.
    chosen = buckets.where("members > 1").groupBy("members", "held", "mark", "mark2")
    chosen = chosen.agg(F.min("bucket").alias("bucket")).select(
        "bucket", F.ceil(F.col("held") / F.lit(block)).cast("int").alias("blocks")
    )
    asked = stored(members.select("node", "bucket").join(chosen, "bucket"), "asked")
    # Block b of a bucket meets every other block; up to two blocks are one task.
    tasks = (
        asked.withColumn("own", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("blocks") > 2, F.col("blocks") - 1).otherwise(0))))
        .where("blocks <= 2 or own <> other")
        .select(
            "node",
            "bucket",
            F.when(F.col("blocks") <= 2, 0).otherwise(F.least("own", "other")).alias("i"),
            F.when(F.col("blocks") <= 2, 0).otherwise(F.greatest("own", "other")).alias("j"),
        )
    )
    # Each wanted text moves once, becomes its set, and that goes to its tasks.
    wanted = classes.join(asked.select("node").distinct(), "node", "left_semi").select(
        "key", F.col("id").alias("id_"), "node"
    )
    sets = wanted_sets(docs, wanted, id, text)
    dealt = tasks.join(sets, "node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return dealt.select("bucket", "i", "j", "node", "shingles").mapInPandas(_verifier(part), "a binary, b binary")


def wanted_sets(docs: DataFrame, wanted: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``node`` and ``shingles`` of each wanted (key, id_, node): of rows that repeat, one."""
    held = _rows(docs, id, text).join(wanted, "key").where(F.col("id").eqNullSafe(F.col("id_")))
    return held.select("node", "text").dropDuplicates(["node"]).mapInPandas(_full_sets, "node binary, shingles binary")


def near_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", part: int = PART, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``id``, ``key`` (hash of id and text), ``n_shingles``, ``root`` and ``component_id`` of each row."""
    light = sketched(docs, id, text, bands, rows)
    roots = components(verified_links(docs, light, id, text, part=part))
    rooted = light.join(roots, "node", "left").select(
        "id", "key", "n_shingles", F.coalesce("root", "node").alias("root")
    )
    named = rooted.where("root is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    columns = ["id", "key", "n_shingles", "root", "component_id"]
    linked = rooted.where("root is not null").join(named, "root").select(*columns)
    alone = rooted.where("root is null").withColumn("component_id", F.col("id"))
    return linked.unionByName(alone.select(*columns))


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text", part: int = PART, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """The row with the least id of each group, with the columns of ``docs``; of equal rows one."""
    heads = near_groups(docs, id, text, part, bands, rows).where(F.col("id").eqNullSafe(F.col("component_id")))
    # Only rows that share their id can tie; rows without shingles are groups of their own.
    place = F.row_number().over(Window.partitionBy("root").orderBy("key"))
    kept = heads.withColumn("place", place).where("place = 1 or root is null")
    kept = kept.select("key", F.col("id").alias("id_"), "root").distinct()
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    keyed = docs.select(row, docs[id].alias("id"), F.xxhash64(docs[id], docs[text]).alias("key"))
    found = keyed.join(kept, "key").where(F.col("id").eqNullSafe(F.col("id_")))
    again = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    return found.withColumn("again", again).where("again = 1 or root is null").select("row.*")
