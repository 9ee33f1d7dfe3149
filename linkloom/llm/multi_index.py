"""Approximate nearest neighbours with an inverted multi-index.

Unit vectors are cut into two halves, each quantised by its own k-means codebook, so ``k`` + ``k`` centroids
make ``k * k`` cells. A query walks the cells by the sum of its two squared distances to the
centroids, with a heap over the two sorted lists, until the cells hold ``reach`` entries, and all
entries of those cells are ranked anew by cosine in double precision on the original vectors.

Every row is indexed. The codebooks are fitted on a bounded sample (``FIT_ROWS``), and ``reach`` is set from
``TUNE_QUERIES`` rows that are compared with all rows: it is the least number of entries that
holds ``AIM`` of their true neighbours.

Of equal vectors only the ``top + 1`` smallest ids can be among anyone's neighbours, so only those
are entries, and equal queries are answered once. Cells beyond ``BLOCK_ROWS`` entries are dealt
out in blocks and queries in groups, so a task holds one block and one group.

Defined cases: vectors that are null, zero, of another length than the most common one or hold a null or
non-finite component take no part; rows with a null id neither; rows repeated in id and vector count once;
ties go to the smaller id; with fewer candidates all are returned; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from linkloom.session import stored

FIT_ROWS = 20_000
TUNE_QUERIES = 256
AIM = 0.97
CELL_ROWS = 200
MOST_CENTROIDS = 256
BLOCK_ROWS = 20_000
GROUP_QUERIES = 50_000
FOUND = "query long, vec_id long, score double"


def valid_vectors(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """``vec_id`` and ``v`` (array of doubles) of the rows that take part."""
    v = vectors[vector].cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(sound & F.exists(v, lambda x: x != 0)).select(vectors[id].cast("long").alias("vec_id"), v.alias("v"))
    rows = rows.where("vec_id is not null").distinct()
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"))
    size = sizes.orderBy(F.desc("rows"), "n").first()
    return rows.where(F.size("v") == F.lit(size["n"] if size else 0))


def matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def near_one(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, which changes no cosine, so that no square overflows or vanishes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def unit(x: np.ndarray) -> np.ndarray:
    # The largest component first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def k_means(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Lloyd's algorithm from rows spread over the sample; an empty cell keeps its centre."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return distances(x, centres).argmin(axis=1)


class MultiIndex:
    """The two codebooks and, once counted, the entries of each cell."""

    def __init__(self, sample: np.ndarray, k: int):
        x = unit(sample)
        self.cut = x.shape[1] // 2
        self.k = min(k, len(x))
        self.books = [k_means(x[:, : self.cut], self.k), k_means(x[:, self.cut :], self.k)]
        self.sizes = np.zeros(self.k * self.k, dtype=np.int64)

    def cells(self, x: np.ndarray) -> np.ndarray:
        u = unit(x)
        return nearest(u[:, : self.cut], self.books[0]) * self.k + nearest(u[:, self.cut :], self.books[1])

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u = unit(x)
        return distances(u[:, : self.cut], self.books[0]), distances(u[:, self.cut :], self.books[1])

    def walk(self, left: np.ndarray, right: np.ndarray) -> Iterator[int]:
        """Cells by the sum of the distances of their halves."""
        a, b = left.argsort(kind="stable"), right.argsort(kind="stable")
        left, right = left[a].tolist(), right[b].tolist()
        # A pair enters the heap once both pairs that come before it have left.
        done = [0] * self.k
        heap = [(left[0] + right[0], 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            yield int(a[i]) * self.k + int(b[j])
            done[i] = j + 1
            if i + 1 < self.k and (j == 0 or done[i + 1] == j):
                heapq.heappush(heap, (left[i + 1] + right[j], i + 1, j))
            if j + 1 < self.k and (i == 0 or done[i - 1] > j + 1):
                heapq.heappush(heap, (left[i] + right[j + 1], i, j + 1))

    def visited(self, x: np.ndarray, reach: int) -> list[list[int]]:
        """The cells with entries that each query meets until it has met ``reach`` entries."""
        out = []
        for left, right in zip(*self.halves(x)):
            met, cells = 0, []
            for cell in self.walk(left, right):
                if self.sizes[cell]:
                    cells.append(cell)
                    met += int(self.sizes[cell])
                    if met >= reach:
                        break
            out.append(cells)
        return out


def cosines(queries: np.ndarray, entries: np.ndarray, ids: np.ndarray, top: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its ``top`` best entries (places) and their cosines, ties by id.

    A matrix product chooses, a sum in fixed order scores, so equal vectors get equal scores.
    """
    entries, queries = near_one(entries), near_one(queries)
    norms = np.sqrt((entries * entries).sum(axis=1))
    lengths = np.sqrt((queries * queries).sum(axis=1))
    scaled = unit(entries).T
    for at in range(0, len(queries), 256):
        rough = unit(queries[at : at + 256]) @ scaled
        n = min(top, rough.shape[1])
        edge = np.partition(rough, rough.shape[1] - n, axis=1)[:, rough.shape[1] - n] - 1e-11
        for i in range(len(rough)):
            near = np.flatnonzero(rough[i] >= edge[i])
            score = (entries[near] * queries[at + i]).sum(axis=1) / (norms[near] * lengths[at + i])
            order = np.lexsort((ids[near], -score))[:n]
            yield at + i, near[order], score[order]


def build(entries: DataFrame, rows: int, id: str = "vec_id") -> tuple[MultiIndex, DataFrame]:
    """The index, and the entries with their ``cell`` and ``block``, stored."""
    spark = entries.sparkSession
    share = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30)) < F.lit(min(1.0, FIT_ROWS / max(rows, 1)) * (1 << 30))
    sample = entries.where(share).orderBy("vec_id").collect()
    if not sample:
        sample = entries.limit(FIT_ROWS).collect()
    k = int(np.clip(round((rows / CELL_ROWS) ** 0.5), 1, MOST_CENTROIDS))
    index = MultiIndex(matrix([r["v"] for r in sample]), k)
    sent = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["cell"] = sent.value.cells(matrix(batch["v"])).astype(np.int32)
            yield batch

    celled = stored(entries.mapInPandas(assign, "vec_id long, v array<double>, cell int"), "cells")
    # At most MOST_CENTROIDS ** 2 rows.
    for r in celled.groupBy("cell").agg(F.count("*").alias("n")).collect():
        index.sizes[r["cell"]] = r["n"]
    return index, celled


def tuned_reach(index: MultiIndex, celled: DataFrame, rows: int, top: int) -> int:
    """Entries to meet so that ``AIM`` of the true neighbours of some rows are met."""
    spark = celled.sparkSession
    share = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 30)) < F.lit(min(1.0, TUNE_QUERIES / max(rows, 1)) * (1 << 30))
    asked = celled.where(share).orderBy("vec_id").select("vec_id", "v").collect()
    if not asked:
        return rows
    ids, x = np.array([r["vec_id"] for r in asked]), matrix([r["v"] for r in asked])
    sent = spark.sparkContext.broadcast((ids, x))

    def nearest_here(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, queries = sent.value
        for batch in batches:
            there, cells = batch["vec_id"].to_numpy(), batch["cell"].to_numpy()
            out = []
            for q, near, score in cosines(queries, matrix(batch["v"]), there, top + 1):
                keep = there[near] != own[q]
                out += zip([int(own[q])] * keep.sum(), there[near][keep], score[keep], cells[near][keep])
            yield pd.DataFrame(out, columns=["query", "vec_id", "score", "cell"])

    found = celled.mapInPandas(nearest_here, f"{FOUND}, cell int")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    truth = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).collect()
    wanted: dict[int, list[int]] = {}
    for r in truth:
        wanted.setdefault(r["query"], []).append(r["cell"])
    needed = []
    for own, left, right in zip(ids.tolist(), *index.halves(x)):
        cells, met = wanted.get(own, []), 0
        left_over = set(cells)
        for cell in index.walk(left, right):
            met += int(index.sizes[cell])
            if cell in left_over:
                needed += [met] * cells.count(cell)
                left_over.discard(cell)
                if not left_over:
                    break
    return int(np.quantile(needed, AIM, method="higher")) if needed else rows


def search(
    vectors: DataFrame, every: int = 50, top: int = 5, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Neighbours of all rows whose id is divisible by ``every``: ``query_id``, ``rank``, ``vec_id``, ``score``."""
    rows = stored(valid_vectors(vectors, id, vector), "vectors")
    same = Window.partitionBy("v").orderBy("vec_id")
    entries = stored(rows.withColumn("n", F.row_number().over(same)).where(F.col("n") <= top + 1).drop("n"), "entries")
    count = entries.count()
    asked = rows.where(F.col("vec_id") % every == 0)
    spark = vectors.sparkSession
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, celled = build(entries, count)
    reach = tuned_reach(index, celled, count, top)
    # One query stands for all with its vector.
    queries = stored(asked.groupBy("v").agg(F.min("vec_id").alias("query")), "queries")
    groups = max(1, -(-queries.count() // GROUP_QUERIES))
    sent = spark.sparkContext.broadcast(index)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                visits = own.visited(matrix(part["v"]), reach)
                out = [
                    (int(q), v, int(cell), block)
                    for q, v, cells in zip(part["query"], part["v"], visits)
                    for cell in cells
                    for block in range(-(-int(own.sizes[cell]) // BLOCK_ROWS))
                ]
                yield pd.DataFrame(out, columns=["query", "v", "cell", "block"])

    routed = queries.mapInPandas(route, "query long, v array<double>, cell int, block int")
    routed = routed.withColumn("team", F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int"))
    # Blocks of a cell by id; each meets every group of queries.
    counts = celled.groupBy("cell").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / F.lit(BLOCK_ROWS))
    dealt = (
        celled.join(counts, "cell")
        .withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(11)), blocks).cast("int"))
        .withColumn("team", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        .select("vec_id", "v", "cell", "block", "team")
    )

    def rerank(asking: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asking) and len(there):
            names, ids = asking["query"].to_numpy(), there["vec_id"].to_numpy()
            for q, near, score in cosines(matrix(asking["v"]), matrix(there["v"]), ids, top + 1):
                out += zip([int(names[q])] * len(near), ids[near], score)
        return pd.DataFrame(out, columns=["query", "vec_id", "score"])

    task = ["cell", "block", "team"]
    found = routed.groupBy(*task).cogroup(dealt.groupBy(*task)).applyInPandas(rerank, FOUND)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    short = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= top + 1)
    # Every query with that vector, without itself.
    members = asked.join(queries, "v").select(F.col("vec_id").alias("query_id"), "query")
    each = members.join(short, "query").where("vec_id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", place).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
