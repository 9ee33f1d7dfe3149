"""Counts of character n-grams over whole corpora, of any characters and n."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from linkloom.functions.local import text_slices

# Bytes of text read, and places whose runs are counted at a time.
CHUNK = 1 << 20


def count_runs(df: DataFrame, key: str, text: Column, n: int, places: Column) -> DataFrame:
    """(key, gram, cnt): runs of ``n`` characters, one from each of the first ``places`` characters of a text.

    A run stops at the end of its text. Tasks count slices of their texts as they come, and Spark adds up the counts, so
    it is the distinct runs of a slice that are moved and not the runs. Null texts have none.
    """
    read = df.select(F.col(key), text.alias("text"), places.cast("bigint").alias("places")).filter("text IS NOT NULL AND places > 0")
    kind = read.schema[key].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, first = batch.column(0), 0
            for texts in text_slices(batch.column(1), CHUNK):
                held = slice(first, first + len(texts))
                own = keys[held].dictionary_encode(null_encoding="encode")
                starts = batch.column(2)[held].to_numpy(zero_copy_only=False)
                for codes, grams, counts in _slice_runs(texts, own.indices.to_numpy(zero_copy_only=False), starts, n):
                    columns = [own.dictionary.take(pa.array(codes)), grams, pa.array(counts)]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "gram", "c"])
                first += len(texts)

    parts = read.mapInArrow(counted, f"key {kind}, gram string, c bigint")
    return parts.groupBy(F.col("key").alias(key), "gram").agg(F.sum("c").alias("cnt"))


def _slice_runs(texts: list[str], owners: np.ndarray, places: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """(owner, run, count) of the distinct runs of ``texts``, ``CHUNK`` places at a time."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    last = np.repeat(ends, sizes)
    owner = np.repeat(owners.astype(np.int64), sizes)
    inside = np.arange(len(points)) < np.repeat(ends - sizes + np.minimum(places, sizes), sizes)
    for at in range(0, len(points), CHUNK):
        block = slice(at, min(at + CHUNK, len(points)))
        count = block.stop - at
        seen = points[at : block.stop + n - 1]
        # A character's place in the alphabet of these runs, from one; zero stands after the end of a text.
        known = np.zeros(int(seen.max()) + 1, dtype=bool)
        known[seen] = True
        code = np.cumsum(known)[seen]
        code = np.concatenate([code, np.zeros(count + n - 1 - len(code), dtype=np.int64)])
        room = last[block] - np.arange(at, block.stop)
        runs, used, bits = owner[block], int(owner[block].max()).bit_length(), int(known.sum()).bit_length()
        for i in range(n):
            if used + bits > 63:
                runs, used = _renumbered(runs)
            runs = (runs << bits) | (code[i : i + count] * (room > i))
            used += bits
        # Sorted with their places, so that each run is read back from one of them.
        if used + count.bit_length() > 63:
            runs, used = _renumbered(runs)
        marked = np.sort(((runs << count.bit_length()) | np.arange(count))[inside[block]])
        if not len(marked):
            continue
        first = np.flatnonzero(np.diff(marked >> count.bit_length(), prepend=-1))
        spots = marked[first] & ((1 << count.bit_length()) - 1)
        counts = np.diff(first, append=len(marked))
        yield owner[at + spots], _strings(points, at + spots, np.minimum(room[spots], n)), counts


def _renumbered(runs: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers for runs that are too long for one, and their bits."""
    return np.unique(runs, return_inverse=True)[1], len(runs).bit_length()


def _strings(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The runs of ``sizes`` characters at ``starts``."""
    ends = np.cumsum(sizes)
    taken = points[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]))]
    width = 1 + (taken > 0x7F).astype(np.int32) + (taken > 0x7FF) + (taken > 0xFFFF)
    offsets = np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], ends])].astype(np.int32)
    data = taken.tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
