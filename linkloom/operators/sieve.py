"""Dropping rows whose key is surely not among those asked for, without moving them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Words of the filter, a power of two: the table sent to all tasks has at most so many rows of two numbers, whatever is asked for.
WORD_BITS = 20


def _word(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - WORD_BITS)


def _mask(key: Column) -> Column:
    """Four of the 64 bits of a key's word."""
    hashed = F.xxhash64(key)
    bits = [F.shiftright(hashed, 6 * i).bitwiseAND(63).cast("int") for i in range(4)]
    # F.shiftleft takes plain numbers only.
    one = [F.call_function("shiftleft", F.lit(1).cast("long"), bit) for bit in bits]
    return one[0].bitwiseOR(one[1]).bitwiseOR(one[2]).bitwiseOR(one[3])


def sift(rows: DataFrame, key: Column | str, asked: DataFrame) -> DataFrame:
    """Rows whose ``key`` may be in the single column of ``asked``: all that are, and a few that are not.

    A Bloom filter in blocks: one word of 64 bits for each key, four bits of it set, combined before they are
    shuffled. Words without a key are not kept, so a short list makes a small table. Up to about four
    million keys one row in a hundred passes by mistake; beyond that more do, which costs work but no result: an exact
    join on what is left has to follow. Null keys are dropped.
    """
    key = F.col(key) if isinstance(key, str) else key
    wanted = asked.toDF("__key").where("__key IS NOT NULL")
    words = wanted.select(_word(F.col("__key")).alias("__word"), _mask(F.col("__key")).alias("__mask"))
    table = words.groupBy("__word").agg(F.bit_or("__mask").alias("__bits"))
    marked = rows.where(key.isNotNull()).withColumn("__word", _word(key))
    held = marked.join(F.broadcast(table), "__word")
    return held.where(F.col("__bits").bitwiseAND(_mask(key)) == _mask(key)).select(*rows.columns)
