"""Seed sampling from a glossed corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from linkloom.operators.ordering import first_rows
from linkloom.session import stored


def median_lengths(df: DataFrame, key: str = "iso_code", length: str = "str_length") -> DataFrame:
    """Exact median per group from counts of distinct lengths.

    Lengths repeat, so the counts of a group are small however many rows it has.
    """
    counts = df.groupBy(key, length).agg(F.count(F.lit(1)).alias("n"))
    up_to = Window.partitionBy(key).orderBy(length).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("upto", F.sum("n").over(up_to)).withColumn(
        "total", F.sum("n").over(Window.partitionBy(key))
    )
    # The median averages the middle row of an odd group, the two middle rows of an even one.
    low, high = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
    return ranked.groupBy(key).agg(
        ((F.min(F.when(F.col("upto") >= low, F.col(length))) + F.min(F.when(F.col("upto") >= high, F.col(length)))) / 2)
        .alias("median_length")
    )


def median_sample(df: DataFrame, key: str = "iso_code", text: str = "transcription", order: str = "ord", n: int = 2) -> DataFrame:
    """The ``n`` rows of each group closest to its median text length, earlier rows first.

    A missing text counts with length 3: the source of these tables writes ``nan`` for it.
    """
    shown = F.coalesce(F.col(text), F.lit("nan"))
    sized = df.filter(F.col(key).isNotNull()).withColumn(text, shown).withColumn("str_length", F.length(shown))
    # One row per group, stored: its size is known, so it goes to the texts and no group's texts go to one task.
    medians = stored(median_lengths(sized.select(key, "str_length"), key), "medians")
    near = sized.join(medians, key).withColumn(
        "diff_from_median", F.abs(F.col("str_length") - F.col("median_length"))
    )
    return first_rows(near, [key], [F.col("diff_from_median"), F.col(order)], n)
