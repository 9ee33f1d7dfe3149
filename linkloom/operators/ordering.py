"""Running totals and positions inside groups of any size.

A plain window over a group sorts the whole group in one task. Here the rows are cut
into ranges of (keys, order), which Spark sizes from a sample, so that sparse and hashed
order values do no harm. Each range of a group is summed, the few range totals of a group
are run up, and each range is finished on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from linkloom.session import stored

_RANGE, _OFFSET = "__range", "__offset"


def running_total(df: DataFrame, keys: list[str], order: str, value: Column, name: str) -> DataFrame:
    """Add ``name``: sum of ``value`` over the group's rows up to and with this one.

    The rows are stored once, in ranges, as a sample gives other ranges on every
    look; give it the columns that matter and join the rest.
    """
    ranged = df.withColumn(name, value).repartitionByRange(*keys, order).withColumn(_RANGE, F.spark_partition_id())
    valued = stored(ranged, "ranges")
    # A group has one row for each range at most.
    totals = valued.groupBy(*keys, _RANGE).agg(F.sum(name).alias("__total"))
    before = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    group = [F.col(k).alias(f"__{k}") for k in keys]
    offsets = totals.select(
        *group, F.col(_RANGE).alias("__at"), F.coalesce(F.sum("__total").over(before), F.lit(0)).alias(_OFFSET)
    )
    same = F.col(_RANGE) == F.col("__at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    inside = Window.partitionBy(*keys, _RANGE).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        valued.join(offsets, same)
        .withColumn(name, F.sum(name).over(inside) + F.col(_OFFSET))
        .select(*df.columns, name)
    )


def position(df: DataFrame, keys: list[str], order: str, name: str = "pos") -> DataFrame:
    """Add ``name``: 1-based place of the row in its group by ``order``."""
    return running_total(df, keys, order, F.lit(1).cast("bigint"), name)


def with_line_numbers(lines: DataFrame, name: str = "line_no") -> DataFrame:
    """Add the 0-based number of each line of text files, read one after the other in the order of their names.

    ``lines`` comes straight from a file source, in any number of splits: a row is counted from the start of its split, and
    splits are ordered by file and place in it, whatever the tasks that read them.
    """
    split = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    marked = lines.select("*", split.alias("__split"), F.monotonically_increasing_id().alias("__mark"))
    sizes = marked.groupBy("__split").agg(F.count(F.lit(1)).alias("__n"), F.min("__mark").alias("__first"))
    # One row per split: a window without key is bounded by their number.
    before = Window.orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__split", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return (
        marked.join(starts, "__split")
        .withColumn(name, F.col("__start") + F.col("__mark") - F.col("__first"))
        .drop("__mark", "__first", "__split", "__start")
    )


def first_rows(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group.

    A bound on ``row_number`` makes Spark keep ``n`` rows of a group per task
    before the shuffle (``WindowGroupLimit``), so a hot group does not travel whole.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).filter(F.col("__place") <= n).drop("__place")
