"""Merge of search results as they arrive, by the rules of ``sources.seeds``.

A result is known by (iso_code, line_no, pos); one that comes again, in a repeated file or a
batch run again, is the same result. Rows without an iso code or a line number are of no query and
are left out; results without a place share one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from linkloom.sources.seeds import merge_last

# State keys of one iso code, so that no code is one task's work.
PARTS = 16
# In the place of a missing place; places count from zero.
NO_PLACE = -1


def _newest(key, frames, state):
    """Rows of the newest line so far of a share of an iso code. The line's number is all the state; frames stream through."""
    newest = state.get[0] if state.exists else None
    for frame in frames:
        top = int(frame["line_no"].max())
        newest = top if newest is None else max(newest, top)
        state.update((newest,))
        yield frame.loc[frame["line_no"] == newest, ["row"]]


def _known(results: DataFrame) -> DataFrame:
    return results.filter(F.col("iso_code").isNotNull() & F.col("line_no").isNotNull())


def each_once(results: DataFrame) -> DataFrame:
    """Rows of a stream that were not there before; the engine's own keyed state, one entry a result."""
    placed = _known(results).withColumn("__place", F.coalesce(F.col("pos").cast("long"), F.lit(NO_PLACE)))
    return placed.dropDuplicates(["iso_code", "line_no", "__place"]).drop("__place")


def newest_lines(results: DataFrame, parts: int = PARTS) -> DataFrame:
    """Rows of a stream that replace what their iso code has, or belong to its newest line; late lines are dropped.

    A code's rows are dealt to ``parts`` keys. A key knows the newest of its own lines only, so some rows
    that are replaced get through; ``merged`` leaves them out. Rows travel as JSON, so that no type is widened for nulls.
    """
    once = each_once(results)
    marked = once.select(
        "iso_code", F.pmod(F.xxhash64("line_no", "pos"), F.lit(parts)).alias("part"), F.col("line_no").cast("long").alias("line_no"),
        F.to_json(F.struct(*once.columns)).alias("row"),
    )
    kept = marked.groupBy("iso_code", "part").applyInPandasWithState(
        _newest, "row string", "line_no long", "append", GroupStateTimeout.NoTimeout
    )
    return kept.select(F.from_json("row", once.schema).alias("r")).select("r.*")


def merge(results: DataFrame, rule: str, path: str, checkpoint: str) -> StreamingQuery:
    """Merge new results into the log at ``path``; stops when all at hand are read, goes on where it stopped.

    ``rule`` is ``last`` (a repeated code replaces its results) or ``append``. A batch has a folder of its own,
    which the batch run again replaces.
    """
    changes = {"last": newest_lines, "append": each_once}[rule](results)

    def file_batch(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        changes.writeStream.outputMode("append")
        .foreachBatch(file_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merged(spark: SparkSession, path: str, schema: str, rule: str) -> DataFrame:
    """The results as merged so far: equal to the batch form over all that has come."""
    # Folders are read as they are: a column of the results may be named as they are.
    log = spark.read.option("recursiveFileLookup", True).schema(schema).parquet(path)
    return merge_last(log) if rule == "last" else log
