"""Incremental form of the search-result language filter."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from linkloom.constants import BLOCKLIST
from linkloom.operators.filters import blocklist_filter, exclude_labels
from linkloom.operators.lid import Predictor, language_filter, tag_language

RESULT_SCHEMA = "iso_code string, pos int, snippet string, title string, link string, category string"


def read_results(spark: SparkSession, path: str, schema: str = RESULT_SCHEMA) -> DataFrame:
    """Search results arriving as JSON-lines files."""
    return spark.readStream.schema(schema).json(path)


def tagged_results(
    results: DataFrame,
    predictor: Predictor,
    excluded: list[str] | DataFrame,
    blocklist: list[str] | DataFrame = list(BLOCKLIST),
    pages: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Blocklist, language of page or snippet, exclusion, for the results of one batch.

    Snippets are judged with their line feeds, as in ``snippet_language_filter``. With
    ``pages`` only the pages that the batch names are parsed.
    """
    kept = blocklist_filter(results, blocklist)
    if pages is None:
        tagged = tag_language(kept, predictor, text="snippet", keep_newlines=True, **options)
        return exclude_labels(tagged, excluded)
    return language_filter(kept, pages, predictor, excluded, **options)


def ingest(results: DataFrame, tag: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, fmt: str = "json") -> StreamingQuery:
    """File new results by predicted label; stops when all files at hand are read.

    ``tag`` works on one batch at a time and may join and aggregate, so any
    predictor will do. A batch has a folder of its own, ``batch=<number>``, which a
    repeated batch replaces: each record is filed once.
    """

    def file_batch(batch: DataFrame, number: int) -> None:
        tagged = tag(batch).hint("rebalance", "predicted_lid")
        tagged.write.mode("overwrite").partitionBy("predicted_lid").format(fmt).save(f"{path}/batch={number}")

    return (
        results.writeStream.outputMode("append")
        .foreachBatch(file_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
