"""Per-label JSON, text and CSV sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ROWS_PER_FILE = 1_000_000


def _writer(df: DataFrame, mode: str, label: str, ordered: bool = False):
    # Rows of a label meet in few tasks, and large labels are split, so that files are few and even.
    df = df if ordered else df.hint("rebalance", label)
    # Overwriting replaces the labels at hand and leaves the other labels' files alone.
    return (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(label)
    )


def append_by_label(df: DataFrame, path: str, label: str = "predicted_lid", fmt: str = "json") -> None:
    """Append rows to their label's folder; a null label has a folder of its own."""
    _writer(df, "append", label).format(fmt).save(path)


def overwrite_by_label(df: DataFrame, path: str, label: str = "lid_label", fmt: str = "json") -> None:
    """Replace the folders of the labels in ``df``, one JSON object per line."""
    _writer(df, "overwrite", label).format(fmt).save(path)


def write_metadata(metadata: DataFrame, path: str) -> None:
    """Crawl metadata (lid_label, kind, url), one folder per label."""
    overwrite_by_label(metadata.select("lid_label", "kind", "url"), path)


def write_text_by_label(df: DataFrame, path: str, label: str = "lid_label", line: str = "text") -> None:
    _writer(df.select(label, line), "overwrite", label).text(path)


def write_sorted_text(df: DataFrame, path: str, order: list[str], label: str = "lid_label", line: str = "line") -> None:
    """Text lines per label in order: files of a label follow one another by name.

    Range partitioning splits a long label over several tasks.
    """
    ordered = df.repartitionByRange(label, *order, line).sortWithinPartitions(label, *order, line)
    _writer(ordered.select(label, line), "overwrite", label, ordered=True).text(path)


def write_report(report: DataFrame, path: str, one_file: bool = True) -> None:
    """CSV with a header: one file for a report of one row per label, or as many as there are tasks."""
    report = report.coalesce(1) if one_file else report
    report.write.mode("overwrite").option("header", True).csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).option("sep", sep).option("escape", '"').csv(path)


def write_catalogue(languages: DataFrame, site_links: DataFrame, path: str) -> None:
    """The catalogue as two tables: language entries, and site links in list order."""
    overwrite_by_label(languages, f"{path}/languages")
    keys = ["lid_label", "site_url", "ord", "link"]
    ordered = site_links.repartitionByRange(*keys).sortWithinPartitions(*keys)
    _writer(ordered, "overwrite", "lid_label", ordered=True).format("json").save(f"{path}/site_links")
