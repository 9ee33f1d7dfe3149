"""Sources of search queries, search dumps and seeds, and their merge rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkloom.constants import RESULTS_PER_QUERY, SEED_KEYS
from linkloom.functions.text import strip
from linkloom.operators.ordering import first_rows, with_line_numbers
from linkloom.sources.tables import file_label

RESULT = "struct<snippet:string,title:string,link:string,engines:array<string>,category:string,query:string>"
DUMP = f"map<string,array<{RESULT}>>"
SEED = (
    "lid_label string, link string, lid_confidence double, predicted_lid string, "
    "snippet string, title string, engines array<string>, category string"
)


def split_query_lines(lines: DataFrame, start: int, end: int | None = None) -> DataFrame:
    """(line_no, value) lines ``start`` to ``end - 1`` as (line_no, iso_code, query).

    Without an ``end`` all lines from ``start`` on. Lines that are not two tab-separated
    fields are left out; ``rejected_query_lines`` gives them.
    """
    fields = F.split(strip("value"), "\t")
    return (
        _sliced(lines, start, end)
        .filter(F.size(fields) == 2)
        .select("line_no", F.get(fields, F.lit(0)).alias("iso_code"), F.get(fields, F.lit(1)).alias("query"))
    )


def _sliced(lines: DataFrame, start: int, end: int | None) -> DataFrame:
    wanted = F.col("line_no") >= start
    return lines.filter(wanted if end is None else wanted & (F.col("line_no") < end))


def rejected_query_lines(lines: DataFrame, start: int, end: int | None = None) -> DataFrame:
    """(line_no, value) of the lines in the slice that are not two fields."""
    return _sliced(lines, start, end).filter(F.size(F.split(strip("value"), "\t")) != 2)


def read_seed_queries(spark: SparkSession, path: str, start: int, end: int | None = None) -> DataFrame:
    return split_query_lines(with_line_numbers(spark.read.text(path)), start, end)


def explode_dump(dumps: DataFrame, value: str = "value") -> DataFrame:
    """Search dumps (one JSON object keyed by iso code per row) as one row per result.

    Row order inside a key is kept in ``pos``.
    """
    parsed = dumps.select(F.from_json(value, DUMP).alias("m"))
    keyed = parsed.select(F.explode("m").alias("iso_code", "results"))
    return keyed.select("iso_code", F.posexplode("results").alias("pos", "r")).select("iso_code", "pos", "r.*")


def read_search_dump(spark: SparkSession, path: str, json_lines: bool = False) -> DataFrame:
    """Dump files: one JSON object per file, or per line for dumps too large for one task."""
    return explode_dump(spark.read.text(path, wholetext=not json_lines))


def merge_last(results: DataFrame) -> DataFrame:
    """A repeated iso code keeps the results of its last query only."""
    last = results.groupBy("iso_code").agg(F.max("line_no").alias("line_no"))
    return results.join(last, ["iso_code", "line_no"], "left_semi").select(*results.columns)


def merge_append(batches: Sequence[DataFrame], queries: DataFrame) -> DataFrame:
    """All results of a repeated iso code are kept, each stamped with its query."""
    merged = batches[0]
    for batch in batches[1:]:
        merged = merged.unionByName(batch)
    stamped = merged.drop("query").join(queries.select("line_no", "query"), "line_no")
    return stamped


def top_results(results: DataFrame, n: int = RESULTS_PER_QUERY) -> DataFrame:
    """The first ``n`` results of each query."""
    return first_rows(results, ["iso_code", "line_no"], [F.col("pos")], n)


def seed_validation(entries: DataFrame, required: Sequence[str] = SEED_KEYS, label: str = "lid_label") -> DataFrame:
    """(label, n_entries, n_bad): a bad entry lacks at least one required key."""
    missing = F.lit(False)
    for key in required:
        missing = missing | (F.col(key).isNull() if key in entries.columns else F.lit(True))
    return entries.groupBy(F.col(label).alias(label)).agg(
        F.count(F.lit(1)).alias("n_entries"), F.count_if(missing).alias("n_bad")
    )


def valid_seeds(entries: DataFrame, required: Sequence[str] = SEED_KEYS, label: str = "lid_label") -> DataFrame:
    """Entries of the labels without any bad entry: one bad entry rejects its whole label."""
    good = seed_validation(entries, required, label).filter(F.col("n_bad") == 0).select(label)
    return entries.join(good, label, "left_semi").select(*entries.columns)


def read_seed_files(spark: SparkSession, path: str, required: Sequence[str] = SEED_KEYS, schema: str | None = None) -> DataFrame:
    """Seed files, one JSON array per label; the label is the file's name, or its folder's (``lid_label=...``).

    A missing folder or a broken file gives no rows.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], schema or SEED)
    fields = schema or SEED
    body = ", ".join(f for f in _fields(fields) if not f.startswith("lid_label "))
    keep_label = "lid_label" in required
    item = f"struct<{_as_struct(fields if keep_label else body)}>"
    raw = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select("value", file_label(".json").alias("file_label"))
    entries = raw.select("file_label", F.inline(F.from_json("value", f"array<{item}>")))
    checked = valid_seeds(entries, required, "file_label")
    if keep_label:
        return checked.drop("file_label")
    return checked.withColumnRenamed("file_label", "lid_label")


def _fields(ddl: str) -> list[str]:
    return [part.strip() for part in ddl.split(",")]


def _as_struct(ddl: str) -> str:
    return ",".join(":".join(field.split(" ", 1)) for field in _fields(ddl))


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = file_system.globStatus(hadoop_path)
    return found is not None and len(found) > 0
