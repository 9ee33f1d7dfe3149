"""Sources of lookup tables, blocklists, pages and glossed corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linkloom.operators.ordering import with_line_numbers
from linkloom.session import spread


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages (url, html); a URL without a row is a failed fetch."""
    return spread(spark.read.parquet(path).select("url", "html"))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Labelled texts (lid_label, doc_id, text)."""
    return spread(spark.read.parquet(path).select("lid_label", "doc_id", "text"))


def file_label(ending: str) -> Column:
    """Label of the file a row was read from: its folder's (``lid_label=...``), or its own name."""
    name = F.input_file_name()
    folder = F.url_decode(F.regexp_extract(name, "/lid_label=([^/]*)/", 1))
    own = F.regexp_extract(name, rf"([^/]+?)(?:\{ending})?$", 1)
    return F.when(folder == "__HIVE_DEFAULT_PARTITION__", None).when(folder != "", folder).otherwise(own)


def read_label_files(spark: SparkSession, path: str) -> DataFrame:
    """Corpus of text files per label as (lid_label, doc_id, text).

    The label is the file's name, or its folder's (``lid_label=...``). Each line is a
    document, so that a long file is read in many splits.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).withColumn("lid_label", file_label(".txt"))
    return lines.select("lid_label", F.monotonically_increasing_id().alias("doc_id"), F.col("value").alias("text"))


def read_blocklist(spark: SparkSession, path: str) -> DataFrame:
    """(entry) of a blocklist file. Blank lines go, as the empty string is part of every link."""
    return spark.read.text(path).select(F.trim("value").alias("entry")).filter(F.length("entry") > 0).distinct()


def read_label_list(spark: SparkSession, path: str) -> DataFrame:
    """(code) of a JSON array of labels."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", "array<string>")).alias("code"))


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """Delimited file with a header; quoted cells may hold line ends."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def read_ordered(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """Selected columns of delimited files by name, with ``ord``, the row's place in them, one file after the other."""
    rows = spark.read.option("header", True).option("sep", sep).option("escape", '"').csv(path)
    return with_line_numbers(rows, "ord").select(*[F.col(f"`{c}`") for c in columns], "ord")


def read_identifier_map(spark: SparkSession, path: str) -> DataFrame:
    """(id, identifiers) of a resource map with a ``resources`` array."""
    entry = "struct<id:string,identifiers:array<struct<identifier:string,type:string>>>"
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.inline(F.from_json("value", f"struct<resources:array<{entry}>>")["resources"]))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Crawl metadata (lid_label, kind, url) as written by ``write_metadata``."""
    return spark.read.schema("kind string, url string, lid_label string").json(path).select("lid_label", "kind", "url")
