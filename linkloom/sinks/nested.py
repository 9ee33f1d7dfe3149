"""The catalogue as one nested JSON document for each label: language fields, then sites, then each site's links.

A document is written as lines by many tasks: a head, for each site a head, one line a link and a foot, and a foot. Lines are
numbered inside their site and sites inside their label by running totals, so every line knows whether a comma goes
before it, and range-sorted tasks write them wherever they fall. A label's files, one after the other by name, are its
document; no site and no label is gathered in a value or a task.

A null or empty label has the folder of null. A label with sites and no language row has a document of sites only, one without
sites an empty list; of several language rows of a label the least is taken. Sites are in the order of their smallest ``ord``
(those without last), then address; links in the order of ``(ord, link)``. Null links stay, as ``null``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linkloom.constants import SITE_CONFIDENCE, SITE_INFO
from linkloom.operators.ordering import position, running_total, with_line_numbers
from linkloom.session import stored
from linkloom.sinks.files import ROWS_PER_FILE

# Keys of the published documents.
LANGUAGE_KEYS = {
    "language_name": "Language Name",
    "speakers": "Number of Speakers",
    "family": "Family",
    "subgrouping": "Subgrouping",
}
SITE_KEYS = {"site_name": "Site Name", "site_url": "Site URL", "info": "Info", "confidence": "confidence"}
SITES, LINKS = "Sites", "Links"

_NULL_LABEL = "__HIVE_DEFAULT_PARTITION__"
_LAST = (1 << 63) - 1
_SITE = ["lid_label", "site_name", "site_url"]


def _folder(label: str = "lid_label") -> Column:
    # Never null, so that the writer keeps the order of rows and does not sort them again.
    return F.coalesce(F.nullif(F.col(label), F.lit("")), F.lit(_NULL_LABEL))


def _opened(fields: Column, many: Column, key: str) -> Column:
    """A JSON object of ``fields`` up to the opened list under ``key``."""
    body = F.to_json(fields, {"ignoreNullFields": "false"})
    cut = F.substring(body, F.lit(1), F.length(body) - 1)
    return F.concat(cut, F.when(many, F.lit(",")).otherwise(""), F.lit(f'"{key}":['))


def _scalar(value: str) -> Column:
    """A string as a JSON value."""
    one = F.to_json(F.array(value))
    return F.substring(one, F.lit(2), F.length(one) - 2)


def nested_lines(
    languages: DataFrame, site_links: DataFrame, info: str = SITE_INFO, confidence: str = SITE_CONFIDENCE
) -> DataFrame:
    """(lid_label, site_no, link_no, line): the documents, line by line in the order of the numbers."""
    links = site_links.select(_folder().alias("lid_label"), "site_name", "site_url", "ord", "link")
    linked = position(
        links.select(*_SITE, "link", F.struct(F.col("ord").isNull(), F.col("ord"), F.col("link")).alias("at")), _SITE, "at", "link_no"
    )
    first = links.groupBy(*_SITE).agg(F.min("ord").alias("first"))
    placed = F.struct(F.col("first").isNull(), F.col("first"), F.col("site_url"), F.col("site_name"))
    # Links look their site up and every site makes two lines.
    sites = stored(position(first.withColumn("at", placed), ["lid_label"], "at", "site_no").drop("at", "first"), "sites")
    of = sites.select(*[F.col(c).alias(f"of_{c}") for c in _SITE], "site_no")
    same = F.lit(True)
    for c in _SITE:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    comma = lambda number: F.when(F.col(number) > 1, F.lit(",")).otherwise("")
    link_lines = linked.join(of, same).select("lid_label", "site_no", "link_no", F.concat(comma("link_no"), _scalar("link")).alias("line"))
    fields = F.struct(
        F.col("site_name").alias(SITE_KEYS["site_name"]),
        F.col("site_url").alias(SITE_KEYS["site_url"]),
        F.lit(info).alias(SITE_KEYS["info"]),
        F.lit(confidence).alias(SITE_KEYS["confidence"]),
    )
    site_head = F.concat(comma("site_no"), _opened(fields, F.lit(True), LINKS))
    site_lines = sites.select(
        "lid_label",
        "site_no",
        F.inline(F.array(
            F.struct(F.lit(0).cast("bigint").alias("link_no"), site_head.alias("line")),
            F.struct(F.lit(_LAST).alias("link_no"), F.lit("]}").alias("line")),
        )),
    )
    shown = [F.col(c).alias(LANGUAGE_KEYS.get(c, c)) for c in languages.columns if c != "lid_label"]
    no_fields = F.lit(f'{{"{SITES}":[')
    described = languages.select(
        _folder().alias("lid_label"),
        (_opened(F.struct(*shown), F.lit(True), SITES) if shown else no_fields).alias("head"),
    )
    # Labels of sites without a language row have no head of their own.
    bare = sites.select("lid_label", F.lit(None).cast("string").alias("head"))
    heads = described.unionByName(bare).groupBy("lid_label").agg(F.coalesce(F.min("head"), no_fields).alias("head"))
    label_lines = heads.select(
        "lid_label",
        F.inline(F.array(
            F.struct(F.lit(0).cast("bigint").alias("site_no"), F.col("head").alias("line")),
            F.struct(F.lit(_LAST).alias("site_no"), F.lit("]}").alias("line")),
        )),
    ).select("lid_label", "site_no", F.lit(0).cast("bigint").alias("link_no"), "line")
    return link_lines.unionByName(site_lines).unionByName(label_lines)


def write_nested(
    languages: DataFrame, site_links: DataFrame, path: str, info: str = SITE_INFO, confidence: str = SITE_CONFIDENCE
) -> None:
    """Replace the documents of the labels at hand; other labels' documents are left alone."""
    keys = ["lid_label", "site_no", "link_no"]
    # The ranges are drawn from a sample, so the lines are made once.
    lines = stored(nested_lines(languages, site_links, info, confidence), "lines")
    ordered = lines.repartitionByRange(*keys).sortWithinPartitions(*keys).select("lid_label", "line")
    (
        ordered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("lid_label")
        .text(path)
    )


def read_nested(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """What ``write_nested`` wrote: (lid_label, fields) of the languages, as JSON, and one row a link with its site.

    The second is (lid_label, site_no, site_name, site_url, info, confidence, link_no, link), numbers from 1. Lines are read in many splits; a running
    count of site heads gives each line its site.
    """
    lines = spark.read.schema("line string, lid_label string").option("pathGlobFilter", "part-*").text(path)
    # Lines are numbered through all files, labels one after the other.
    numbered = with_line_numbers(lines)
    bare = F.regexp_replace("line", "^,", "")
    opens = F.startswith(bare, F.lit("{"))
    kind = F.when(opens & F.endswith(bare, F.lit(f'"{LINKS}":[')), "site").when(opens, "label").when(bare != "]}", "link")
    told = numbered.select("lid_label", "line_no", bare.alias("body"), kind.alias("kind")).filter("kind is not null")
    counted = stored(running_total(told, ["lid_label"], "line_no", (F.col("kind") == "site").cast("bigint"), "site_no"), "told")
    closed = F.concat("body", F.lit("]}"))
    languages = counted.filter("kind = 'label'").select("lid_label", closed.alias("fields"))
    schema = ",".join(f"`{key}`:string" for key in SITE_KEYS.values())
    site = F.from_json(closed, f"struct<{schema}>")
    heads = counted.filter("kind = 'site'").select(
        F.col("lid_label").alias("of_label"), F.col("site_no").alias("of_site"), F.col("line_no").alias("from_line"),
        site.alias("site"),
    ).select("of_label", "of_site", "from_line", *[F.col("site").getField(key).alias(name) for name, key in SITE_KEYS.items()])
    link = F.get(F.from_json(F.concat(F.lit("["), "body", F.lit("]")), "array<string>"), F.lit(0))
    links = (
        counted.filter("kind = 'link'")
        .join(heads, F.col("lid_label").eqNullSafe(F.col("of_label")) & (F.col("site_no") == F.col("of_site")))
        .select("lid_label", "site_no", *SITE_KEYS, (F.col("line_no") - F.col("from_line")).alias("link_no"), link.alias("link"))
    )
    return languages, links
