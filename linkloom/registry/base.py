"""Registration and the inputs that queries derive from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linkloom.functions import urls
from linkloom.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Labels of the corpus languages.
LABELS = {"en": "eng_Latn", "fr": "fra_Latn", "de": "deu_Latn", "es": "spa_Latn"}


def query(name: str, sql: str | None = None):
    """Register a function under ``name``; ``sql`` is its twin for the check."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"))


def label_of(lang: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    return F.try_element_at(known, lang)


def sql_label(lang: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items())
    return f"CASE {lang} {arms} END"


# A number far from its neighbours, and never that of another below the modulus.
def scattered(number):
    return number * 1_000_003 % 2_147_483_647


def sql_values(name: str, columns: str, rows: list[tuple]) -> str:
    def cell(value) -> str:
        if value is None:
            return "NULL"
        return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)

    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


# URL pieces in SQL.
def sql_scheme(u: str) -> str:
    return f"lower(regexp_extract({u}, '{urls.SCHEME_RE}', 1))"


def sql_netloc(u: str) -> str:
    return f"regexp_extract({u}, '{urls.NETLOC_RE}', 1)"


def sql_path(u: str) -> str:
    return f"regexp_replace(regexp_extract({u}, '{urls.PATH_RE}', 1), ';[^/]*$', '')"


def sql_query(u: str) -> str:
    return f"regexp_extract({u}, '{urls.QUERY_RE}', 1)"


def sql_fragment(u: str) -> str:
    return f"regexp_extract({u}, '{urls.FRAGMENT_RE}', 1)"


def sql_site(u: str) -> str:
    return f"{sql_scheme(u)} || '://' || {sql_netloc(u)}"


def sql_strip(u: str) -> str:
    return f"regexp_replace(regexp_replace({u}, '#.*$', ''), '\\?$', '')"


def sql_norm(u: str) -> str:
    return f"replace({sql_netloc(u)}, 'www.', '') || regexp_replace({sql_path(u)}, '/+$', '')"


def sql_name(host: str) -> str:
    from linkloom.constants import IGNORED_HOST_PARTS

    ignored = ", ".join(f"'{p}'" for p in IGNORED_HOST_PARTS)
    kept = f"list_filter(string_split({host}, '.'), lambda x: lower(x) NOT IN ({ignored}))"
    return (
        f"CASE WHEN len({kept}) = 0 THEN string_split({host}, '.')[1] "
        f"WHEN len({kept}) > 1 AND length({kept}[1]) <= 3 THEN {kept}[2] ELSE {kept}[1] END"
    )


# Links: every page URL in four spellings, so that site variants and fragment twins occur.
def link_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    url = F.col("url")
    swapped = F.when(url.startswith("https://"), F.concat(F.lit("http://"), F.substr(url, F.lit(9)))).otherwise(
        F.concat(F.lit("https://"), F.substr(url, F.lit(8)))
    )
    toggled = F.when(F.contains(url, F.lit("//www.")), F.replace(url, F.lit("//www."), F.lit("//"))).otherwise(
        F.replace(url, F.lit("//"), F.lit("//www."))
    )
    twin = F.concat(F.regexp_replace(url, "#.*$", ""), F.lit("#a"))
    return pages.select(
        label_of(F.regexp_extract("url", "//[^/]+/([a-z]{2})/", 1)).alias("lid_label"),
        "page_id",
        F.posexplode(F.array(url, twin, swapped, toggled)).alias("v", "link"),
    ).select("lid_label", (F.col("page_id") * 4 + F.col("v")).alias("ord"), "link")


SQL_LINKS = f"""links AS (
  SELECT {sql_label("regexp_extract(url, '//[^/]+/([a-z]{2})/', 1)")} AS lid_label, page_id * 4 + v AS ord,
    CASE v WHEN 0 THEN url
      WHEN 1 THEN regexp_replace(url, '#.*$', '') || '#a'
      WHEN 2 THEN CASE WHEN url LIKE 'https://%' THEN 'http://' || substr(url, 9) ELSE 'https://' || substr(url, 8) END
      ELSE CASE WHEN contains(url, '//www.') THEN replace(url, '//www.', '//') ELSE replace(url, '//', '//www.') END
    END AS link
  FROM pages CROSS JOIN (VALUES (0), (1), (2), (3)) t(v))"""


# Seeds: page URLs with the language of the document of the same number and a confidence from its quality.
def seed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"), "lang")
    marks = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), "quality")
    sure = F.when(F.col("quality") == 1, 0.9).when(F.col("quality") == 0, 0.7)
    return (
        pages.join(docs, "page_id", "left")
        .join(marks, "page_id", "left")
        .select(
            label_of(F.regexp_extract("url", "//[^/]+/([a-z]{2})/", 1)).alias("lid_label"),
            F.col("page_id").alias("ord"),
            F.col("url").alias("link"),
            F.when(F.col("lang") != "es", label_of(F.col("lang"))).alias("predicted_lid"),
            sure.alias("lid_confidence"),
        )
    )


SQL_SEEDS = f"""seeds AS (
  SELECT {sql_label("regexp_extract(p.url, '//[^/]+/([a-z]{2})/', 1)")} AS lid_label, p.page_id AS ord, p.url AS link,
    CASE WHEN d.lang <> 'es' THEN {sql_label("d.lang")} END AS predicted_lid,
    CAST(CASE l.quality WHEN 1 THEN 0.9 WHEN 0 THEN 0.7 END AS DOUBLE) AS lid_confidence
  FROM pages p LEFT JOIN documents d ON d.doc_id = p.page_id LEFT JOIN labels l ON l.doc_id = p.page_id)"""


# Labelled texts.
def text_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return docs.select(label_of(F.col("lang")).alias("lid_label"), "doc_id", "text")


SQL_TEXTS = f"texts AS (SELECT {sql_label('lang')} AS lid_label, doc_id, text FROM documents)"


# Search results: a conversation is a query, its turns are the results.
def result_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    host = F.concat(F.lit("https://q"), F.col("conv_id").cast("string"), F.lit(".example.org/"))
    return turns.select(
        F.concat(F.lit("q"), (F.col("conv_id") % 50).cast("string")).alias("iso_code"),
        F.col("conv_id").alias("line_no"),
        F.col("turn").alias("pos"),
        F.col("text").alias("snippet"),
        F.concat(host, F.col("turn").cast("string")).alias("link"),
    )


SQL_RESULTS = """results AS (
  SELECT 'q' || CAST(conv_id % 50 AS VARCHAR) AS iso_code, conv_id AS line_no, turn AS pos, text AS snippet,
    'https://q' || CAST(conv_id AS VARCHAR) || '.example.org/' || CAST(turn AS VARCHAR) AS link
  FROM conversations)"""
