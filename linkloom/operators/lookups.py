"""Language metadata: names, speakers, families, support flags, code mappings.

Lookup tables are plain joins without a broadcast hint: Spark broadcasts a side
whose measured size is below its threshold and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from linkloom.constants import NO_DATA
from linkloom.functions import labels as L
from linkloom.session import stored


def first_match(table: DataFrame, key: str, values: list[str], order: str = "ord") -> DataFrame:
    """One row per key: the values of its first row."""
    picked = F.min_by(F.struct(*values), F.col(order)).alias("first")
    return table.filter(F.col(key).isNotNull()).groupBy(key).agg(picked).select(key, *[F.col(f"first.{v}").alias(v) for v in values])


def language_name(df: DataFrame, names: DataFrame, code: str = "code") -> DataFrame:
    """Add ``language_name``; the code itself where no name is known. ``names`` is (alpha3, name)."""
    table = names.select(F.col("alpha3").alias(code), F.col("name").alias("__name"))
    return df.join(table, code, "left").withColumn("language_name", F.coalesce("__name", code)).drop("__name")


def speakers(df: DataFrame, linguameta: DataFrame, code: str = "code") -> DataFrame:
    """Add ``speakers`` from the first matching row, and whether a row was found."""
    first = first_match(linguameta, "iso_639_3_code", ["estimated_number_of_speakers"])
    table = first.select(
        F.col("iso_639_3_code").alias(code),
        F.col("estimated_number_of_speakers").alias("speakers"),
        F.lit(True).alias("__found"),
    )
    return df.join(table, code, "left").withColumn("speakers_found", F.coalesce("__found", F.lit(False))).drop("__found")


def speakers_fallback(df: DataFrame, table: DataFrame, names: DataFrame, code: str = "code") -> DataFrame:
    """Add ``speakers`` by code, else by language name in any case.

    ``table`` is (ord, alpha3, name, speakers). A hit by code stands even when
    its value is missing.
    """
    by_code = first_match(table, "alpha3", ["speakers"]).select(
        F.col("alpha3").alias(code), F.col("speakers").alias("__by_code"), F.lit(True).alias("__hit")
    )
    lowered = table.withColumn("__key", F.lower("name"))
    by_name = first_match(lowered, "__key", ["speakers"]).select("__key", F.col("speakers").alias("__by_name"))
    named = language_name(df, names, code).withColumn("__key", F.lower("language_name"))
    return (
        named.join(by_code, code, "left")
        .join(by_name, "__key", "left")
        .withColumn("speakers", F.when(F.col("__hit"), F.col("__by_code")).otherwise(F.col("__by_name")))
        .drop("__key", "__by_code", "__by_name", "__hit")
    )


def family_name(df: DataFrame, languoid: DataFrame, code: str = "code") -> DataFrame:
    """Add ``family``: name of the languoid that the code's ``family_id`` points to."""
    families = first_match(languoid, "id", ["name"]).select(F.col("id").alias("family_id"), F.col("name").alias("family"))
    table = (
        first_match(languoid, "iso639P3code", ["family_id"])
        .withColumnRenamed("iso639P3code", code)
        .join(families, "family_id", "left")
        .select(code, "family")
    )
    return df.join(table, code, "left")


def support_flags(df: DataFrame, lists: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Add a 0/1 column per named list; each list is (column to look up, DataFrame with ``code``)."""
    for name, (column, codes) in lists.items():
        listed = codes.select(F.col("code").alias("__code"), F.lit(1).alias("__hit")).distinct()
        df = (
            df.join(listed, df[column] == listed["__code"], "left")
            .withColumn(name, F.coalesce("__hit", F.lit(0)))
            .drop("__code", "__hit")
        )
    return df


def _two_parts() -> Column:
    return F.coalesce(F.size(F.split("lid_label", "_")) == 2, F.lit(False))


def odd_labels(labels: DataFrame) -> DataFrame:
    """Labels that ``language_catalogue`` leaves out, as they are not of the form ``code_Script``."""
    return labels.filter(~_two_parts())


def language_catalogue(
    labels: DataFrame,
    names: DataFrame,
    linguameta: DataFrame,
    languoid: DataFrame,
    lists: dict[str, tuple[str, DataFrame]],
) -> DataFrame:
    """One row per ``lid_label`` with its names, speakers, family and list flags.

    ``No data`` stands for a missing row only; a row without a number shows as
    ``NaN``, as in the source tables. Labels must be of the form ``code_Script``.
    """
    coded = labels.filter(_two_parts()).withColumn("code", L.alpha3("lid_label"))
    known = family_name(speakers(language_name(coded, names), linguameta), languoid)
    number = F.when(
        F.col("speakers_found"), F.coalesce(F.col("speakers").cast("string"), F.lit("NaN"))
    ).otherwise(F.lit(NO_DATA))
    described = known.select(
        "lid_label",
        "code",
        "language_name",
        number.alias("speakers"),
        F.coalesce("family", F.lit(NO_DATA)).alias("family"),
        F.lit("").alias("subgrouping"),
    )
    return support_flags(described, lists).drop("code")


def bcp_to_iso3(df: DataFrame, iso_codes: DataFrame, bcp: str = "bcp47") -> DataFrame:
    """Add ``iso3``: the ISO 639-3 code of a BCP-47 tag.

    ``iso_codes`` is (alpha2, alpha3). Two or three letters are looked up and
    give null when unknown; a tag of another length is kept as it is.
    """
    two = iso_codes.filter(F.col("alpha2").isNotNull()).select(F.col("alpha2").alias("__key"), "alpha3")
    three = iso_codes.select(F.col("alpha3").alias("__key"), "alpha3")
    table = two.unionByName(three).select("__key", F.col("alpha3").alias("__found")).distinct()
    keyed = df.withColumn("__key", F.substring_index(bcp, "_", 1))
    return (
        keyed.join(table, "__key", "left")
        .withColumn("iso3", F.when(F.length("__key").isin(2, 3), F.col("__found")).otherwise(F.col(bcp)))
        .drop("__key", "__found")
    )


def glotto_iso_map(entries: DataFrame) -> DataFrame:
    """(glottocode, iso_code) out of entries (id, identifiers)."""
    return entries.select(F.col("id").alias("glottocode"), L.iso639_3("identifiers").alias("iso_code"))


def add_iso(df: DataFrame, mapping: DataFrame) -> DataFrame:
    # Stored: of known size, a short mapping goes to the rows, and no code's rows go to one task.
    return df.join(stored(mapping.select("glottocode", "iso_code"), "iso_codes"), "glottocode", "left")
