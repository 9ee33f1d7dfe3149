"""Language label expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LABEL_RE = r"__(label)__([a-zA-Z]+_[a-zA-Z]+)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def extract_label(raw: Column | str) -> Column:
    """``xxx_Script`` out of a raw model label; null when it is not of that form."""
    return F.nullif(F.regexp_extract(_c(raw), LABEL_RE, 2), F.lit(""))


def alpha3(label: Column | str) -> Column:
    return F.get(F.split(_c(label), "_"), F.lit(0))


def script(label: Column | str) -> Column:
    return F.get(F.split(_c(label), "_"), F.lit(1))


def iso639_3(identifiers: Column | str) -> Column:
    """First identifier of type ``iso639-3`` in an array of (identifier, type)."""
    matching = F.filter(_c(identifiers), lambda entry: entry["type"] == "iso639-3")
    return F.get(matching, F.lit(0))["identifier"]
