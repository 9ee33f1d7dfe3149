"""Registered queries: each operator over the given tables, with its SQL twin.

``QUERIES`` maps a name to a function of (spark, sf_dir); ``ORACLES`` maps it to
SQL over the same tables with the same column names.
"""

from linkloom.registry import catalogue, crawling, language, modelling, roundtrips, screening, urls_pages  # noqa: F401
from linkloom.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
