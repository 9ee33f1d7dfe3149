"""Spark jobs that turn search results and fetched pages into per-language web catalogues."""
