"""Evaluating intermediate values once, and batches piece by piece."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` worked out once per row.

    The optimizer copies a projected expression to every place that uses it,
    into the bodies of array functions too, where it would run once per element.
    A lambda variable is not copied. (Spark does not feed a pandas UDF from a
    lambda inside another lambda's body: use ``work_out`` in between.)
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def work_out(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters and projections read and never work out again.

    A plain projection is merged into every later use, so a filter on the column
    would evaluate it a second time; the output of a generator is not merged.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def text_slices(texts: pa.Array, size: int) -> Iterator[list[str | None]]:
    """The texts in runs of about ``size`` bytes, one text at least: a batch is never held as Python strings at once."""
    reach = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = reach[start - 1] if start else 0
        stop = max(int(np.searchsorted(reach, before + size, side="right")), start + 1)
        yield texts.slice(start, stop - start).to_pylist()
        start = stop
    if not len(texts):
        yield []
