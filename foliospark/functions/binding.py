"""Evaluate once: keep filters from being rewritten in terms of costly expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)`, with `value` evaluated once however often the body mentions it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def bind(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows and columns, with `columns` fixed as results.

    A filter on a computed column is normally pushed below the computation, which then runs
    again inside the filter, once per mention. That is a good trade for cheap expressions and
    a ruinous one for pattern searches over long texts. Passing the columns through a
    one-element `inline` keeps such filters above it; there is no shuffle and no extra row.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*columns))))
