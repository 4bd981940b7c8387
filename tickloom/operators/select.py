"""Selecting series by their metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.selectors import selector_condition


def select_series(df: DataFrame, *selectors: str) -> DataFrame:
    """Keep points or blocks whose series matches any of the selectors."""
    return df.where(selector_condition(*selectors))


def filter_by_metadata(df: DataFrame, kind: str, value: str) -> DataFrame:
    """Keep series whose metadata of the given kind equals ``value``.

    The only kind is ``name``, the class of the series.
    """
    if kind != "name":
        raise ValueError(f"unknown metadata kind: {kind!r}")
    return df.where(F.col("class") == value)
