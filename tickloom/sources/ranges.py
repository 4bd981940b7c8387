"""Sequences of numbers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.timeunits import floor_div

_MAX_STEP = 2**31 - 1


def range_scan(spark: SparkSession, start: int, count: int, splits: int = 1) -> DataFrame:
    """``count`` numbers from ``start``, as ``(seqno, value)``.

    ``seqno`` restarts at 0 in each split. Splits hold ``ceil(count / splits)``
    numbers and the last may be shorter, so there can be fewer than asked for.
    """
    if splits < 1:
        raise ValueError("splits must be at least 1")
    if count < 0:
        raise ValueError("count must not be negative")
    step = max(1, min(-(-count // splits), _MAX_STEP))
    numbers = spark.range(0, count, 1, max(1, -(-count // step)))
    return numbers.select(
        (F.col("id") - floor_div(F.col("id"), step) * step).alias("seqno"),
        (F.col("id") + start).alias("value"),
    )


def range_location(spark: SparkSession, location: str, splits: int = 1) -> DataFrame:
    """``range_scan`` for a location ``range://START:COUNT``."""
    shape = re.fullmatch(r"range://(-?\d+):(\d+)", location)
    if shape is None:
        raise ValueError(f"malformed range location: {location!r}")
    return range_scan(spark, int(shape.group(1)), int(shape.group(2)), splits)
