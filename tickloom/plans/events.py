"""Points read from an ``events`` table."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.selectors import Match, pushable_classes
from tickloom.functions.timeunits import ticks_of_local_timestamp
from tickloom.model import to_points


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _local_timestamp(tick: int) -> Column:
    """Literal UTC wall-clock timestamp of a tick in microseconds."""
    moment = datetime(1970, 1, 1) + timedelta(microseconds=tick)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def event_points(
    spark: SparkSession,
    folder: str,
    window: tuple[int, int] | None = None,
    clip: tuple[int, int] | None = None,
    selectors: Iterable[str] = (),
    name: str | None = None,
) -> DataFrame:
    """Every event as a point of the series of its type and user.

    ``event_id`` decides which of location and elevation a point has, so that all
    point forms occur.

    The other arguments are conditions on the stored columns, which the scan can
    use to skip data: ``window`` keeps ticks in ``(window[0], window[1]]``, ``clip``
    in ``[clip[0], clip[1]]``, ``name`` the series of one class, and ``selectors``
    what their classes allow. They spare reading what ``select_series`` and the
    like drop later, and do not take their place.
    """
    events = read_table(spark, folder, "events")
    classes = pushable_classes(*selectors) if selectors else None
    if name:
        classes = Match(name, False).pushable
    if classes is not None:
        # A null class is the empty text, which no condition of this kind allows.
        events = events.where(classes(F.col("event_type")))
    if clip is not None:
        low, high = (_local_timestamp(tick) for tick in clip)
        events = events.where((F.col("ts") >= low) & (F.col("ts") <= high))
    if window is not None:
        low, high = (_local_timestamp(tick) for tick in window)
        events = events.where((F.col("ts") > low) & (F.col("ts") <= high))
    form = F.col("event_id") % 4
    has_location = form.isin(0, 1)
    has_elevation = form.isin(0, 2)
    return to_points(
        events,
        class_=F.col("event_type"),
        ts=ticks_of_local_timestamp(F.col("ts")),
        value=F.col("value"),
        labels={"user": F.col("user_id"), "shard": F.col("user_id") % 4},
        attributes={"tier": F.when(F.col("user_id") % 3 == 0, "gold").otherwise("std")},
        lat=F.when(has_location, F.col("event_id") % 181 - 90),
        lon=F.when(has_location, F.col("event_id") % 361 - 180),
        elev=F.when(has_elevation, F.col("event_id") % 1000),
        keep=["event_id"],
    )
