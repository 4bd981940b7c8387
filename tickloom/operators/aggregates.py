"""Counts, bounds and extremes of series, and grouping rows into bags.

Everything here is a partial-then-final aggregate; no operator sorts a series
or holds it in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tickloom.functions.ids import with_series_ids
from tickloom.functions.timeunits import floor_div
from tickloom.model import SERIES_KEY, with_selector, with_series_key
from tickloom.operators.ordering import with_rank

DEFAULT_BAG_ROWS = 100_000


def series_count(points: DataFrame) -> DataFrame:
    """Points of every series."""
    return with_series_key(points).groupBy(*SERIES_KEY).agg(F.count(F.lit(1)).alias("n_points"))


def block_count() -> Column:
    """Points of a block: its header count, or the stored points when that is 0."""
    # The ticks alone say how many points there are, so other fields are not read.
    stored = F.when(F.col("points").isNull(), 0).otherwise(F.size("points.ts")).cast("bigint")
    return F.when(F.coalesce("count", F.lit(0)) != 0, F.col("count")).otherwise(stored)


def is_block_empty() -> Column:
    """True for a block without points, agreeing with ``block_count``."""
    return block_count() == 0


def series_bounds(points: DataFrame) -> DataFrame:
    """First and last tick of every series, with its ids."""
    bounds = (
        with_series_key(points)
        .groupBy(*SERIES_KEY)
        .agg(F.min("ts").alias("first_tick"), F.max("ts").alias("last_tick"))
    )
    return with_series_ids(bounds)


def top_one(
    df: DataFrame, keys: list[str], order: list[str], descending: bool = False
) -> DataFrame:
    """The row that comes first in ``order`` of every group, or overall without keys.

    ``order`` must be a total order for the result to repeat.
    """
    rank = F.struct(*order)
    row = F.struct(*[c for c in df.columns if c not in keys])
    best = F.max_by(row, rank) if descending else F.min_by(row, rank)
    found = df.groupBy(*keys).agg(best.alias("_row")).where(F.col("_row").isNotNull())
    return found.select(*keys, "_row.*")


def window_of_all(bounds: DataFrame) -> DataFrame:
    """One row: the first series to start and the last to end, with those ticks.

    Ties go to the smaller class, then the smaller selector.
    """
    named = with_selector(bounds)
    tie = ["class", "selector"]
    row = F.struct(*[c for c in named.columns if c not in ("first_tick", "last_tick")])
    return named.agg(
        F.min_by(row, F.struct("first_tick", *tie)).alias("first_series"),
        F.min("first_tick").alias("first_tick"),
        F.min_by(row, F.struct(-F.col("last_tick"), *tie)).alias("last_series"),
        F.max("last_tick").alias("last_tick"),
    )


def bag_by_key(
    df: DataFrame, keys: list[str], bag: str = "bag", rows_per_bag: int = DEFAULT_BAG_ROWS
) -> DataFrame:
    """Rows of every key as arrays of structs of ``rows_per_bag`` rows at most.

    The rows of a key fill bags one after the other, numbered by ``part`` from 0,
    in an order that their content decides; how the table is stored does not
    matter. Columns that hold maps inside other values do not take part in the order.
    """
    if rows_per_bag < 1:
        raise ValueError("rows_per_bag must be at least 1")
    content = []
    for field in df.schema:
        value, inner = F.col(f"`{field.name}`"), field.dataType
        if isinstance(inner, MapType):
            # Equal maps may list their entries in any order.
            value, inner = F.array_sort(F.map_entries(value)), inner.valueType
        if "map<" not in inner.simpleString():
            content.append(value)
    row = F.struct(*[c for c in df.columns if c not in keys])
    ranked = with_rank(df, keys, [F.xxhash64(*content)], name="_rank")
    part = floor_div(F.col("_rank") - 1, rows_per_bag)
    return ranked.groupBy(*keys, part.alias("part")).agg(F.collect_list(row).alias(bag))


def emitted_count(points: DataFrame, ready: DataFrame | None = None) -> DataFrame:
    """Lines that ``update_stream`` writes for every series: one per point.

    Ready lines are counted under a null key.
    """
    counted = series_count(points).withColumnRenamed("n_points", "emitted")
    if ready is None:
        return counted
    null = F.lit(None).cast("string")
    return counted.union(
        ready.agg(F.count(F.lit(1)).alias("emitted")).select(null, null, "emitted").where("emitted > 0")
    )
