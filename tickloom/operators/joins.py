"""Joins of series by their identity, and cogrouping."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.ids import text_id, with_series_ids
from tickloom.model import SERIES_KEY, known_label_text, with_selector, with_series_key
from tickloom.operators.aggregates import DEFAULT_BAG_ROWS, bag_by_key, window_of_all

ID_KEY = ["class_id", "labels_id", "selector"]


def bounds_cogroup(bounds: DataFrame) -> DataFrame:
    """First tick of the series that starts first, last tick of the one that ends last.

    One row when a series is both, else two rows with one side null each. Both
    come from one aggregate; without any series there is no row.
    """
    window = window_of_all(bounds).where(F.col("first_series").isNotNull())
    null = F.lit(None).cast("bigint")

    def side(series: str, first: Column, last: Column) -> Column:
        return F.struct(
            *[F.col(f"{series}.{k}").alias(k) for k in ID_KEY],
            first.alias("first_tick"),
            last.alias("last_tick"),
        )

    first, last = F.col("first_tick"), F.col("last_tick")
    same = F.col("first_series.selector") == F.col("last_series.selector")
    return window.select(
        F.inline(
            F.when(same, F.array(side("first_series", first, last))).otherwise(
                F.array(side("first_series", first, null), side("last_series", null, last))
            )
        )
    )


def cogroup_bags(
    left: DataFrame, right: DataFrame, keys: list[str], rows_per_bag: int = DEFAULT_BAG_ROWS
) -> DataFrame:
    """One row per key of either side, with a bag of its rows from each side.

    A side without the key has an empty bag. Keys with more than ``rows_per_bag``
    rows on a side go on over rows with the next ``part`` numbers; the sides are
    never paired row by row. Null keys of the two sides do not meet.
    """
    on = [*keys, "part"]
    a = bag_by_key(left, keys, "left_bag", rows_per_bag)
    b = bag_by_key(right, keys, "right_bag", rows_per_bag)
    joined = a.join(b, on, "full_outer")
    return joined.select(
        *on, *[F.coalesce(bag, F.array()).alias(bag) for bag in ("left_bag", "right_bag")]
    )


def group_assignment(series: DataFrame, by_labels: Iterable[str]) -> DataFrame:
    """Group id of every series, from the values of chosen labels.

    ``series`` is any table with metadata: points, blocks, or blocks loaded light.
    """
    chosen = {name: F.coalesce(F.col("labels").getItem(name), F.lit("")) for name in by_labels}
    listed = with_series_key(series).select(
        *SERIES_KEY, known_label_text(chosen).alias("_group")
    ).distinct()
    return with_selector(with_series_ids(listed)).select(
        *ID_KEY, *SERIES_KEY, text_id("_group").alias("group_id")
    )


def partition_join(points: DataFrame, assignment: DataFrame) -> DataFrame:
    """Points with the group id assigned to their series.

    The join is on the series key, never on the label map. Neither side is forced
    to broadcast: the list of series can be long.
    """
    return with_series_key(points).join(assignment.select(*SERIES_KEY, "group_id"), SERIES_KEY)


def reduce_by_group(
    points: DataFrame,
    assignment: DataFrame,
    partial: dict[str, Column],
    final: dict[str, Column],
) -> DataFrame:
    """Aggregate points by the group of their series.

    ``partial`` aggregates points within a series and ``final`` combines those
    columns within a group, so only one row per series reaches the join.
    """
    per_series = with_series_key(points).groupBy(*SERIES_KEY).agg(
        *[column.alias(name) for name, column in partial.items()]
    )
    joined = per_series.join(assignment.select(*SERIES_KEY, "group_id"), SERIES_KEY)
    return joined.groupBy("group_id").agg(*[column.alias(name) for name, column in final.items()])
